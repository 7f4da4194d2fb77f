"""Secret scan: fixed patterns, and character Markov models.

The base patterns find their spans in every whole text.  The method adds spans
among the other long tokens: two first-order Markov models over characters, one
of random strings and one of ordinary identifiers, are compared by the
logarithm of their likelihood ratio.  A token is a secret when the ratio per
character reaches ``margin``.

Training needs labelled strings, ``random`` true or false.  ``samples`` makes a
fixed, bounded set: random strings over hex, base 32, 36, 62 and 64 alphabets
(``RANDOM``), and ordinary identifiers, numbers and rules of lines.  The corpus
adds its words to the ordinary class (``count_words``): all tokens that are too
short to be judged, so that no secret the models are to find is learnt as
ordinary.  ``count_corpus`` labels by the base patterns instead, and finds
little that they do not.  Each partition counts the pairs of neighbouring
characters of all its strings, Spark adds the counts up, and only the count
tables (``ALPHABET`` squared each, whatever the corpus) reach the driver.

Defined cases: null and empty texts have no spans; spans are in code points,
end exclusive; an added span never overlaps a base span; without labelled
samples of a class its model is uniform, and without any no span is added; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random as chance
import re
import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.session import pickle_by_value

KINDS = ("assign", "access", "hex", "markov")
#: Fixed patterns.  Runs shorter than asked for are never started in the last
#: two; the first has to consume them, see ``base_spans``.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")
_BETWEEN = re.compile(r"[^A-Za-z0-9+/_=-]")
#: Shortest token the models judge, and the ratio (natural log) per character.
SHORTEST = 16
MARGIN = 0.25
#: Characters of the models; the last state is "start".
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(ALPHABET) + 1
_CODE = np.zeros(128, dtype="i8")
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_IN_TOKEN = np.zeros(128, dtype="i1")
_IN_TOKEN[[ord(c) for c in ALPHABET]] = 1
#: Characters counted at a time, about.
PIECE = 1 << 20
#: Alphabets of the random samples.
RANDOM = ("0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567",
          string.ascii_lowercase + string.digits, string.ascii_letters + string.digits,
          string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_")
#: Words of the ordinary samples.
WORDS = tuple(
    "get set user name count index file path value key list item order line data date time type "
    "size text node state table column row table query result error message request response "
    "server client account address number string buffer cache config option default parse read "
    "write open close start stop create update delete insert find search match filter sort group "
    "merge split join load save store token window stream event handler manager service factory "
    "controller context session version length width height color image page link content header "
    "footer body title label button input output source target test example sample report price "
    "total amount customer product invoice payment country street city region language document "
    "chapter section paragraph public private static final abstract interface package import "
    "module class method function variable object array boolean integer double float long short "
    "maximum minimum average current previous next first last left right top bottom before after "
    "http www com org net html index php src main lib bin usr local share home var log tmp etc "
    "is has to from with by for of on in at not and or all any no new old max min id url api "
    "msg ptr buf len cnt idx num str cfg ctx recv send addr proto opt dev env sys cpu gpu db sql "
    "tcp udp ssl tls dns ip ipv4 ipv6 x509 sha256 md5 utf8 base64 http2 v1 v2 v3 x86 i18n rtp fd"
    .split())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _value(text: str, span: tuple[int, int, int]) -> str:
    """The secret itself: of an assignment, its right side."""
    return ASSIGN.match(text, span[0])[2] if span[1] == 0 else text[span[0]:span[2]]


def _free_tokens(text: str, spans, shortest: int):
    """Tokens of ``shortest`` characters that touch none of ``spans`` (by start)."""
    at, reach = 0, 0  # reach: the furthest end of the spans that start before a token ends
    for m in re.finditer(f"[A-Za-z0-9+/_=-]{{{shortest},}}", text):
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= m.start():
            yield m.start(), m.end(), m[0]


def pairs_of(token: str) -> np.ndarray:
    """state * STATES + next state along a token."""
    codes = _CODE[np.frombuffer(token.encode("ascii"), dtype="u1")]
    return np.concatenate([[STATES - 1], codes[:-1]]) * STATES + codes


def _counted(rows) -> pa.RecordBatch:
    """Count tables of (is_random, token) rows as one batch of non-zero cells."""
    table = np.zeros((2, STATES * STATES), dtype="i8")
    for random, token in rows:
        np.add.at(table[int(random)], pairs_of(token), 1)
    kind, cell = np.nonzero(table)
    return pa.RecordBatch.from_arrays(
        [pa.array(kind.astype("i4")), pa.array(cell.astype("i4")), pa.array(table[kind, cell])],
        names=["random", "cell", "n"])


CELLS = "random int, cell int, n long"


def count_labelled(samples: DataFrame, value="value", random="random") -> DataFrame:
    """Character pair counts of labelled strings (characters outside the
    alphabet end a string; null strings and labels are left out)."""
    def count(batches):
        for b in batches:
            yield _counted((r, t) for v, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                           if v is not None and r is not None for t in TOKEN.findall(v))
    return samples.select(F.col(value).cast("string"), F.col(random).cast("boolean")) \
        .mapInArrow(count, CELLS)


def count_corpus(docs: DataFrame, text="text", shortest: int = SHORTEST) -> DataFrame:
    """The same counts from a corpus that the base patterns label: what they
    match is random, every other token of ``shortest`` characters is not."""
    def rows(texts):
        for t in texts:
            t = t or ""
            spans = base_spans(t)
            for s in spans:
                for x in TOKEN.findall(_value(t, s)):
                    yield 1, x
            for _, _, x in _free_tokens(t, spans, shortest):
                yield 0, x

    def count(batches):
        for b in batches:
            yield _counted(rows(x.as_py() for x in b.column(0)))
    return docs.select(F.col(text).cast("string")).mapInArrow(count, CELLS)


def samples(spark: SparkSession, n: int = 500, seed: int = 10) -> DataFrame:
    """The labelled strings (value, random): ``n`` of 16 to 48 characters per
    alphabet of ``RANDOM``, and ``n`` per kind of ordinary string."""
    rng = chance.Random(seed)
    rows = [("".join(rng.choices(a, k=rng.randrange(16, 49))), True) for a in RANDOM
            for _ in range(n)]

    def some():
        return rng.choices(WORDS, k=rng.randrange(2, 6))

    for _ in range(n):
        w = some()
        rows += [(x, False) for x in (
            "_".join(some()), "-".join(some()), "/" + "/".join(some()), "".join(some()),
            "".join(map(str.title, some())), w[0] + "".join(map(str.title, w[1:])),
            "_".join(some()).upper(), "".join(some()).upper(), "=".join(some()[:2]),
            "_".join(some()) + str(rng.randrange(100)),
            str(rng.randrange(10 ** 15, 10 ** rng.randrange(16, 21))),
            f"{rng.randrange(1970, 2040)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}",
            rng.choice("-_=+/") * rng.randrange(16, 49))]
    return spark.createDataFrame(rows, "value string, random boolean")


def _pieces(text: str):
    """A text cut between tokens into pieces of about ``PIECE`` characters."""
    at = 0
    while at < len(text):
        end = _BETWEEN.search(text, at + PIECE)
        yield text[at:end.end() if end else len(text)]
        at = end.end() if end else len(text)


def word_pairs(text: str, shortest: int = SHORTEST) -> np.ndarray:
    """Counts of the pairs along all tokens of a text that are shorter than
    ``shortest`` and touch no base span."""
    parts, at = [], 0
    for a, _, b in base_spans(text):  # a span makes the token it touches too long
        parts += [text[at:max(a, at)], "=" * shortest]
        at = max(at, b)
    table = np.zeros(STATES * STATES, dtype="i8")
    for piece in _pieces("".join([*parts, text[at:]])):
        raw = np.frombuffer(piece.encode("ascii", "replace"), dtype="u1")
        edge = np.flatnonzero(np.diff(_IN_TOKEN[raw], prepend=0, append=0))
        starts, sizes = edge[::2], edge[1::2] - edge[::2]
        state = np.concatenate([[0], _CODE[raw[:-1]]])
        state[starts] = STATES - 1
        kept = np.zeros(len(raw), dtype=bool)
        kept[_IN_TOKEN[raw] > 0] = np.repeat(sizes < shortest, sizes)
        table += np.bincount((state * STATES + _CODE[raw])[kept], minlength=len(table))
    return table


def count_words(docs: DataFrame, text="text", shortest: int = SHORTEST) -> DataFrame:
    """Character pair counts of a corpus' words, as the ordinary class: all
    tokens too short to be judged that touch no base span."""
    def count(batches):
        for b in batches:
            table = np.zeros(STATES * STATES, dtype="i8")
            for x in b.column(0):
                table += word_pairs(x.as_py() or "", shortest)
            cell = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(cell), dtype="i4")), pa.array(cell.astype("i4")),
                 pa.array(table[cell])], names=["random", "cell", "n"])
    return docs.select(F.col(text).cast("string")).mapInArrow(count, CELLS)


def _table(counts: DataFrame) -> np.ndarray:
    table = np.zeros((2, STATES * STATES))
    for r in counts.groupBy("random", "cell").agg(F.sum("n").alias("n")).collect():
        table[r["random"], r["cell"]] = r["n"]  # 2 * STATES squared rows at most
    return table


def train(counts: DataFrame, corpus: DataFrame | None = None) -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of every character pair.

    Each class of ``corpus`` counts as much as the same class of ``counts``,
    whatever its size, so that the labelled strings keep their say."""
    table = _table(counts)
    if corpus is not None:
        more = _table(corpus)
        table += more * (table.sum(axis=1, keepdims=True)
                         / np.maximum(more.sum(axis=1, keepdims=True), 1))
    table = table.reshape(2, STATES, STATES)[:, :, :-1]
    return _ratio(table)


def _ratio(table: np.ndarray) -> np.ndarray:
    # a pair's share is drawn towards the character's own share, that towards 1 / n
    one = table.sum(axis=1, keepdims=True) + 1.0
    one /= one.sum(axis=2, keepdims=True)
    p = (table + 20 * one) / (table.sum(axis=2, keepdims=True) + 20)
    out = np.zeros((STATES, STATES))
    out[:, :-1] = np.log(p[1]) - np.log(p[0])
    return out.ravel()


def score(token: str, ratio: np.ndarray) -> float:
    """Mean log-likelihood ratio per character."""
    return float(ratio[pairs_of(token)].mean())


def spans(text: str, ratio: np.ndarray, shortest: int = SHORTEST,
          margin: float = MARGIN) -> tuple[list, list]:
    """Base spans and added spans, each (start, kind, end)."""
    base = base_spans(text)
    return base, [(a, 3, b) for a, b, t in _free_tokens(text, base, shortest)
                  if score(t, ratio) >= margin]


def joined(found) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def scan(docs: DataFrame, ratio: np.ndarray, doc_id="doc_id", text="text",
         shortest: int = SHORTEST, margin: float = MARGIN) -> DataFrame:
    """doc_id, counts per kind, base_sha256 and all spans of every row."""
    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, "
                  "spans string")
    def find(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            base, more = spans(t or "", ratio, shortest, margin)
            n = [sum(s[1] == k for s in base) for k in range(3)]
            out.append((*n, len(more), hashlib.sha256(joined(base).encode()).hexdigest(),
                        joined(base + more)))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_markov",
                                          "base_sha256", "spans"])

    return docs.select(F.col(doc_id).alias(doc_id), find(F.col(text).cast("string")).alias("f")) \
        .select(doc_id, "f.*")


pickle_by_value(__name__)
