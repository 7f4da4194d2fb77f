"""Personal data by weak supervision.

Fixed patterns find e-mail addresses, IP addresses, card numbers and phone numbers
in every whole text; those spans stay.  The method adds spans.  Looser patterns
give candidates (written-out addresses, other number groups, capitalised names);
what is seen of a candidate is its evidence: seven small categories.  Labelers
read the evidence and vote private, ordinary, or nothing: the shape of the match and its
check digits (patterns), names, domain endings and ordinary words (gazetteers), cue words
and units around it (context).

All candidates of all texts, base spans among them, are counted by evidence:
every partition fills a table of ``CELLS`` counts, Spark adds the tables up, and only
that table (whatever the corpus) reaches the driver.  Votes depend on the evidence
alone, so expectation-maximisation over the counted cells equals that over all candidates:
it estimates the share of private candidates per kind and every labeler's
reliability: how often its votes are right on private and on ordinary ones.  The
cells' posteriors then train the span classifier, a logistic regression on the
evidence, which also weighs what no labeler votes on.  Candidates it gives at
least ``THRESHOLD`` become spans.

Defined cases: null and empty texts have no spans; spans are in code points, end
exclusive; an added span never overlaps a base span or another added one (the
earlier, then the longer wins); base spans of different kinds may overlap;
a corpus without candidates adds nothing; repeated rows give repeated rows; an empty table
gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.session import pickle_by_value

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "mail", "number", "person")
MAIL, NUMBER, PERSON = 4, 5, 6

# Possessive runs, and starts only where a run starts: each character is read a
# bounded number of times, however long the runs are.  The look-behind follows the
# first character, so that the search may skip to such a character.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL_START = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL.pattern)
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_AT = re.compile(r"[\[({]\x20?at\x20?[\])}]", re.IGNORECASE | re.ASCII)
_LOCAL = re.compile(r"[\w.%+-]{1,64}\x20?\Z")
_DOMAIN = re.compile(r"\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?)"
                     r"[A-Za-z0-9-]{1,63}){1,8}", re.IGNORECASE | re.ASCII)
_ACCOUNT = re.compile(r"[A-Z](?<![\w.+-][A-Z])[A-Z][0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}"
                      r"(?:\x20?[A-Z0-9]{1,3})?(?!\w)")
_NUMBER = re.compile(r"[0-9](?<![\w.+-][0-9])(?:[\x20().-]{0,2}[0-9]){6,18}(?!\w)")
_PERSON = re.compile(r"[A-Z](?<!\w[A-Z])[^\W\d_]{1,20}(?:\x20(?:[A-Z]\.\x20)?[A-Z][^\W\d_]{1,20}){1,2}(?!\w)")
_DATE = re.compile(r"\d{4}[-. ]\d{1,2}[-. ]\d{1,2}|\d{1,2}[-. ]\d{1,2}[-. ]\d{4}")
_DECIMAL = re.compile(r"\d+\.\d+")
_GROUPS = re.compile(r"\d{2,5}\)?(?:[\x20.-]{1,2}\d{2,4}){2,4}|\d{2,5}\)[\x20.-]?\d{3,8}")
_SSN = re.compile(r"\d{3}-\d{2}-\d{4}")
_WORD = re.compile(r"[^\W\d_]+")

#: Gazetteers.
NAMES = frozenset(
    "james john robert michael william david richard joseph thomas charles christopher daniel "
    "matthew anthony mark donald steven paul andrew joshua kenneth kevin brian george edward mary "
    "patricia jennifer linda elizabeth barbara susan jessica sarah karen nancy lisa margaret "
    "betty sandra ashley kimberly emily donna michelle carol amanda melissa deborah stephanie "
    "rebecca laura helen anna peter hans klaus jürgen wolfgang stefan andreas sabine petra monika "
    "ursula claudia jean pierre jacques françois michel marie sophie camille juan josé carlos luis "
    "antonio manuel francisco maría carmen ana isabel lucía elena mohammed ahmed ali fatima wei li "
    "yuki hiroshi ivan olga natasha raj priya".split())
ENDINGS = frozenset("com org net edu gov info biz io co uk de fr es it eu us ca au ch at nl be se "
                    "no dk pl pt ru jp cn in br mx".split())
ORDINARY = frozenset(
    "the a an in on of at by for from with and or but if when order invoice isbn issn version "
    "page pages figure table chapter section item part article total price amount year number "
    "volume model serial build release bestellung rechnung seite kapitel abschnitt commande "
    "facture page chapitre pedido factura capítulo january february march april may june july "
    "august september october november december monday tuesday wednesday thursday friday saturday "
    "sunday new north south east west university street national united".split())
UNITS = frozenset("percent km kg eur usd gbp dollars euros euro dollar miles years people points "
                  "votes bytes mb gb".split())
#: Cue words by kind of candidate.
_NUMBER_CUES = frozenset(
    "phone tel telephone telefon teléfono téléphone call mobile cell fax handy ssn social account "
    "iban konto compte cuenta card visa mastercard passport licence license id ausweis".split())
_MAIL_CUES = frozenset("email mail e contact write reach correo courriel adresse schreiben".split())
_PERSON_CUES = frozenset("mr mrs ms dr prof name named dear regards sincerely signed patient "
                         "employee herr frau monsieur madame señor señora contact".split())
CUES = (_MAIL_CUES, frozenset({"ip", "host", "address", "server"}), _NUMBER_CUES, _NUMBER_CUES,
        _MAIL_CUES, _NUMBER_CUES, _PERSON_CUES)
#: Characters of context on either side.
CONTEXT = 40

#: Digits of a number whose check digit is looked at.
CHECKED = 15

#: Levels of the evidence: kind, shape, check digits, gazetteer, cue, surroundings, size.
LEVELS = (len(KINDS), 6, 3, 3, 3, 3, 4)
CELLS = int(np.prod(LEVELS))
FIXED, GROUPS, IDENTITY, RUN, OTHER_KIND, UNCLEAR = range(6)  # shapes
#: Votes: nothing, private, ordinary.
NOTHING, PRIVATE, PLAIN = 0, 1, 2
LABELERS = ("shape", "check digits", "gazetteer", "cue", "surroundings")
THRESHOLD = 0.5
#: Where EM begins, and what it is drawn to with a weight of so many candidates: the
#: share of private candidates, and how often a vote on them is right.
SHARE, RIGHT, WEIGHT = 0.2, 0.9, 20.0
#: A labeler is taken to be better than chance, and never sure.
BOUNDS = (0.6, 0.99)


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        # after a match the rest of its run may start another one
        m = (at and _EMAIL.match(text, at)) or _EMAIL_START.search(text, at)
        if not m:
            return
        yield m.start(), m.end()
        at = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdecimal() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the loose patterns that touch no base span, by start."""
    found = []
    for m in _AT.finditer(text):
        left = _LOCAL.search(text, max(0, m.start() - 65), m.start())
        right = _DOMAIN.match(text, m.end())
        if left and right:
            found.append((MAIL, left.start(), right.end()))
    for m in _NUMBER.finditer(text):  # an opening bracket before it belongs to it
        a = m.start() - (text[m.start() - 1:m.start()] == "(" and ")" in m[0])
        found.append((NUMBER, a, m.end()))
    found += [(NUMBER, m.start(), m.end()) for m in _ACCOUNT.finditer(text)]
    for m in _PERSON.finditer(text):  # a word that announces a name is none of it
        words = list(_WORD.finditer(m[0]))
        while words and words[0][0].lower() in _PERSON_CUES:
            del words[0]
        if len(words) > 1:
            found.append((PERSON, m.start() + words[0].start(), m.end()))
    taken = sorted((a, b) for _, a, b in base)
    out, at, reach = [], 0, 0  # reach: the furthest end of the base spans that start earlier
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        while at < len(taken) and taken[at][0] <= a:
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= a and (at == len(taken) or taken[at][0] >= b):
            out.append((kind, a, b))
    return out


def _shape(kind: int, s: str) -> int:
    if kind < len(BASE):
        return FIXED
    if kind == MAIL:
        return FIXED if re.search(r"[A-Za-z]{2}\Z", s) else UNCLEAR
    if kind == PERSON:
        return UNCLEAR
    if s[0].isalpha() or _SSN.fullmatch(s):
        return IDENTITY
    if _DATE.fullmatch(s) or _DECIMAL.fullmatch(s):
        return OTHER_KIND
    if s.isdecimal():  # the check digits of longer ones say more
        return RUN if len(s) < CHECKED else UNCLEAR
    return GROUPS if _GROUPS.fullmatch(s.lstrip("(")) else UNCLEAR


def evidence(text: str, kind: int, a: int, b: int) -> tuple[int, ...]:
    """The categories of one candidate, in the order of ``LEVELS``."""
    s = text[a:b] if b - a <= 128 else text[a:a + 128]
    digits = sum(c.isdecimal() for c in s)
    before, after = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
    words = [w.lower() for w in _WORD.findall(before)]
    own = [w.lower() for w in _WORD.findall(s)] if kind in (MAIL, PERSON) else []
    check = 0
    if kind == NUMBER and s[0].isalpha():
        check = 1 if iban(s) else 2
    elif kind == NUMBER and digits >= CHECKED:
        check = 1 if luhn(_NOT_DIGIT.sub("", s)) else 2
    elif kind == 2:
        check = 1
    listed = 0
    if kind == PERSON:
        listed = 2 if ORDINARY.intersection(own) else int(own[0] in NAMES)
    elif kind == MAIL:
        listed = int(own[-1] in ENDINGS)
    cue = 0
    if CUES[kind].intersection(words):
        cue = 2 if words[-1] in CUES[kind] else 1
    unit = _WORD.match(after.lstrip())
    around = 0
    if before.rstrip()[-1:] in tuple("$€£¥#%") or after.lstrip()[:1] in tuple("$€£¥%") \
            or unit and unit[0].lower() in UNITS:
        around = 2
    elif kind != PERSON and ORDINARY.intersection(words[-2:]) - {"the", "a", "at", "on", "by",
                                                                   "in", "or", "and", "number"}:
        around = 1
    size = min(len(own) - 2, 3) if kind == PERSON else \
        sum(digits >= n for n in (10, 12, 16)) if kind != MAIL else 0
    return kind, _shape(kind, s), check, listed, cue, around, max(size, 0)


def cell(e: tuple[int, ...]) -> int:
    return int(np.ravel_multi_index(e, LEVELS))


def _all_evidence() -> np.ndarray:
    return np.stack(np.unravel_index(np.arange(CELLS), LEVELS), axis=1)


def votes() -> np.ndarray:
    """What every labeler votes on every cell."""
    _, shape, check, listed, cue, around, _ = _all_evidence().T
    by_shape = np.array([PRIVATE, PRIVATE, PRIVATE, PLAIN, PLAIN, NOTHING])
    return np.stack([by_shape[shape], check, listed, np.minimum(cue, PRIVATE),
                     np.where(around > 0, PLAIN, NOTHING)], axis=1)


def one_hot() -> np.ndarray:
    """The classifier's inputs of every cell: a constant and all categories."""
    e = _all_evidence()
    return np.concatenate([np.ones((CELLS, 1)), *[np.eye(n)[e[:, i]] for i, n in enumerate(LEVELS)]],
                          axis=1)


@dataclass
class Model:
    """Share of private candidates per kind, reliabilities (how often a labeler that
    votes on private and on ordinary ones is right), the cells' posteriors and the
    classifier's probabilities."""

    share: np.ndarray
    reliability: np.ndarray
    posterior: np.ndarray
    probability: np.ndarray


def expect(kind: np.ndarray, vote: np.ndarray, share: np.ndarray, reliability: np.ndarray
           ) -> np.ndarray:
    """Probability that each row (kind, votes) is private."""
    hit, miss = np.log(reliability), np.log(1 - reliability)
    odds = np.log(share[kind]) - np.log(1 - share[kind]) \
        + (vote == PRIVATE) @ (hit[:, 0] - miss[:, 1]) + (vote == PLAIN) @ (miss[:, 0] - hit[:, 1])
    return 1 / (1 + np.exp(-odds))


def maximise(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, p: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Shares and reliabilities that fit the rows' probabilities best."""
    private, every = (np.bincount(kind, w, len(KINDS)) for w in (n * p, n))
    share = (private + WEIGHT * SHARE) / (every + WEIGHT)
    on = np.stack([n * p, n * (1 - p)])  # candidates as private ones, as ordinary ones
    right = np.stack([on[0] @ (vote == PRIVATE), on[1] @ (vote == PLAIN)], axis=1)
    voted = (on @ (vote != NOTHING)).T
    return share, ((right + WEIGHT * RIGHT) / (voted + WEIGHT)).clip(*BOUNDS)


def train(counts: np.ndarray, rounds: int = 200) -> Model:
    """The model of a table of ``CELLS`` counts."""
    kind, vote = _all_evidence()[:, 0], votes()
    has = np.flatnonzero(counts)
    n = counts[has].astype("f8")
    share, reliability = np.full(len(KINDS), SHARE), np.full((len(LABELERS), 2), RIGHT)
    before = np.zeros(len(has))
    for _ in range(rounds):
        p = expect(kind[has], vote[has], share, reliability)
        if len(p) == 0 or np.abs(p - before).max() < 1e-9:
            break
        share, reliability = maximise(kind[has], vote[has], n, p)
        before = p
    posterior = expect(kind, vote, share, reliability)
    return Model(share, reliability, posterior, _classify(n, has, posterior[has]))


def _classify(n: np.ndarray, has: np.ndarray, p: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression of the posteriors on the evidence (Newton's method);
    every cell's probability."""
    x, w = one_hot(), np.zeros(1 + sum(LEVELS))
    w[0] = -5.0  # nothing seen: nothing added
    own = x[has]
    n = np.sqrt(n)  # what is frequent must not outweigh all else
    for _ in range(50):
        if len(has) == 0:
            break
        q = 1 / (1 + np.exp(-own @ w))
        slope = own.T @ (n * (q - p)) + ridge * w
        bend = (own * (n * q * (1 - q))[:, None]).T @ own + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 5.0 / np.abs(step).max(initial=1e-12))
        if np.abs(step).max() < 1e-10:
            break
    return 1 / (1 + np.exp(-x @ w))


def count(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Candidates of all texts by evidence; ``CELLS`` rows at most reach the driver."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CELLS, dtype="i8")
        for b in batches:
            for x in b.column(0):
                t = x.as_py() or ""
                base = base_spans(t)
                for k, a, e in [*base, *candidates(t, base)]:
                    table[cell(evidence(t, k, a, e))] += 1
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), pa.array(table[at])],
                                         names=["cell", "n"])

    out = np.zeros(CELLS, dtype="i8")
    parts = docs.select(F.col(text).cast("string")).mapInArrow(fill, "cell int, n long")
    for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out


def spans(text: str, private: np.ndarray) -> tuple[list, list]:
    """Base spans and added spans (kind, start, end); ``private`` by cell."""
    base, added, end = base_spans(text), [], 0
    for k, a, b in candidates(text, base):
        if a >= end and private[cell(evidence(text, k, a, b))]:
            added.append((k, a, b))
            end = b
    return base, added


def joined(found) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(found))


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts per kind, base_sha256 and all spans of every row."""
    private = model.probability >= threshold

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, n_added long, "
                  "base_sha256 string, spans string")
    def find(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            base, more = spans(t or "", private)
            n = [sum(s[0] == k for s in base) for k in range(len(BASE))]
            out.append((*n, len(more), hashlib.sha256(joined(base).encode()).hexdigest(),
                        joined(base + more)))
        return pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "n_added",
                                          "base_sha256", "spans"])

    return docs.select(F.col(doc_id).alias(doc_id), find(F.col(text).cast("string")).alias("f")) \
        .select(doc_id, "f.*")


pickle_by_value(__name__)
