"""Chat formatting by quotation linking.

Messages quote others with leading ``>`` marks, one per level.  Each message is
parsed into its own text and its quoted passages by level; passages, their
paragraphs and lines are normalised (ASCII lower case, single spaces) and hashed,
and so are the whole, the paragraphs and the lines of every message's own text.  A quoted unit
links to the latest earlier message of its conversation that holds the same
unit (an as-of join on conversation and hash, cut into ranges of turns so that
a line frequent in a long conversation spreads over tasks).  A passage that finds
no unit (part of a line, or a paragraph cut otherwise) is looked up by its rarest
word shingles in its conversation, and links to the latest earlier message whose
own text holds all of it; one of fewer words than a shingle is not.  A message replies
to the message that matches most bytes of its first-level quotes, the
latest of equals.  Roots are found by pointer doubling over the linked messages.

A conversation in reply order lists its threads by the turn of their root, each
thread by turn: every reply stands after what it replies to.  Positions come
from ``ordered_rank``, so no task holds a conversation.

Defined cases: null text is an empty message; the text of a message without
quotes is left as it is; a null conversation is one
conversation by itself; a message whose turn is null quotes nothing, is quoted
by nothing and stands last; rows that repeat a turn are one message to those
who quote them and are each put out; quotes of unknown passages are removed
like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import ordered_rank, written
from keyfold.operators.running import run_max, running
from keyfold.session import pickle_by_value

_MARKS = re.compile(r"^(?:[ \t]*>)+[ \t]?")
_PARAGRAPH = re.compile(r"\n\s*\n")
#: A line that introduces a quote: removed with it (fixed wordings).
_INTRO = re.compile(r"^.{0,200}(?:wrote|schrieb|a écrit|escribió) ?:\s*$")
#: Turns of one conversation and unit that meet in one group of the as-of join.
WIDTH = 4096
#: Words of a shingle, and how many of a passage's rarest are looked up.
SHINGLE = 3
RAREST = 3


def normalised(text: str) -> bytes:
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split())


def _units(parts) -> dict[int, int]:
    """hash -> bytes of the normalised parts that hold any."""
    import xxhash

    out = {}
    for n in map(normalised, parts):
        if n:
            h = xxhash.xxh64_intdigest(n)
            out[h - (1 << 64) if h >> 63 else h] = len(n)
    return out


def shingles(norm: str) -> list[int]:
    """Hashes of the runs of ``SHINGLE`` words of a normalised text."""
    w = norm.split(" ")
    return list(_units(" ".join(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)))


def parse(text: str | None) -> tuple[str, dict[int, int], list[tuple[int, int, int, int]], list[str]]:
    """Own text, its units, the quoted units as (level, hash, bytes, passage), and
    the normalised passages."""
    own, passages, level = [], [], 0
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        now = marks[0].count(">") if marks else 0
        if now == 0:
            own.append(line)
        else:
            if level == 0:  # a quote begins: drop the line that introduces it
                while own and not own[-1].strip() and len(own) > 1 and _INTRO.match(own[-2]):
                    own.pop()
                if own and _INTRO.match(own[-1]):
                    own.pop()
            if now != level:
                passages.append((now, []))
            passages[-1][1].append(line[marks.end():])
        level = now
    body = "\n".join(own)
    if passages:
        body = re.sub(r"\n{3,}", "\n\n", body).strip("\n")
    units = _units([body, *_PARAGRAPH.split(body), *own])
    whole = ["\n".join(lines) for _, lines in passages]
    quoted = [(lv, h, n, i) for i, (lv, lines) in enumerate(passages)
              for h, n in _units([whole[i], *_PARAGRAPH.split(whole[i]), *lines]).items()]
    return body, units, quoted, [normalised(x).decode("utf-8", "surrogatepass") for x in whole]


def _partial(m: DataFrame, found: DataFrame) -> DataFrame:
    """c, turn, row, level, chars and source of passages that found no unit but
    lie within the own text of an earlier message."""
    @F.pandas_udf("array<bigint>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t) for t in texts])

    @F.pandas_udf("string")
    def norm(texts: pd.Series) -> pd.Series:
        return pd.Series([normalised(t).decode("utf-8", "surrogatepass") for t in texts])

    node, one = ["c", "turn", "row"], ["c", "turn", "row", "passage", "level"]
    m = m.filter("turn is not null")
    units = m.select(*node, F.explode("quotes").alias("q")).select(*node, "q.*")
    hit = found.select(*node, "level", "unit").distinct().withColumn("hit", F.lit(1))
    lost = units.join(hit, [*node, "level", "unit"], "left").groupBy(*one) \
        .agg(F.max("hit").alias("hit")).filter("hit is null").drop("hit")
    texts = m.select(*node, F.posexplode("passages").alias("passage", "quoted")).distinct()
    lost = written(lost.join(texts, [*node, "passage"]), "quotes-lost")
    # from tables, so that a shingle or conversation met very often may split
    wanted = written(lost.select(*one, F.explode(hashed("quoted")).alias("unit")), "quotes-shingles")
    where = lost.select("c").distinct()
    own = written(m.join(where, "c", "left_semi").select("c", "turn", norm("body").alias("norm"))
                  .distinct(), "quotes-own")
    asked = wanted.select("c", "unit").distinct()
    held = written(own.select("c", F.col("turn").alias("source"), F.explode(hashed("norm"))
                              .alias("unit")).join(asked, ["c", "unit"], "left_semi").distinct(),
                   "quotes-held")
    often = written(held.groupBy("c", "unit").agg(F.count(F.lit(1)).alias("n")), "quotes-often")
    rare = wanted.join(often, ["c", "unit"]).groupBy(*one).agg(F.slice(F.sort_array(
        F.collect_list(F.struct("n", "unit"))), 1, RAREST).alias("x"))
    rare = rare.select(*one, F.explode("x.unit").alias("unit"))
    met = rare.join(held, ["c", "unit"]).filter("source < turn").select(*one, "source").distinct()
    met = met.join(lost, one).join(own.withColumnRenamed("turn", "source"), ["c", "source"])
    return met.filter(F.contains("norm", "quoted")).groupBy(*one).agg(
        F.max("source").alias("source"), F.first(F.octet_length("quoted")).alias("chars"))


def link(messages: DataFrame, conv="conv_id", turn="turn", role="role",
         text="text") -> DataFrame:
    """Per message: conv, turn, role, text without quotes, parent_turn, root_turn,
    n_quotes, links (level:turn of each linked passage), position."""
    @F.pandas_udf("body string, units array<bigint>, "
                  "quotes array<struct<level:int,unit:bigint,chars:int,passage:int>>, "
                  "passages array<string>")
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = [parse(t) for t in texts]
        return pd.DataFrame({
            "body": [r[0] for r in rows], "units": [list(r[1]) for r in rows],
            "quotes": [[{"level": lv, "unit": h, "chars": n, "passage": i}
                        for lv, h, n, i in r[2]] for r in rows],
            "passages": [r[3] for r in rows]})

    m = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                        F.col(role).alias("role"), read(F.col(text).cast("string")).alias("p"))
    # a key that is never null, so that conversations without one meet as well
    m = m.select("conv", F.xxhash64(F.col("conv").isNull(), "conv").alias("c"),
                 F.col("turn").cast("long").alias("turn"), "role", "p.*")
    m = written(m.withColumn("row", F.xxhash64("conv", "turn", "role", "body", "quotes")),
                "quotes-parsed")

    quoted = m.filter("turn is not null").select(
        "c", "turn", "row", F.explode("quotes").alias("q")) \
        .select("c", "turn", "row", "q.level", "q.unit", "q.chars").distinct()
    quoted = written(quoted, "quotes-units")
    wanted = written(quoted.select("c", "unit").distinct(), "quotes-wanted")
    held = m.filter("turn is not null").select("c", "turn", F.explode("units").alias("unit")) \
        .join(wanted, ["c", "unit"], "left_semi").distinct()
    # quotes stand before the messages of their own turn: only earlier ones count
    both = quoted.select("c", "unit", "turn", F.lit(0).alias("kind"), "row", "level", "chars") \
        .unionByName(held.select("c", "unit", "turn", F.lit(1).alias("kind")),
                     allowMissingColumns=True)
    source = F.when(F.col("kind") == 1, F.col("turn"))
    found = running(both, ["c", "unit"], ["turn", "kind", "row", "level"],
                    [run_max(source, "source")], bucket_width=WIDTH)
    found = written(found.filter("kind = 0 and source is not null")
                    .select("c", "turn", "row", "level", "unit", "chars", "source"),
                    "quotes-found")
    linked = ["c", "turn", "row", "level", "chars", "source"]
    found = found.select(linked).unionByName(
        written(_partial(m, found).select(linked), "quotes-partial"))

    votes = found.filter("level = 1").groupBy("c", "turn", "row", "source") \
        .agg(F.sum("chars").alias("n"))
    parent = votes.groupBy("c", "turn", "row").agg(F.max(F.struct("n", "source")).alias("x")) \
        .select("c", "turn", "row", F.col("x.source").alias("parent_turn"))
    # rows that repeat a turn stand for one message: its earliest parent leads on
    up = written(parent.groupBy("c", "turn").agg(F.min("parent_turn").alias("up")), "quotes-up")
    while True:  # pointer doubling: the way to the root halves every round
        above = up.select("c", F.col("turn").alias("up"), F.col("up").alias("next"))
        step = up.join(above, ["c", "up"], "left")
        moved = written(step.select("c", "turn", F.coalesce("next", "up").alias("up"),
                                    F.col("next").isNotNull().alias("moved")), "quotes-up")
        up = moved.drop("moved")
        if not moved.filter("moved").limit(1).count():
            break
    links = found.groupBy("c", "turn", "row").agg(F.array_join(F.array_sort(F.collect_set(
        F.concat_ws(":", "level", "source"))), ",").alias("links"))

    node = ["c", "turn", "row"]
    # repeated rows are told apart by their number in the order alone
    flat = m.select("c", "turn", "row").join(parent, node, "left").join(links, node, "left")
    flat = flat.join(up.withColumnRenamed("up", "root_turn"), ["c", "turn"], "left")
    flat = flat.withColumn("root_turn", F.when(F.col("parent_turn").isNotNull(),
                                               F.col("root_turn")).otherwise(F.col("turn")))
    order = [F.col("root_turn"), F.col("turn"), F.col("row")]
    ranked = ordered_rank(flat, ["c"], order, "quotes-order", "position")
    first = ranked.groupBy(*[F.coalesce("turn", F.lit(-1)).alias("t") if x == "turn" else F.col(x)
                             for x in node], "parent_turn", "root_turn", "links") \
        .agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n"))
    one = m.withColumn("t", F.coalesce("turn", F.lit(-1))).groupBy("c", "t", "row").agg(
        F.min(F.struct("conv", "turn", "role", "body", F.size("quotes").alias("n_quotes")))
        .alias("x"))
    out = one.join(first, ["c", "t", "row"])
    out = out.select("x.*", "parent_turn", "root_turn", F.coalesce("links", F.lit("")).alias("links"),
                     F.explode(F.sequence("first", F.col("first") + F.col("n") - 1))
                     .alias("position"))
    return out.select(F.col("conv").alias(conv), "turn", "role", F.col("body").alias(text),
                      "parent_turn", "root_turn", "n_quotes", "links", "position")


pickle_by_value(__name__)
