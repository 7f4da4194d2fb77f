"""Quality rules: a table of thresholds compiled into one Spark projection.

``measures`` adds the counts of a whole text, ``Rule`` rows compare two of them
(or one and a constant) in whole numbers, and ``compile_rules`` turns the table
into Boolean columns of a single ``select``.  Everything is built-in Spark
functions; no row leaves its partition and nothing is shuffled.

Defined cases: a null or empty text has no words, fails the base rules and is
dropped; a text in a language without stop words here, or in none that is named, is
not judged by them; repeated rows are judged one by one; columns of the input that are
not asked for are never touched, so their names cannot clash; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import SPACES, words

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BULLETS = ("-", "*", "•", "‣", "▪", "–")

#: Languages of the stop words; the rules on them judge no other text.
LANGUAGES = ("en", "fr", "de", "es")
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = tuple(
    "the be to of and that have with in is it for on was as are this by from at or an a he "
    "le la les de du des et que qui en un une dans pour par sur avec est au il ne pas plus "
    "der die das und in zu den von mit ist im nicht ein eine sich auf für dem als auch es "
    "el los las y una con por se del su para al lo como más".split())


@dataclass(frozen=True)
class Rule:
    """``scale * value`` must lie within ``low * per`` and ``high * per``.

    ``value`` and ``per`` name measures (``per`` None: the constant 1); whole
    numbers only, so no rounding decides a verdict.  With ``languages`` the rule is for
    texts in one of them.
    """

    name: str
    value: str
    per: str | None = None
    scale: int = 1
    low: int | None = None
    high: int | None = None
    languages: tuple[str, ...] | None = None

    def failed(self, m, lang: Column) -> Column:
        v, per = m(self.value) * self.scale, m(self.per) if self.per else F.lit(1)
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | (v < per * self.low)
        if self.high is not None:
            bad = bad | (v > per * self.high)
        if self.languages:
            bad = bad & F.coalesce(lang.isin(*self.languages), F.lit(False))
        return bad


#: The two rules every text has to meet first.
BASE_RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("repeats", "n_repeat_words", "n_words", 100, high=50),
)
#: Rules of the method, in percent (``scale`` 100) of ``per``.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2, high=16),
    Rule("symbols", "n_symbols", "n_words", 100, high=10),
    Rule("few_stop_words", "n_stop_words", low=2, languages=LANGUAGES),
    Rule("stop_word_share", "n_stop_words", "n_words", 100, low=2, languages=LANGUAGES),
    Rule("shouting", "n_upper", "word_chars", 100, high=30),
    Rule("dup_lines", "n_dup_lines", "n_lines", 100, high=60),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", 100, high=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", 100, high=30),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_upper", "n_lines",
            "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words")


#: Words of a text whose windows are looked up by two hashes.
LONG = 1 << 15


def _count(array: Column, keep) -> Column:
    return F.size(F.filter(array, keep)).cast("long")


def measures(docs: DataFrame, text: str = "text", keep: list[str] = (),
             lang: str | None = None) -> DataFrame:
    """``keep`` columns as struct ``row``, the counts of ``text`` as struct ``m``,
    and ``lang`` (null where no column is named).

    ``n_repeat_words`` counts the words that lie in a window of three words
    found twice or more in the text, the first included.  A text whose window
    hashes are all different has none.  In the others the hashes are sorted
    within the row, neighbours compared (by their words, where the hashes
    agree), and the covered words counted once.  The place of a window is packed
    into its hash; in a long text, where that leaves fewer bits and other windows of the same
    hash might stand between two equal ones, a second, independent hash is sorted as well.
    """
    of = F.col(f"`{lang}`").cast("string") if lang else F.lit(None).cast("string")
    d = docs.select(F.struct(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("given"),
                             of.alias("lang")).alias("row"),
                    F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    d = d.select("row", "t", words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n", -1),
                          lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("lines"))
    marks = F.regexp_replace("t", f"[^{UPPER}#*$%&|<>]+", "")
    starts = F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0)))
    d = d.select("row", "t", "w", "lines", marks.alias("marks"),
                 F.transform(starts, lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
                 .alias("grams"),
                 F.when(F.size("w") > LONG, F.transform(starts, lambda x, i: F.xxhash64(
                     F.get("w", i + 2), F.get("w", i + 1), x))).alias("grams2"))
    # Low bits of a sorted number hold the window's place, the others its hash.
    bits = F.ceil(F.log2(F.size("grams") + 1)).cast("int")
    place = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    packed = lambda grams: F.when(
        F.size(F.array_distinct(grams)) < F.size(grams), F.sort_array(F.transform(
            grams, lambda h, i: h.bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long")))))
    d = d.select(
        "row", "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.translate("marks", UPPER, "")).cast("long").alias("n_symbols"),
        F.length(F.translate("marks", SYMBOLS, "")).cast("long").alias("n_upper"),
        _count(F.col("w"), lambda x: x.isin(*STOP_WORDS)).alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _count(F.col("lines"), lambda x: F.substring(F.ltrim(x), 1, 1).isin(*BULLETS))
        .alias("n_bullet_lines"),
        _count(F.col("lines"), lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))
        .alias("n_ellipsis_lines"),
        place.alias("place"), packed("grams").alias("g"), packed("grams2").alias("g2"))

    def same(x, g, j):  # the words decide where the hashes agree
        y = F.get(g, j)
        p, q = [v.bitwiseAND(F.col("place")).cast("int") for v in (x, y)]
        equal = x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(F.col("place"))) == 0
        for k in range(3):
            equal = equal & (F.get("w", p + k) == F.get("w", q + k))
        return F.coalesce(equal, F.lit(False))

    def found(g):
        return F.coalesce(F.transform(
            F.filter(g, lambda x, i: F.when(i > 0, same(x, g, i - 1)).otherwise(False)
                     | same(x, g, i + 1)),
            lambda x: x.bitwiseAND(F.col("place"))), F.array().cast("array<bigint>"))

    d = d.select("row", *[m for m in MEASURES if m != "n_repeat_words"], F.sort_array(F.when(
        F.col("g2").isNull(), found("g")).otherwise(F.array_union(found("g"), found("g2")))).alias("at"))
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(
            F.get("at", i + 1) - p, F.lit(3).cast("long")))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    d = d.withColumn("n_repeat_words", covered)
    return d.select("row.given", "row.lang", F.struct(*MEASURES).alias("m")) \
        .withColumnRenamed("given", "row")


def compile_rules(rules, m, lang: Column) -> Column:
    """Names of the rules that fail, in the table's order."""
    return F.array_compact(F.array(*[F.when(r.failed(m, lang), F.lit(r.name)) for r in rules]))


def judge(docs: DataFrame, text: str = "text", keep: list[str] = (),
          base=BASE_RULES, rules=RULES, lang: str | None = None) -> DataFrame:
    """``row`` (the kept columns), ``m`` (the measures), ``base_failed``,
    ``failed_rules`` and ``kept``: one projection over the measures.  Without ``lang``, the
    column of the language, no rule of certain languages applies."""
    m = lambda name: F.col(f"m.{name}")
    d = measures(docs, text, keep, lang)
    failed = compile_rules((*base, *rules), m, F.col("lang"))
    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | r.failed(m, F.col("lang"))
    return d.select("row", "m", base_failed.alias("base_failed"), failed.alias("failed_rules"),
                    (F.size(failed) == 0).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", **kw) -> DataFrame:
    """The documents that pass every rule, columns as given."""
    # A filter on the verdict alone would be pushed below every projection, with
    # the measures written out in it again and again; the row number holds it.
    j = judge(docs, text, docs.columns, lang=lang if lang in docs.columns else None, **kw).withColumn("at", F.monotonically_increasing_id())
    return j.filter(F.col("kept") & (F.col("at") >= 0)).select("row.*")
