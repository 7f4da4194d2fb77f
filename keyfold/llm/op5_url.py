"""URL filter: fixed rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host, registered domain and suffix.  At
each level a beta-binomial prior is centred on the level above (suffix on all
outcomes, domain on its suffix, host on its domain); its strength is the
moment estimate over all groups of the level.  A host is blocked when the
lower bound of its posterior share of bad pages exceeds ``max_bad``.

Built-in Spark functions only.  Counts are partially aggregated before they
are shuffled; what meets the pages again is one row per host, on a plain join
that Spark may broadcast by size or split where a host is hot.  Two one-row
sums (the prior strengths) reach the driver.

Defined cases: a null url or one without ``://`` has empty host and path and
is judged by what the outcomes of empty hosts and the priors say; an outcome
whose labels are all null is none; repeated rows count and are judged one by
one; no outcomes at all allow everything no rule blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import ascii_lower, written

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"),
         ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Public suffixes of two labels, where no table of suffixes is given; every other
#: suffix is the last label.
SECOND_LEVEL = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp",
                "ne.jp", "or.jp", "com.br", "com.cn", "co.in", "co.kr", "co.nz", "co.za")
MAX_BAD = 0.3
Z = 1.645
WEAKEST, STRONGEST = 1.0, 1000.0


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` with suffix and registered domain.

    ``suffixes`` has a column suffix: public suffixes of two or three labels, such as a
    public suffix file read by Spark; the longest that ends the host counts, else the
    last label.  An address in digits is its own domain.
    """
    if suffixes is None:
        suffixes = hosts.sparkSession.createDataFrame([(s,) for s in SECOND_LEVEL], "suffix string")
    listed = suffixes.select(F.lower(F.col("suffix")).alias("_s")).filter("_s is not null").distinct()
    labels = F.size(F.split("host", r"\.", -1))
    d = hosts
    for n in (2, 3):  # one row per host and per suffix
        tail = F.when(labels >= n, F.substring_index("host", ".", -n))
        d = d.join(listed.withColumnRenamed("_s", f"_s{n}"), tail == F.col(f"_s{n}"), "left")
    n = F.when(F.col("_s3").isNotNull(), 3).when(F.col("_s2").isNotNull(), 2).otherwise(1)
    tail = lambda k: F.array_join(F.slice(
        F.split("host", r"\.", -1), F.greatest(labels - k + 1, F.lit(1)), k), ".")
    digits = F.col("host").rlike(r"^[0-9.]+(:[0-9]+)?$")
    return d.withColumn("_n", n).withColumn("suffix", tail(F.col("_n"))).withColumn(
        "domain", F.when(digits, F.col("host")).otherwise(tail(F.col("_n") + 1))).drop("_n", "_s2", "_s3")


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame, n: str, bad: str, mean: str) -> float:
    """Moment estimate of a prior's strength from groups that share its mean."""
    m, size, b = F.col(mean), F.col(n), F.col(bad)
    v = m * (1 - m)
    x = groups.filter(size > 0).agg(
        F.sum(size * F.pow(b / size - m, F.lit(2)) - v).alias("more"),
        F.sum((size - 1) * v).alias("most")).first()
    if not x["most"]:
        return STRONGEST
    rho = min(1.0, max(0.0, x["more"] / x["most"]))
    return STRONGEST if rho == 0 else min(STRONGEST, max(WEAKEST, 1 / rho - 1))


def _level(counts: DataFrame, key: str, parent: str | None, means: DataFrame | None,
           base: float, n: str, bad: str) -> tuple[DataFrame, float]:
    """Counts per ``key`` with the prior mean ``prior`` from the level above."""
    keys = [key] + ([parent] if parent else [])
    g = counts.groupBy(*keys).agg(F.sum("n").alias(n), F.sum("bad").alias(bad))
    g = g.join(means, parent) if parent else g.withColumn("prior", F.lit(base))
    return g, _strength(g, n, bad, "prior")


def reputation(hosts: DataFrame, outcomes: DataFrame, z: float = Z,
               suffixes: DataFrame | None = None) -> DataFrame:
    """Per host of ``hosts`` (column host, one row each): ``labelled``, ``bad``
    and ``bad_at_least``, the lower posterior bound of its bad share.

    ``outcomes`` has a row per labelled page: host, bad (0/1).
    """
    per_host = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum("bad").alias("bad"))
    counts = with_domains(hosts.select("host"), suffixes).join(per_host, "host", "left").select(
        "host", "domain", "suffix", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("bad", F.lit(0)).alias("bad"))
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    base = total["bad"] / total["n"] if total["n"] else 0.0

    def mean(k):
        return ((F.col("b") + k * F.col("prior")) / (F.col("m") + k))

    s, k = _level(counts, "suffix", None, None, base, "m", "b")
    s_mean = s.select("suffix", mean(k).alias("prior"))
    d, k = _level(counts, "domain", "suffix", s_mean, base, "m", "b")
    d_mean = d.select("domain", mean(k).alias("prior"))
    h = counts.join(d_mean, "domain")
    k = _strength(h, "n", "bad", "prior")
    a = F.col("bad") + k * F.col("prior")
    b = F.col("n") - F.col("bad") + k * (1 - F.col("prior"))
    low = a / (a + b) - z * F.sqrt(a * b / (F.pow(a + b, F.lit(2)) * (a + b + 1)))
    return h.select("host", F.col("n").alias("labelled"), "bad", low.alias("bad_at_least"))


def judge(pages: DataFrame, labels: DataFrame, page: str = "page_id", url: str = "url",
          rules=RULES, max_bad: float = MAX_BAD, z: float = Z,
          suffixes: DataFrame | None = None) -> DataFrame:
    """``page``, host, path, rule, verdict, and the host's counts, per row of ``pages``.

    ``labels`` holds outcomes by page number: id, bad (0/1, null: none).
    """
    host, path = host_path(F.col(url))
    p = pages.select(F.col(page).alias("page"), host.alias("host"), path.alias("path"))
    outcomes = p.join(labels.filter("bad is not null"), F.col("page") == F.col("id")) \
        .select("host", "bad")
    # a host of any size is one row here, counted before the shuffle
    hosts = p.groupBy("host").agg(F.count(F.lit(1)).alias("_pages")).select("host")
    # from a table, so that the pages of a hot host may split over tasks
    known = written(reputation(hosts, outcomes, z, suffixes), "url-hosts")
    rule, fixed = apply_rules(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_at_least") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return p.join(known, "host", "left").select(
        F.col("page").alias(page), "host", "path", rule.alias("rule"),
        F.coalesce(fixed, own).alias("verdict"), "labelled", F.col("bad").alias("labelled_bad"))
