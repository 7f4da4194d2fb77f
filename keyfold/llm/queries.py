"""The queries ``opN_*`` and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm import op1_tiling as op1
from keyfold.llm import op10_secrets as op10
from keyfold.llm import op11_search as op11
from keyfold.llm import op12_pii as op12
from keyfold.llm import op13_centroids as op13
from keyfold.llm import op2_lines as op2
from keyfold.llm import op3_quality as op3
from keyfold.llm import op4_warc as op4
from keyfold.llm import op5_url as op5
from keyfold.llm import op6_mix as op6
from keyfold.llm import op7_pack as op7
from keyfold.llm import op8_quotes as op8
from keyfold.llm import op9_simhash as op9
from keyfold.llm import outcomes
from keyfold.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


WORD_SQL = r"[^\x20\x09-\x0D]+"


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its measures and the verdict of the rule table."""
    j = op3.judge(table(spark, sf_dir, "documents"), keep=["doc_id"], lang="lang")
    return j.select(F.col("row.doc_id").alias("doc_id"), *[f"m.{m}" for m in op3.MEASURES],
                    "base_failed", "kept",
                    F.concat_ws(",", "failed_rules").alias("failed_rules"))


def _rule_sql(r: op3.Rule) -> str:
    per = r.per or "1"
    parts = ([f"{r.scale} * {r.value} < {r.low} * {per}"] if r.low is not None else []) + \
        ([f"{r.scale} * {r.value} > {r.high} * {per}"] if r.high is not None else [])
    langs = f" AND coalesce(lang IN {r.languages}, false)" if r.languages else ""
    return "((" + " OR ".join(parts) + f"){langs})"


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(op3.STOP_WORDS))
_BULLETS = ", ".join(f"'{b}'" for b in op3.BULLETS)
_BLANK = r"[\x20\x09-\x0D]"
ORACLE["op3_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (
  SELECT r, doc_id, lang, t, regexp_extract_all(t, '{WORD_SQL}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD_SQL}')) AS lines
  FROM d),
pos AS (
  SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM w),
tri AS (
  SELECT r, p, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3
  FROM pos WINDOW o AS (PARTITION BY r ORDER BY p)),
dup AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, word, w2, w3) AS n FROM tri WHERE w3 IS NOT NULL),
cov AS (
  SELECT r, count(DISTINCT q) AS n FROM (
    SELECT r, unnest([p, p + 1, p + 2]) AS q FROM dup WHERE n > 1) GROUP BY r),
m AS (
  SELECT w.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{_BLANK}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
         CAST(len(list_filter(w, lambda x: x IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(lines, lambda x: substr(ltrim(x, ' '), 1, 1) IN ({_BULLETS}))) AS BIGINT)
           AS n_bullet_lines,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS BIGINT)
           AS n_ellipsis_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.r = cov.r),
v AS (
  SELECT *, ({" OR ".join(map(_rule_sql, op3.BASE_RULES))}) AS base_failed,
         concat_ws(',', {", ".join(f"CASE WHEN {_rule_sql(r)} THEN '{r.name}' END"
                                   for r in (*op3.BASE_RULES, *op3.RULES))}) AS failed_rules
  FROM m)
SELECT * EXCLUDE (lang), failed_rules = '' AS kept FROM v
"""


_ENTITIES = "t"
for _e, _c in op2.ENTITIES:
    _ENTITIES = "replace({}, '{}', '{}')".format(_ENTITIES, _e, _c.replace("'", "''"))
_TEXT_SQL = f"""regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '{op2.HIDDEN}', ' ', 'g'), '{op2.BLOCK}', chr(10), 'g'), '{op2.TAG}', '', 'g')"""


def _lines_sql(text: str) -> str:
    return f"""list_filter(list_transform(string_split(regexp_replace({text}, '[ \t\r\f]+', ' ', 'g'),
      chr(10)), lambda x: trim(x)), lambda x: x <> '')"""


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of the pages that show text of labelled documents."""
    return outcomes.page_outcomes(*[table(spark, sf_dir, t) for t in ("pages", "documents", "labels")])


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return op5.judge(table(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir))


def _fits_sql(h: str, p: str) -> str:
    return f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"


_RULES = sorted(op5.RULES, key=lambda r: -len(r[1] + r[2]))
_TWO = ", ".join(f"'{s}'" for s in op5.SECOND_LEVEL)


def _strength_sql(groups: str) -> str:
    return f"""(SELECT CASE WHEN coalesce(most, 0) = 0 OR more <= 0 THEN {op5.STRONGEST} ELSE
      least({op5.STRONGEST}, greatest({op5.WEAKEST}, 1 / least(1.0, more / most) - 1)) END FROM
      (SELECT sum(m * pow(b / m - prior, 2) - prior * (1 - prior)) AS more,
              sum((m - 1) * prior * (1 - prior)) AS most FROM {groups} WHERE m > 0))"""


ORACLE["op5_url_filters"] = rf"""
WITH doc_lines AS (
  SELECT CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad,
         unnest(list_distinct({_lines_sql("coalesce(text, '')")})) AS line
  FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL OR toxic IS NOT NULL),
stands AS (
  SELECT line, min(bad) AS bad FROM doc_lines WHERE length(line) >= {outcomes.LONG}
  GROUP BY line HAVING min(bad) = max(bad)),
shown AS (
  SELECT page_id, unnest(list_distinct({_lines_sql(_ENTITIES)})) AS line
  FROM (SELECT page_id, {_TEXT_SQL} AS t FROM pages)),
out AS (
  SELECT page_id, CASE WHEN 2 * sum(bad) >= count(*) THEN 1 ELSE 0 END AS bad
  FROM shown JOIN stands USING (line) GROUP BY page_id),
r AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r),
o AS (
  SELECT host, count(*) AS m, sum(bad) AS b FROM p JOIN out USING (page_id) GROUP BY host),
n AS (
  SELECT host, string_split(host, '.') AS l FROM (SELECT DISTINCT host FROM p)),
c AS (
  SELECT n.host, coalesce(m, 0) AS m, coalesce(b, 0) AS b,
         array_to_string(l[-2:], '.') AS two,
         CASE WHEN two IN ({_TWO}) THEN two ELSE l[-1] END AS suffix,
         CASE WHEN regexp_matches(n.host, '^[0-9.]+(:[0-9]+)?$') THEN n.host
              WHEN two IN ({_TWO}) THEN array_to_string(l[-3:], '.') ELSE two END AS domain
  FROM n LEFT JOIN o ON n.host = o.host),
s AS (
  SELECT suffix, sum(m) AS m, sum(b) AS b,
         (SELECT coalesce(sum(b)::DOUBLE / nullif(sum(m), 0), 0) FROM c) AS prior
  FROM c GROUP BY suffix),
sk AS (SELECT {_strength_sql('s')} AS k),
d AS (
  SELECT domain, sum(c.m) AS m, sum(c.b) AS b,
         any_value((s.b + k * prior) / (s.m + k)) AS prior
  FROM c JOIN s ON c.suffix = s.suffix, sk GROUP BY domain),
dk AS (SELECT {_strength_sql('d')} AS k),
h AS (
  SELECT host, c.m, c.b, (d.b + k * prior) / (d.m + k) AS prior
  FROM c JOIN d ON c.domain = d.domain, dk),
hk AS (SELECT {_strength_sql('h')} AS k),
ab AS (
  SELECT host, m, b, b + k * prior AS x, m - b + k * (1 - prior) AS y FROM h, hk),
v AS (
  SELECT host, m, b, CASE WHEN x / (x + y) - {op5.Z}
    * sqrt(x * y / (pow(x + y, 2) * (x + y + 1))) > {op5.MAX_BAD}
    THEN 'block' ELSE 'allow' END AS own FROM ab)
SELECT page_id, host, path,
  CASE {" ".join(f"WHEN {_fits_sql(h, x)} THEN '{h}{x}'" for _, h, x in _RULES)} END AS rule,
  CASE {" ".join(f"WHEN {_fits_sql(h, x)} THEN '{w}'" for w, h, x in _RULES)} ELSE own END AS verdict,
  CAST(m AS BIGINT) AS labelled, CAST(b AS BIGINT) AS labelled_bad
FROM p JOIN v USING (host)
"""


@query
def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    return op6.copies(op6.sizes(docs)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")


_W = ", ".join(map(str, op6.WEIGHTS))
ORACLE["op6_mix"] = rf"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [{_W}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(op6.WEIGHTS)} + 1] AS w
  FROM d GROUP BY source),
o AS (
  SELECT source, source_size, w,
         (sum(source_size) OVER () - coalesce(sum({op6.CAP} * source_size) OVER b, 0))::DOUBLE
         / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
  FROM s WINDOW b AS (ORDER BY {op6.CAP} * source_size / w, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT arg_min(level, {op6.CAP} * source_size / w) AS level FROM o
  WHERE {op6.CAP} * source_size > w * level),
t AS (
  SELECT source, source_size,
         CASE WHEN {op6.CAP} * source_size <= w * l.level THEN CAST({op6.CAP} * source_size AS DOUBLE)
              ELSE w * l.level END AS target,
         ('0x' || substr(md5('{op6.SEED}' || coalesce(source, '')), 1, 4))::INT / 65536.0::DOUBLE AS u
  FROM o, l),
k AS (
  SELECT doc_id, size, source_size, target, u,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS rank,
         CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE target / source_size END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, CAST(least(floor(u + rank * rate) - floor(u + (rank - 1) * rate), ceil(rate)) AS BIGINT)
    AS copies FROM k)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    sig = op9.groups_of(op9.signatures(table(spark, sf_dir, "documents")))
    return sig.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the item and its tiles."""
    found = op1.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                      short=True)
    return found.withColumn("tiles", F.array_join(F.transform("tiles", lambda t: F.concat_ws(
        ":", t["item_at"], t["doc_at"], t["words"])), ","))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed id matrix of all documents, row by row."""
    return op7.pack(table(spark, sf_dir, "documents"))


def secret_models(spark: SparkSession, sf_dir: str):
    """The ratio that op10 judges by: labelled samples and the words of all documents."""
    return op10.train(op10.count_labelled(op10.samples(spark)),
                      op10.count_words(table(spark, sf_dir, "documents")))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document; the models learn from all of them."""
    return op10.scan(table(spark, sf_dir, "documents"), secret_models(spark, sf_dir))


@query
def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, in the reply order of its conversation."""
    return op8.link(table(spark, sf_dir, "conversations"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without the boilerplate lines of its host."""
    out = op2.dedup(op2.split_lines(table(spark, sf_dir, "pages")))
    return out.select(F.col("page").alias("page_id"), "host", "n_lines", "n_dropped",
                      F.array_join("lines", "\n").alias("text"))


ORACLE["op2_line_dedup"] = rf"""
WITH h AS (
  SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
    {_TEXT_SQL} AS t FROM pages),
p AS (
  SELECT r, page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    {_lines_sql(_ENTITIES)} AS l FROM h),
n AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
s AS (
  SELECT host, line, count(*) AS n
  FROM (SELECT host, unnest(list_distinct(l)) AS line FROM p) GROUP BY host, line),
b AS (
  SELECT host, list(line) AS bad FROM s JOIN n USING (host)
  WHERE n >= {op2.LEAST} AND n > pages * {op2.RATIO} GROUP BY host),
k AS (
  SELECT page_id, p.host, CAST(len(l) AS BIGINT) AS n_lines,
         CASE WHEN bad IS NULL THEN l ELSE list_filter(l, lambda x: NOT list_contains(bad, x)) END
           AS kept FROM p LEFT JOIN b ON p.host = b.host)
SELECT page_id, host, n_lines, CAST(n_lines - len(kept) AS BIGINT) AS n_dropped,
       coalesce(array_to_string(kept, chr(10)), '') AS text FROM k
"""


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its archived record says, through the merged index."""
    return op4.histories(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey")


ORACLE["op4_warc"] = rf"""
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS sha FROM pages),
m AS (SELECT sha, max(page_id) AS of FROM p WHERE n >= {op4.SHARED} GROUP BY sha),
u AS (
  SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.sha AS payload_digest,
    CASE WHEN of IS NULL OR of IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END
      AS record_type,
    CASE WHEN of IS NOT DISTINCT FROM page_id THEN NULL ELSE of END AS refers_to,
    replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS v
  FROM p LEFT JOIN m ON p.sha = m.sha)
SELECT * EXCLUDE (v), CASE WHEN regexp_matches(v, '^[^:/?#]*://') THEN
    array_to_string(list_reverse(string_split(lower(
      regexp_extract(v, '^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.')), ',')
    || regexp_extract(v, '^[^:/?#]*://(?:[^/?#@]*@)?[^/?#:]*(:[0-9]*)?', 1) || ')'
    || lower(coalesce(nullif(regexp_extract(v,
      '^[^:/?#]*://(?:[^/?#@]*@)?[^/?#:]*(?::[0-9]*)?([^#]*)', 1), ''), '/'))
  ELSE lower(v) END AS urlkey FROM u
"""


@query
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return op11.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _terms_sql(text: str) -> str:
    return rf"""unnest(regexp_extract_all(translate(coalesce({text}, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{op11.TERM}'))"""


ORACLE["op11_search"] = rf"""
WITH t AS (SELECT r, {_terms_sql('text')} AS term FROM (
  SELECT row_number() OVER () AS r, text FROM documents)),
p AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY r),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM n),
m AS (SELECT r, 10 + (90 * n * docs) // length AS m FROM n, c),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, c GROUP BY term, docs),
i AS (SELECT row_number() OVER () AS i, item_id, text FROM (
  SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT DISTINCT i, item_id, {_terms_sql('text')} AS term FROM i),
s AS (
  SELECT i, item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY i, item_id, r),
d AS (SELECT row_number() OVER () AS r, doc_id FROM documents)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)
  AS INTEGER) AS rank, doc_id, score
FROM s JOIN d USING (r) WHERE score > 0
QUALIFY rank <= {op11.TOP}
"""


@query
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document; the model learns from all of them."""
    docs = table(spark, sf_dir, "documents")
    return op12.scan(docs, op12.train(op12.count(docs)))


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's cluster, distance and inertia."""
    return op13.cluster(table(spark, sf_dir, "embeddings"))


def _nearest_sql(n: int) -> str:
    """Every vector's nearest centroid of round ``n``; ties to the smaller number."""
    return f"""a{n} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, c := c)) AS b FROM (
    SELECT r, c, list_sum(list_transform(list_zip(v, m), lambda x: (x[1] - x[2]) * (x[1] - x[2])))
      AS d FROM e, c{n}) GROUP BY r)"""


def _round_sql(n: int) -> str:
    return f"""{_nearest_sql(n)},
s{n} AS (
  SELECT c, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
    SELECT b.c AS c, unnest(v) AS x, unnest(generate_series(1, len(v))) AS p
    FROM e JOIN a{n} USING (r)) GROUP BY c, p),
c{n + 1} AS MATERIALIZED (
  SELECT c{n}.c, coalesce(m2, m) AS m FROM c{n} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS m2 FROM s{n} GROUP BY c) z
  ON z.c = c{n}.c)"""


ORACLE["op13_centroids"] = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({op13.SCALE} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {op13.COMPONENTS} AND len(list_filter(embedding, lambda x: isfinite(x)))
        = {op13.COMPONENTS}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, m) - 1 AS INTEGER) AS c, m FROM (
    SELECT sha256('{op13.SALT}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v AS m FROM e
    ORDER BY h, m LIMIT {op13.CLUSTERS})),
{", ".join(_round_sql(i) for i in range(op13.ROUNDS))},
{_nearest_sql(op13.ROUNDS)}
SELECT vec_id, b.c AS cluster, CAST(b.d AS BIGINT) AS distance,
       CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM e JOIN a{op13.ROUNDS} USING (r) JOIN c{op13.ROUNDS} ON c{op13.ROUNDS}.c = b.c
"""
