"""Odd rows that the operators' docstrings speak of: broken, very long, repeated, skewed."""

import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

import plain
from keyfold.llm import (op2_lines, op3_quality, op4_warc, op5_url, op6_mix, op9_simhash, outcomes)


# --- op2 --------------------------------------------------------------------

@pytest.mark.parametrize("piece", ["<script>", "<script", "<!--", "<style>", "<", "<p ", "<p", "</", "<a href='x' ", "</script",
                                   "<script></script ", "&amp;"])
def test_broken_markup_takes_time_in_proportion(spark, piece):
    html = "<p>before</p>" + piece * (400_000 // len(piece))
    df = spark.createDataFrame([(html,)], "html string")
    df.select(F.size(op2_lines.lines_of(F.lit("<p>x</p>")))).collect()
    t0 = time.perf_counter()
    lines = df.select(op2_lines.lines_of(F.col("html")).alias("l")).first().l
    assert time.perf_counter() - t0 < 8 and lines[0].startswith("before")


def test_what_is_not_closed_hides_the_rest(spark):
    for html, want in [("a<script>b</script>c<script>d", ["a c"]), ("a<!-- b --> c <!-- d", ["a c"]),
                       ("1 < 2 and <b>3</b> > 2", ["1 < 2 and 3 > 2"]), ("x<p y", ["x"]), ("x<b", ["x"]), ("<>a", ["<>a"]),
                       ("a<style>p{}</STYLE >b", ["a b"]), (None, []), ("x<", ["x<"])]:
        df = spark.createDataFrame([(html,)], "html string")
        assert df.select(op2_lines.lines_of(F.col("html")).alias("l")).first().l == want, html


def test_repeated_pages_count_as_pages(spark):
    rows = [(1, "http://a.org", "<p>Menu</p><p>own</p>")] * 3 + [(2, "http://a.org", "<p>Menu</p><p>" + "x " * 300_000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = op2_lines.dedup(op2_lines.split_lines(df)).collect()
    assert sorted((r.page, r.n_lines, r.n_dropped) for r in out) == [(1, 2, 2)] * 3 + [(2, 2, 1)]


# --- op3 --------------------------------------------------------------------

def test_long_texts_of_many_words_and_other_languages(spark):
    rng = random.Random(2)
    long = " ".join(f"the w{rng.randrange(10**6)} of" for _ in range(40_000))
    other = " ".join(f"słowo{i} zdanie{i} jest." for i in range(40))
    bare = " ".join(f"word{i} other{i} thing." for i in range(40))
    rows = [(1, long, "en"), (2, other, "pl"), (3, bare, "en"), (4, bare, None), (5, bare, "xx"), (6, bare, "en"), (6, bare, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.row.doc_id: r for r in op3_quality.judge(df, keep=["doc_id"], lang="lang").collect()}
    assert out[1].kept and out[1].m.n_words == 120_000
    assert [out[i].kept for i in (2, 3, 4, 5, 6)] == [True, False, True, True, False]
    assert set(out[3].failed_rules) == {"few_stop_words", "stop_word_share"}
    assert sorted(r.doc_id for r in op3_quality.keep_good(df).collect()) == [1, 2, 4, 5]
    assert sorted(r.doc_id for r in op3_quality.keep_good(df.drop("lang")).collect()) == [1, 2, 3, 4, 5, 6, 6]


# --- op4 --------------------------------------------------------------------

def test_archives_are_bounded_whatever_the_sizes(spark, tmp_path):
    rows = [(i, f"http://a.org/{i}", ("é" * 5000 if i < 60 else "x") + str(i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    path = str(tmp_path / "w")
    op4_warc.write_archives(df, path, archive=30_000)
    import gzip
    sizes = [len(gzip.open(os.path.join(d, f)).read()) for d, _, fs in os.walk(path) for f in fs if f.endswith(".gz")]
    assert max(sizes) <= 30_000 + 11_000 and len(sizes) > 20
    index = op4_warc.read_archives(spark, path)
    assert index.count() == 1500 and index.select("run").distinct().count() == len(sizes)


def test_a_very_long_payload(spark):
    df = spark.createDataFrame([(1, "http://a.org/" + "p" * 100_000, "ä" * 3_000_000), (2, "http://a.org/", "ä" * 3_000_000)],
                               "page_id long, url string, html string")
    out = {r.page_id: r for r in op4_warc.histories(df).collect()}
    assert out[1].payload_bytes == 6_000_000 and out[1].refers_to == 2 and out[2].record_type == "response"


# --- op5 --------------------------------------------------------------------

def test_suffixes_from_a_table_and_a_very_long_url(spark):
    hosts = ["a.github.io", "b.github.io", "x.y.co.uk", "co.uk", "uk", "", "www.city.kawasaki.jp", "1.2.3.4:80",
             "n.com.mx", "." * 3, "h" * 200_000 + ".org"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    listed = spark.createDataFrame([("github.io",), ("CO.UK",), ("city.kawasaki.jp",), ("com.mx",), (None,), ("co.uk",)], "suffix string")
    got = {r.host: (r.suffix, r.domain) for r in op5_url.with_domains(df, listed).collect()}
    assert len(got) == len(hosts) and got["a.github.io"] == ("github.io", "a.github.io")
    assert got["x.y.co.uk"] == ("co.uk", "y.co.uk") and got["co.uk"] == ("co.uk", "co.uk") and got[""] == ("", "")
    assert got["www.city.kawasaki.jp"] == ("city.kawasaki.jp", "www.city.kawasaki.jp")
    assert got["1.2.3.4:80"][1] == "1.2.3.4:80" and got["n.com.mx"] == ("com.mx", "n.com.mx") and got["uk"] == ("uk", "uk")
    default = {r.host: r.domain for r in op5_url.with_domains(df).collect()}
    assert default["a.github.io"] == "github.io" and default["x.y.co.uk"] == "y.co.uk"
    pages = spark.createDataFrame([(1, "http://" + "h" * 200_000 + ".org/" + "p" * 500_000 + "?q"), (1, None), (1, None)],
                                  "page_id long, url string")
    out = op5_url.judge(pages, spark.createDataFrame([], "id long, bad long")).collect()
    assert sorted(len(r.path) for r in out) == [0, 0, 500_001] and {r.rule for r in out} == {"org/", None}


def test_pages_take_the_labels_of_the_text_they_show(spark):
    a, b, both = ["line %s %d of a text that is long enough to stand for it" % (k, i) for k, i in (("a", 1), ("b", 1), ("c", 1))]
    docs = spark.createDataFrame([(1, f"{a}\n{both}"), (2, f"{b}\n {both}"), (3, "short"), (4, None), (5, f"{a} x")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, None), (2, 1, 0), (3, 0, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([(71, f"<p>{a}</p><p>{both}"), (72, f"<b>{b}</b>"), (73, f"<p>{both}</p>"), (74, "<p>short</p>"),
                                   (75, None), (76, f"<p>{a}</p><p>{b}</p>"), (77, f"{a} x")], "page_id long, html string")
    got = {r.id: r.bad for r in outcomes.page_outcomes(pages, docs, labels).collect()}
    assert got == {71: 1, 72: 0, 76: 1}  # what bad and good documents share says nothing
    assert outcomes.page_outcomes(pages, docs, labels.limit(0)).collect() == []


# --- op6 --------------------------------------------------------------------

def test_repeated_rows_share_their_copies(spark):
    rng = random.Random(3)
    rows = [(1, "w " * 5, "a", 7)] * 60 + [(1, "w " * 5, "a", 8)] * 3 + [(1, "w " * 5, "a", 9)] + [(None, None, "a", 1)] * 5 \
        + [(2, "", None, 2)] * 4 + [(i, "v " * rng.randrange(1, 9), rng.choice(["a", "b", None]), 0) for i in range(10, 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    sized = op6_mix.copies(op6_mix.sizes(df))
    want = Counter()
    for r in sized.collect():
        want[r.doc_id, r.source] += r.copies
    out = [tuple(r) for r in op6_mix.mix(df).collect()]
    assert Counter((i, s) for i, _, s, _ in out) == +want and set(out) <= set(rows)
    per, have = Counter(out), Counter(rows)
    assert all(per[r] <= 3 * have[r] for r in per) and out and sorted(out, key=repr) == sorted(
        (tuple(r) for r in op6_mix.mix(df.repartition(7)).collect()), key=repr)
    assert op6_mix.mix(df.limit(0)).collect() == [] and op6_mix.copies(op6_mix.sizes(df.limit(0))).collect() == []
    assert {r.size for r in sized.filter("doc_id is null").collect()} == {0}


# --- op9 --------------------------------------------------------------------

def test_groups_of_null_ids_and_of_nothing(spark):
    texts = [(None, "one two three four five"), (7, "one two three four five"), (3, "six seven eight nine ten"), (None, None),
             (None, ""), (None, "eleven twelve thirteen fourteen"), (3, "six seven eight nine ten")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    out = op9_simhash.groups_of(op9_simhash.signatures(df)).collect()
    fps = [plain.simhash(t) for _, t in texts]
    same = plain.components(fps)
    want = Counter()
    for (i, _), f, c in zip(texts, fps, same):
        ids = [j for (j, _), d in zip(texts, same) if d == c and j is not None]
        want[i, f - (1 << 64) if f >> 63 else f, min(ids, default=None)] += 1
    assert Counter((r.id, r.fp, r.component) for r in out) == want
    assert op9_simhash.groups_of(op9_simhash.signatures(df.limit(0))).collect() == []
