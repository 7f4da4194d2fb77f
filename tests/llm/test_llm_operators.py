"""Operators on odd rows and against plain versions, on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from keyfold.llm import (op1_tiling, op2_lines, op3_quality, op4_warc, op5_url, op6_mix, op7_pack,
                         op8_quotes, op9_simhash, op10_secrets)
from keyfold.llm.common import ordered_rank
from keyfold.llm.components import components


def sent(words, n=9):
    rng = random.Random(7)
    return " ".join(rng.choice(words) for _ in range(n))


# --- op1 --------------------------------------------------------------------

def test_tiles_equal_the_published_greedy_algorithm():
    rng = random.Random(1)
    for _ in range(300):
        v, k = rng.choice([2, 4, 12]), rng.choice([2, 3, 5])
        item = [rng.randrange(v) for _ in range(rng.randrange(5, 30))]
        doc = [rng.randrange(v) for _ in range(rng.randrange(5, 50))]
        if rng.random() < .7:  # passages in another order
            cut = rng.randrange(len(item))
            doc = doc[:5] + item[cut:] + doc[5:10] + item[:cut] + doc[10:]
        own, all_ = [op1_tiling.seeds(op1_tiling.tokens(" ".join(f"w{x}" for x in y)), k)
                     for y in (item, doc)]
        at = np.flatnonzero(np.isin(all_, own))
        assert (op1_tiling.tile(own, at, all_[at], k) if len(at) else []) \
            == plain.tiles(item, doc, k)


def test_rows_under_one_id_are_tiled_apart(spark):
    item = [f"w{i}" for i in range(20)]
    other = [f"v{i}" for i in range(10)]
    halves = [" ".join(item[:10] + other), " ".join(other + item[10:])]
    # the whole item, and a text whose seeds lie at the same places
    whole, clash = " ".join(item), " ".join(item[10:] + item[:8] + other[:2])
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for i in (None, 7):
        df = spark.createDataFrame([(i, t) for t in halves], "doc_id long, text string")
        assert op1_tiling.leaks(df, items).count() == 0
        df = spark.createDataFrame([(i, t) for t in (whole, clash, whole)], "doc_id long, text string")
        got = op1_tiling.leaks(df, items).collect()
        assert sorted((r.doc_id, r.covered) for r in got if r.doc_id == i) == [(i, 18), (i, 20)]
        assert len(got) == 2 and {r.covered: len(r.tiles) for r in got} == {20: 1, 18: 2}


def test_items_shorter_than_a_seed(spark):
    items = spark.createDataFrame([(1, "Who was Ada?"), (2, "yes"), (None, "a b c d"), (4, ""), (5, None)],
                                  "item_id int, text string")
    docs = spark.createDataFrame(
        [(1, "who was ada"), (2, "intro line\nWho was Ada?\nwho  was ada\nend"), (3, "ask who was Ada? now please"),
         (4, "who was\nada"), (None, "x\n\na b, c d\n"), (6, None), (7, ""), (8, "yes"), (9, "yes and no")],
        "doc_id int, text string")
    got = {(r.doc_id, r.item_id, r.covered, r.tiles[0].doc_at) for r in
           op1_tiling.leaks(docs, items, short=True).collect()}
    assert got == {(1, 1, 3, 0), (2, 1, 3, 2), (4, 1, 3, 0), (None, None, 4, 1), (8, 2, 1, 0)}
    kept = op1_tiling.drop_leaks(docs, items, short=True).collect()
    assert sorted(r.doc_id for r in kept) == [3, 6, 7, 9]
    assert op1_tiling.leaks(docs, items.limit(0), short=True).count() == 0


def test_stage_and_query_take_short_items(spark, tmp_path):
    import corpus_pipeline
    from keyfold.llm.queries import QUERIES
    spark.createDataFrame([(1, "What is a join?\nmore")], "doc_id int, text string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "what is a join")], "item_id int, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    assert QUERIES["op1_decontamination"](spark, str(tmp_path)).first().tiles == "0:0:4"
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.decontamination(spark, docs, str(tmp_path)).count() == 0


def test_tokens_do_not_depend_on_pieces(monkeypatch):
    text = "Ünïcode wörds, and some MORE words " * 50
    whole = op1_tiling.tokens(text)
    monkeypatch.setattr(op1_tiling, "PIECE", 40)
    assert (op1_tiling.tokens(text) == whole).all() and len(set(whole.tolist())) == 6


def test_leaks_reordered_short_null_and_repeated(spark):
    w = [f"w{i}" for i in range(20)]
    items = spark.createDataFrame(
        [(1, " ".join(w)), (1, " ".join(w)), (2, "too short item"), (3, None), (4, ""), (None, "a b c d e f")],
        "item_id int, text string")
    docs = spark.createDataFrame(
        [(10, "x y " + " ".join(w[10:]) + " z " + " ".join(w[:10])), (10, " ".join(w)),
         (11, " ".join(w[:12])), (12, None), (13, ""), (14, "too short item"),
         (None, "q a B, c d e f"), (15, " ".join(w).upper() * 1)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in op1_tiling.leaks(docs, items).collect()}
    assert got == {(10, 1), (None, None), (15, 1)}
    assert op1_tiling.leaks(docs, items.limit(0)).count() == 0
    assert op1_tiling.leaks(docs.limit(0), items).count() == 0
    kept = op1_tiling.drop_leaks(docs, items).collect()
    assert sorted(r.doc_id for r in kept) == [11, 12, 13, 14]


# --- op2 --------------------------------------------------------------------

def test_lines(spark):
    page = lambda *x: "".join(f"<p>{y}</p>" for y in x)
    rows = [(i, "http://A.org/x", page("Menu", f"own {i}", "Menu")) for i in range(4)] + \
        [(9, "http://b.org/", page("Menu", "b")), (10, None, None), (11, "nourl", page("Menu")),
         (None, "http://a.org", "<script>Menu</script> plain &amp; simple")]
    df = spark.createDataFrame([r + ("x", 1) for r in rows],
                               "page_id long, url string, html string, lines string, bad int")
    out = {r.page: r for r in op2_lines.dedup(op2_lines.split_lines(df)).collect()}
    assert out[0].lines == ["own 0"] and out[0].n_dropped == 2
    assert out[9].lines == ["Menu", "b"] and out[10].lines == [] and out[11].lines == ["Menu"]
    assert out[None].lines == ["plain & simple"]
    assert op2_lines.dedup(op2_lines.split_lines(df.limit(0))).count() == 0


# --- op3 --------------------------------------------------------------------

def test_quality_measures(spark):
    text = "a b c a b c\n\nx\n x\nx\n*** a b c"
    df = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "", 0), (None, "A" * 70_000, 0),
                                (4, "one two one two one", 0)], "doc_id long, text string, m int")
    out = {r.row.doc_id: r for r in op3_quality.judge(df, keep=["doc_id", "m"]).collect()}
    m = out[1].m
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines) == (13, 15, 3, 1)
    # a b c three times and c a b, b c a not: nine words, and none of x x x
    assert m.n_repeat_words == 9
    assert out[2].m.n_words == 0 and out[2].base_failed and not out[2].kept
    assert out[4].m.n_repeat_words == 5 and out[None].m.n_upper == 70_000
    assert op3_quality.keep_good(df.limit(0)).count() == 0


@pytest.mark.parametrize("long", [op3_quality.LONG, 0, 9])
def test_quality_repeats_by_brute_force(spark, monkeypatch, long):
    monkeypatch.setattr(op3_quality, "LONG", long)
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op3_quality.judge(df, keep=["doc_id"]).collect():
        w = texts[r.row.doc_id].split()
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        assert r.m.n_repeat_words == len(hit)


# --- op4 --------------------------------------------------------------------

def test_loser_tree_merges_any_runs():
    rng = random.Random(5)
    for k in range(9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(6))) for _ in range(k)]
        assert list(op4_warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark, tmp_path):
    big = "WARC/1.1\r\n\r\nä " * 200
    rows = [(1, "http://b.org/x?q#f", big), (3, "http://a.org:8/", big), (2, None, None),
            (None, "http://a.org:8/\r\nX: y", big), (3, "http://a.org:8/", big), (4, "", "short"),
            (5, "", "short")]
    df = spark.createDataFrame([r + (1,) for r in rows], "page_id long, url string, html string, n int")
    out = op4_warc.histories(df).orderBy("place_in_order").collect()
    assert [r.urlkey for r in out] == sorted(r.urlkey for r in out)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in out), key=repr)
    n = len(big.encode())
    assert got == sorted([(1, "revisit", 3, n), (3, "response", None, n), (2, "response", None, 0),
                          (None, "revisit", 3, n), (3, "response", None, n),
                          (4, "response", None, 5), (5, "response", None, 5)], key=repr)
    assert op4_warc.histories(df.limit(0)).count() == 0
    # several archives, several runs
    path = str(tmp_path / "w")
    op4_warc.write_archives(df.repartition(3), path, archive=4000)
    assert op4_warc.read_archives(spark, path).select("run").distinct().count() > 1


# --- op5 --------------------------------------------------------------------

def test_url_rules_and_reputation(spark):
    urls = ["HTTP://A.Example.ORG/es/1?x", "x://example.org/en/12", "x://org/a", "x://forg/a", "x://org",
            "x://n.com/fr/", "x://n.com/de/#", None, "none", "x://bad.net:80/?q", "x://good.co.uk/a/b"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(100 + i, "x://bad.net:80/p") for i in range(30)] \
        + [(200 + i, "x://good.co.uk/p") for i in range(30)]
    pages = spark.createDataFrame([r + ("h",) for r in rows], "page_id long, url string, host string")
    labels = spark.createDataFrame(
        [(100 + i, 1) for i in range(30)] + [(200 + i, 0) for i in range(30)] + [(5, None)],
        "id long, bad long")
    out = {r.page_id: r for r in op5_url.judge(pages, labels).collect()}
    assert [(out[i].host, out[i].path) for i in (0, 7, 8, 9)] == [
        ("a.example.org", "/es/1"), ("", ""), ("", ""), ("bad.net:80", "/")]
    assert [out[i].rule for i in range(7)] == ["example.org/es/", "example.org/en/1", "org/", None,
                                               None, "com/fr/", "com/de/"]
    assert out[9].verdict == "block" and out[10].verdict == "allow" and out[2].verdict == "allow"
    assert {r.verdict for r in op5_url.judge(pages, labels.limit(0)).filter("rule is null").collect()} \
        == {"allow"}
    assert op5_url.judge(pages.limit(0), labels).count() == 0


# --- op6 --------------------------------------------------------------------

def test_mix_by_brute_force(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["a", "b", "é", "Z", None, "tiny"] if i else ["tiny"]),
             rng.choice([0, 1, 5, 5, 40])) for i in range(300)]
    rows = [(i, "tiny", 2) if s == "tiny" and i > 9 else (i, s, n) for i, s, n in rows]
    df = spark.createDataFrame([(i, " ".join("w" * n), s, 1, 2) for i, s, n in rows],
                               "doc_id long, text string, source string, size int, rank int")
    got = {r.doc_id: r.copies for r in op6_mix.copies(op6_mix.sizes(df)).collect()}
    assert [got[i] for i, _, _ in rows] == plain.mix(rows)
    mixed = sorted(r.doc_id for r in op6_mix.mix(df).collect())
    assert mixed == sorted(i for i, n in got.items() for _ in range(n))


def test_targets_are_shared_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, None: 0, "d": 30}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in op6_mix.targets(df).collect()}
    assert got == pytest.approx(plain.targets(sizes))
    assert got[None] == 0 and got["a"] == 30 and sum(got.values()) == pytest.approx(1041)


def test_ordered_rank_of_a_hot_group(spark):
    df = spark.range(5000).select((F.col("id") % 7 == 0).alias("g"), (F.col("id") * 37 % 5000).alias("v"))
    got = ordered_rank(df, ["g"], [F.col("v")], "t").collect()
    for g in (True, False):
        own = sorted((r.v, r.rank) for r in got if r.g == g)
        assert [r for _, r in own] == list(range(1, len(own) + 1))


# --- op7 --------------------------------------------------------------------

def test_best_fit_by_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(5, 60)
        sizes = sorted((rng.randrange(1, n + 1) for _ in range(rng.randrange(1, 80))), reverse=True)
        rows = op7_pack.best_fit(sizes, n)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert sorted(n - sum(sizes[i] for i in r) for r in rows) == plain.best_fit(sizes, n)


def test_pack_odd_rows(spark):
    rows = [(1, "word " * 3000), (2, None), (3, ""), (4, "ünï <|endoftext|> x"), (5, "a" * 5000)]
    df = spark.createDataFrame([r + (1,) for r in rows], "doc_id int, text string, shard int")
    out = op7_pack.pack(df, length=64, shard=2000)
    back = {r.doc: r.text for r in op7_pack.unpack(out, length=64).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert op7_pack.pack(df.limit(0)).count() == 0


# --- op8 --------------------------------------------------------------------

def test_quotes(spark):
    rows = [
        (1, 0, "u", "Hello there, how are you?\nI need help with joins."), (1, 1, "a", "Use broadcast joins."),
        (1, 2, "u", "> I need  HELP with joins.\n\nStill stuck."),
        (1, 3, "a", "On Monday u wrote:\n>> I need help with joins.\n> Still stuck.\n\nTry again."),
        (1, 4, "u", "unrelated"), (1, 5, "u", "> Use broadcast joins.\nwhy?"), (1, 6, "u", "> why?\nbecause"),
        (2, 0, "u", None), (2, 1, None, "> nothing known\nx"), (2, 1, None, "> nothing known\nx"),
        (2, None, "u", "> x\nlate"), (None, 0, "u", "a b c"), (None, 1, "u", "> a b c\nyes")]
    df = spark.createDataFrame([r + (1, "x") for r in rows],
                               "conv_id long, turn int, role string, text string, c int, row string")
    out = op8_quotes.link(df).orderBy(F.col("conv_id").asc_nulls_last(), "position").collect()
    got = [(r.conv_id, r.turn, r.text, r.parent_turn, r.root_turn) for r in out]
    assert got == [
        (1, 0, "Hello there, how are you?\nI need help with joins.", None, 0), (1, 2, "Still stuck.", 0, 0),
        (1, 3, "Try again.", 2, 0), (1, 1, "Use broadcast joins.", None, 1), (1, 5, "why?", 1, 1),
        (1, 6, "because", 5, 1), (1, 4, "unrelated", None, 4), (2, 0, "", None, 0), (2, 1, "x", None, 1),
        (2, 1, "x", None, 1), (2, None, "late", None, None), (None, 0, "a b c", None, 0),
        (None, 1, "yes", 0, 0)]
    assert out[2].links == "1:2,2:0" and [r.position for r in out[:7]] == list(range(1, 8))
    assert op8_quotes.link(df.limit(0)).count() == 0


def test_long_chain_of_replies(spark):
    rows = [(1, 0, "u", "message 0")] + [(1, i, "u", f"> message {i - 1}\nmessage {i}") for i in range(1, 40)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert {(r.root_turn, r.turn - r.position) for r in op8_quotes.link(df).collect()} == {(0, -1)}


def test_partial_and_rewrapped_quotes(spark):
    rows = [
        (1, 0, "First paragraph of the question\nabout joins in streams.\n\nSecond paragraph, which asks\n"
                "for more. It has two sentences here.\n\nThird paragraph."),
        (1, 1, "nothing to see"),
        (1, 2, "> First paragraph of the\n> question about joins\n> in streams.\n>\n> Second paragraph, which\n"
                "> asks for more. It has two sentences here.\nrewrapped"),
        (1, 3, "> It has two sentences here.\none sentence"),
        (1, 4, "> asks\n> for more. It has\nacross lines"),
        (1, 5, "> It has three sentences here.\nunknown"),
        (1, 6, "> one\nshort"),
        (1, 7, "It has two sentences here, again"),
        (1, 8, "> two sentences here, again\nthe latest"),
        (2, 0, "a\n\n\n\nb\n"), (2, 1, "> It has two sentences here.\nother conversation")]
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows],
                               "conv_id long, turn int, role string, text string")
    out = {(r.conv_id, r.turn): r for r in op8_quotes.link(df).collect()}
    assert {k: r.parent_turn for k, r in out.items() if r.parent_turn is not None} \
        == {(1, 2): 0, (1, 3): 0, (1, 4): 0, (1, 8): 7}
    assert out[1, 3].links == "1:0" and out[1, 3].root_turn == 0 and len(out) == len(rows)
    assert out[2, 0].text == "a\n\n\n\nb\n" and out[1, 3].text == "one sentence"


# --- op9 --------------------------------------------------------------------

def test_allocation_is_the_cheapest():
    rng = random.Random(4)
    for _ in range(30):
        m, radius = rng.randrange(1, 5), 4
        cost = [[0.0, *sorted(rng.random() * 9 for _ in range(radius + 1))] for _ in range(m)]
        best, ts = op9_simhash.allocate(cost, radius - m + 1)
        import itertools
        every = [sum(cost[i][t + 1] for i, t in enumerate(c))
                 for c in itertools.product(range(-1, radius + 1), repeat=m) if sum(c) == radius - m + 1]
        assert sum(ts) == radius - m + 1 and best == pytest.approx(min(every))


@pytest.mark.parametrize("joined,block", [(64, 2048), (0, 7)])
def test_links_of_planted_fingerprints(spark, monkeypatch, joined, block):
    monkeypatch.setattr(op9_simhash, "JOINED", joined)
    monkeypatch.setattr(op9_simhash, "BLOCK", block)
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    fps = set(base)
    for b in base[:12] * 8:  # near copies of near copies, some just out of reach
        x = b
        for _ in range(rng.randrange(3)):
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    root = {r.node: r.root for r in components(op9_simhash.links(df)).collect()}
    got = [root.get(f, f) for f in signed]
    want = plain.components(fps)
    assert len({(g, w) for g, w in zip(got, want)}) == len(set(got)) == len(set(want)) < len(fps)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 100 + i) for i in range(60)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, **{100 + i: 100 for i in range(1, 60)}, 1000: 100}
    assert components(df.limit(0)).count() == 0


# --- op10 -------------------------------------------------------------------

def test_models_tell_held_out_samples_apart(spark):
    rng = random.Random(9)
    syllables = ["get", "user", "na", "me", "set", "co", "unt", "er", "in", "dex", "fi", "le", "_"]
    plainly = ["".join(rng.choice(syllables) for _ in range(8)) for _ in range(400)]
    chance = ["".join(rng.choice(op10_secrets.ALPHABET[:62]) for _ in range(24)) for _ in range(400)]
    rows = [(x, False) for x in plainly[:200]] + [(x, True) for x in chance[:200]] + [(None, True), ("x", None)]
    ratio = op10_secrets.train(op10_secrets.count_labelled(
        spark.createDataFrame(rows, "value string, random boolean")))
    right = [op10_secrets.score(x, ratio) < op10_secrets.MARGIN for x in plainly[200:]] + \
        [op10_secrets.score(x, ratio) >= op10_secrets.MARGIN for x in chance[200:]]
    assert sum(right) >= 0.98 * len(right)


def test_spans_of_odd_texts(spark):
    hex_ = "0123456789abcdef" * 2
    texts = [None, "", "Token: abc token=token=abcdef", f"é {hex_} x", "AKIA" + "A" * 15 + " AKIA" + "B" * 16,
             "api_key = 'a.b-c/d+e'", "x " * 50_000 + "passwd:" + hex_, "\u017fecret: abcdefgh", "AKIAAKIA" + "C" * 14]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_hex int")
    ratio = op10_secrets.train(op10_secrets.count_corpus(df))
    out = op10_secrets.scan(df, ratio).collect()
    for r in out:
        base = plain.base_spans(texts[r.doc_id] or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b[1] == k for b in base) for k in range(3)]
    assert op10_secrets.scan(df.limit(0), ratio).count() == 0
    assert not op10_secrets.train(op10_secrets.count_corpus(df.limit(0))).any()
