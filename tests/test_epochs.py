"""State between epochs: bounded folders, repeated epochs, restart with other parallelism."""

import os

import pytest
from pyspark.sql import functions as F

from keyfold.operators.running import run_count, run_min_by, run_sum, running
from keyfold.session import shared_dir
from keyfold.streaming.carry import chunk_writer, distinct_flags, running_writer
from keyfold.streaming.epochs import Growing, Latest
from keyfold.streaming.operators import exclude_asof_writer
from keyfold.streaming.runner import file_stream, run_available_now


def _local(path):
    return path.removeprefix("file:")


def test_latest_keeps_a_few_epochs(spark):
    t = Latest(spark, shared_dir(spark, "latest"), keep=2)
    for e in range(6):
        before = t.before(e, "v long")
        assert (before is None) if e == 0 else [r.v for r in before.collect()] == [e - 1]
        for _ in range(2):  # repeated
            assert t.write(spark.createDataFrame([(e,)], "v long"), e).first().v == e
    assert sorted(os.listdir(_local(t.folder))) == ["epoch=4", "epoch=5"]


@pytest.mark.parametrize("merge", [1, 2, 3])
def test_growing_merges_and_forgets_nothing(spark, merge):
    t = Growing(spark, shared_dir(spark, "growing"), ["k", "m"], buckets=4, merge=merge)
    seen, most = set(), 0
    for e in range(10):
        rows = spark.createDataFrame([(e % 3, None if e == 4 else f"m{e}"), (0, f"x{e // 2}")], "k int, m string")
        for _ in range(2):  # repeated
            before = t.before(e, spark.createDataFrame([(k, m) for k, m in seen] or [(0, "")], "k int, m string"))
            got = set() if before is None else {tuple(r) for r in before.collect()}
            assert got == seen, e
            t.add(rows, e)
        seen |= {tuple(r) for r in rows.collect()}
        folders = sum(len(os.listdir(_local(f"{t.folder}/{d}"))) for d in os.listdir(_local(t.folder)))
        most = max(most, folders)
    assert most <= 3 * merge + 3


def _read(df):
    """Bytes of the files that rows come from, of those that the filter leaves."""
    files = [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
    return sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in files)


def test_only_the_buckets_met_are_read(spark):
    t = Growing(spark, shared_dir(spark, "growing"), ["k", "m"], buckets=16, merge=2)
    many = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("m"))
    t.before(0, many)
    t.add(many, 0)
    few, read = many.filter("m < 2"), []
    for e in range(1, 9):  # members repeat: nothing new
        before = t.before(e, few)
        assert {r.m for r in before.filter("m < 2").collect()} == {0, 1}
        read.append(_read(before))
        t.add(few.limit(0), e)
    everything = _read(t.before(9, many))
    # at most 2 of 16 buckets, and no more from epoch to epoch
    assert max(read) < 0.25 * everything and read[-1] <= 1.3 * read[0]


def test_nulls_are_members_in_both_forms(spark):
    rows = [(1, "a", None), (2, "a", 7), (3, "a", None), (4, None, None), (5, None, 7)]
    df = spark.createDataFrame(rows, "s long, k string, m long")
    base = shared_dir(spark, "carry")
    w = running_writer(spark, "k", "s", [[run_sum("is_new", "n")]], ["s"], base, 2,
                       distinct_flags(spark, "k", "s", "m", base))
    for e, part in enumerate((df.filter("s < 3"), df.filter("s >= 3"))):
        w(part, e)
    from keyfold.operators.running import first_occurrence_flag
    batch = running(first_occurrence_flag(df, ["k", "m"], "s", "f"), "k", "s", [run_sum("f", "n")], 2)
    got = {r.s: r.n for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {r.s: r.n for r in batch.collect()} == {1: 1, 2: 2, 3: 2, 4: 1, 5: 2}


def test_excluded_ids_are_read_by_bucket(spark):
    rows = [(1, 1, "x", 10), (2, 2, "ban", 11), (3, 2, "x", 12), (4, 1, "x", 13), (5, 1, "ban", 14), (6, 1, "x", 15),
            (7, None, "x", 16), (8, 3, "x", 17)]
    df = spark.createDataFrame(rows, "s long, u long, t string, ts long")
    base = shared_dir(spark, "ex")
    w = exclude_asof_writer(spark, "u", "ts", F.col("t") == "ban", f"{base}/list", f"{base}/out", 4, 1)
    for e, cond in enumerate(("s <= 2", "s = 3", "s > 3 and s < 6", "s >= 6")):
        w(df.filter(cond), e)
        w(df.filter(cond), e)
    assert sorted(r.s for r in spark.read.parquet(f"{base}/out").collect()) == [1, 4, 7, 8]


class Killed(Exception):
    pass


def _feed(spark, folder, lo, hi):
    spark.range(lo, hi).select(F.col("id").alias("s"), (F.col("id") % 3).alias("k"), (F.col("id") * 7 % 11).alias("v")) \
        .write.mode("append").parquet(folder)


@pytest.mark.parametrize("what", ["running", "chunks"])
def test_killed_in_an_epoch_and_restarted_with_other_parallelism(spark, what):
    folder, ckpt, base = (shared_dir(spark, "kill", x) for x in ("in", "ckpt", "base"))
    aggs = [run_sum("v", "t"), run_count("n"), run_min_by("v", "s", ["s"], "min_")]

    def writer(width):
        if what == "running":
            return running_writer(spark, "k", "s", [aggs], ["s", "k"], base, width)
        return chunk_writer(spark, "k", "s", 4, lambda d: d.select("k", "chunk_no", "arrival_no", "s"), base, width)

    def run(width, die_at=None):
        w = writer(width)

        def once(batch, epoch):
            w(batch, epoch)  # state and output of the epoch are written
            if epoch == die_at:
                raise Killed  # and the epoch is not committed
        run_available_now(file_stream(spark, folder, "s long, k long, v long", None), f"kill-{what}",
                          foreach_batch=once, checkpoint=ckpt)

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for epoch, (lo, hi) in enumerate([(0, 13), (13, 41), (41, 47), (47, 90)]):
            _feed(spark, folder, lo, hi)
            spark.conf.set("spark.sql.shuffle.partitions", str(2 + epoch))
            if epoch == 2:
                with pytest.raises(Exception):
                    run(5, die_at=2)
                spark.conf.set("spark.sql.shuffle.partitions", "7")
            run([3, 1000, 2, 16][epoch])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/out").drop("epoch").collect())
    df = spark.range(90).select(F.col("id").alias("s"), (F.col("id") % 3).alias("k"), (F.col("id") * 7 % 11).alias("v"))
    if what == "running":
        want = running(df, "k", "s", aggs).select("s", "k", "t", "n", "min_s")
    else:
        want = df.select("k", F.expr("s div 3 div 4").alias("chunk_no"), F.expr("s div 3 + 1").alias("arrival_no"), "s") \
            .filter("chunk_no < 7")
    assert got == sorted(tuple(r) for r in want.collect())
    state = [d for d in os.listdir(_local(base)) if d != "out"]
    assert all(len(os.listdir(_local(f"{base}/{d}"))) <= 2 for d in state)
