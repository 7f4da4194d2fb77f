from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fixtures import NUMBERS
from keyfold.operators.count_window import count_chunk_list, count_chunks, fixed_batches
from keyfold.operators.exclude import exclude_from, exclude_static
from keyfold.operators.split import split_parity


def _pairs(spark):
    # keys 1..3 with 10 / 25 / 9 values -> 1, 2 and 0 emitted groups
    rows, seq = [], 0
    for key, n in ((1, 10), (2, 25), (3, 9)):
        for i in range(n):
            seq += 1
            rows.append((seq, key, i + 1))
    return spark.createDataFrame(rows, "seq long, key long, v long")


def test_count_chunks(spark):
    for width in (None, 4):
        g = count_chunks(_pairs(spark), "key", "seq", 10, lambda: [F.sum("v").alias("s")], width)
        got = sorted(tuple(r) for r in g.collect())
        assert got == [(1, 0, 55), (2, 0, 55), (2, 1, 155)]


def test_count_chunk_list_text(spark):
    g = count_chunk_list(_pairs(spark), "key", "seq", F.col("v"), 10, 3)
    r = g.filter("key = 1").first()
    assert r.values_text == " 1 2 3 4 5 6 7 8 9 10" and r.total == 55


def test_fixed_batches(spark):
    df = spark.range(0, 1050).withColumnRenamed("id", "seq")
    b = fixed_batches(df, F.pmod(F.col("seq"), F.lit(2)), "seq", 100, 64)
    per = {(r.bucket, r.batch_no): r["count"] for r in b.groupBy("bucket", "batch_no").count().collect()}
    assert set(per.values()) == {100}
    assert len(per) == 10  # 525 rows per bucket -> 5 full batches each


def test_exclusion_static_and_asof(spark):
    t0 = datetime(2024, 1, 1)
    main = spark.createDataFrame(
        [(i, e, t0 + timedelta(minutes=i)) for i, e in enumerate(["A", "B", "C", "A", "B", "C"])],
        "seq long, emp string, ts timestamp_ntz")
    # A excluded before all rows, B after its first row, C never
    ex = spark.createDataFrame([("A", t0 - timedelta(minutes=1)), ("B", t0 + timedelta(minutes=2))],
                               "emp string, ex_ts timestamp_ntz")
    assert sorted(r.emp for r in exclude_static(main, ex, "emp").collect()) == ["C", "C"]
    asof = exclude_from(main, ex, "emp", "ts", "ex_ts").orderBy("seq").collect()
    assert [r.emp for r in asof] == ["B", "C", "C"]


def test_split_parity(spark):
    df = spark.createDataFrame([(i + 1, str(n)) for i, n in enumerate(NUMBERS)], "seq long, line string")
    out = split_parity(df, "line")
    assert out["all"].count() == 43
    even, odd = out["even"], out["odd"]
    assert even.count() == 24 and odd.count() == 19
    assert dict(even.dtypes)["v"] == "string" and dict(odd.dtypes)["v"] == "int"
