from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from keyfold.session import shared_dir
from keyfold.streaming.carry import chunk_writer
from keyfold.streaming.operators import (event_time, session_stream,
                                         tumbling_stream)
from keyfold.streaming.runner import file_stream, run_available_now


def _same(a, b):
    pa = a.toPandas()
    pb = b.toPandas()[list(pa.columns)]
    key = list(pa.columns)
    pd.testing.assert_frame_equal(pa.sort_values(key).reset_index(drop=True),
                                  pb.sort_values(key).reset_index(drop=True))


def test_stream_equals_batch(spark):
    q = E.queries()
    for batch, stream in (("q_running_avg", "q_stream_running_avg"),
                          ("q_count_chunk_list", "q_stream_count_chunk_list"),
                          ("q_tumbling", "q_stream_tumbling")):
        _same(q[batch](spark, SF_SMALL), q[stream](spark, SF_SMALL))


def _pairs_file(spark, folder, rows):
    spark.createDataFrame(rows, "seq long, key long, v long").repartition(1) \
         .write.mode("append").parquet(folder)


def test_restart_from_checkpoint_continues(spark):
    src = shared_dir(spark, "test-src")
    ckpt = shared_dir(spark, "test-ckpt")
    out = shared_dir(spark, "test-out")
    rows = [(i, i % 3, i) for i in range(1, 61)]
    _pairs_file(spark, src, rows[:25])
    _pairs_file(spark, src, rows[25:40])
    schema = "seq long, key long, v long"

    def run():
        run_available_now(file_stream(spark, src, schema), "restart", checkpoint=ckpt,
                          foreach_batch=chunk_writer(
                              spark, "key", "seq", 10, lambda d: d.groupBy("key", "chunk_no")
                              .agg(F.sum("v").alias("total")), out, 4))
        return spark.read.parquet(f"{out}/out")

    first = run().count()
    _pairs_file(spark, src, rows[40:])  # new data after the stop
    res = run()
    # 20 rows per key -> 2 groups each, each emitted exactly once over both runs
    assert first == 3 and res.count() == 6
    got = sorted((r.key, r.chunk_no, r.total) for r in res.collect())
    exp = []
    for k in range(3):
        vals = [v for (_s, kk, v) in rows if kk == k]
        exp += [(k, 0, sum(vals[:10])), (k, 1, sum(vals[10:20]))]
    assert got == sorted(exp)


def test_late_rows_are_dropped(spark):
    src = shared_dir(spark, "test-late")
    t0 = datetime(2024, 1, 1)
    schema = "seq long, ts timestamp_ntz, v long"

    def put(rows):
        spark.createDataFrame(rows, schema).repartition(1).write.mode("append").parquet(src)

    put([(1, t0, 1), (2, t0 + timedelta(seconds=20), 1)])
    put([(3, t0 + timedelta(seconds=60), 1)])
    put([(4, t0 + timedelta(seconds=1), 1)])            # late by far more than 3.5 s
    put([(5, t0 + timedelta(days=1), 1)])               # pushes the watermark
    put([(6, t0 + timedelta(days=1, seconds=1), 1)])
    s = event_time(file_stream(spark, src, schema), "ts", "3500 milliseconds")
    agg = tumbling_stream(s, "ts", "10 seconds", [], [F.count(F.lit(1)).alias("n")])
    progress = []
    out = run_available_now(agg, "late", progress=progress)
    got = sorted((r.window_start, r.n) for r in out.collect())
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) >= 1
    # the late row (10 s window starting at t0) is not counted
    assert got[0] == (t0, 1)
    assert (t0 + timedelta(seconds=20), 1) in got and (t0 + timedelta(seconds=60), 1) in got


def test_stream_session_gap_edges(spark):
    src = shared_dir(spark, "test-sess")
    t0 = datetime(2024, 1, 1)
    schema = "seq long, ts timestamp_ntz, v long"
    ms = [0, 9_999, 19_999, 30_000]
    spark.createDataFrame([(i, t0 + timedelta(milliseconds=m), 5) for i, m in enumerate(ms)],
                          schema).repartition(1).write.parquet(src)
    spark.createDataFrame([(99, t0 + timedelta(days=1), 0)], schema).repartition(1) \
         .write.mode("append").parquet(src)
    spark.createDataFrame([(100, t0 + timedelta(days=1), 0)], schema).repartition(1) \
         .write.mode("append").parquet(src)
    s = event_time(file_stream(spark, src, schema), "ts", "0 seconds")
    agg = session_stream(s, "ts", "10 seconds",
                         [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")])
    got = sorted((r.n, r.total) for r in run_available_now(agg, "sess").collect())
    assert got == [(1, 5), (3, 15)]


def test_session_writer_spans_batches_and_drops_late_rows(spark):
    from keyfold.streaming.operators import session_writer
    src, base = shared_dir(spark, "sw-src"), shared_dir(spark, "sw")
    t0 = datetime(2024, 1, 1)
    schema = "seq long, ts timestamp_ntz, v long"
    writer = session_writer(spark, "ts", "10 seconds", "v", "seq", "0 seconds",
                            f"{base}/state", f"{base}/out")
    ckpt = shared_dir(spark, "sw-ck")
    pieces = [
        [(1, t0, 1), (2, t0 + timedelta(seconds=8), 1)],            # session A opens
        [(3, t0 + timedelta(seconds=15), 1)],                        # A continues in batch 2
        [(4, t0 - timedelta(seconds=30), 1),                         # late: dropped
         (5, t0 + timedelta(seconds=60), 1)],                        # B opens, closes A
        [(6, t0 + timedelta(days=1), 0)],                            # closes B
    ]
    for rows in pieces:
        spark.createDataFrame(rows, schema).repartition(1).write.mode("append").parquet(src)
        run_available_now(file_stream(spark, src, schema, None), "sw",
                          foreach_batch=writer, checkpoint=ckpt)
    got = sorted((r.session_start, r.n, r.total)
                 for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [(t0, 3, 3), (t0 + timedelta(seconds=60), 1, 1)]
