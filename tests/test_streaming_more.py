from pyspark.sql import functions as F

from fixtures import RUNNING_AVG_FIRST8, SALES_SAMPLE
from keyfold.functions.parse import parse_sales
from keyfold.session import shared_dir
from keyfold.sinks import roll_by_bytes, run_to_files, write_rolled
from keyfold.sources.text import line_stream
from keyfold.operators.running import run_count, run_sum
from keyfold.streaming.carry import running_writer
from keyfold.streaming.operators import arrival_windows
from keyfold.streaming.runner import run_available_now


def test_text_line_stream_running_average_golden(spark):
    src = shared_dir(spark, "lines")
    lines = SALES_SAMPLE[:8]
    for i in range(0, 8, 3):  # three files, in arrival order
        spark.createDataFrame([(i + j + 1, l) for j, l in enumerate(lines[i:i + 3])],
                              "seq long, value string").repartition(1) \
             .write.mode("append").json(src)
    # SRC-2: the same stream of lines; the replay carries its line number
    s = spark.readStream.schema("seq long, value string").option("maxFilesPerTrigger", 1).json(src)
    good, _bad = parse_sales(s)
    base = shared_dir(spark, "golden")
    run_available_now(good, "golden_avg", foreach_batch=running_writer(
        spark, "month", "seq", [[run_sum("profit", "s"), run_count("n")]], ["seq", "month"],
        base, 3))
    out = spark.read.parquet(f"{base}/out").orderBy("seq").collect()
    assert [(x.month, x.s / x.n) for x in out] == RUNNING_AVG_FIRST8


def test_text_source_reads_lines(spark, tmp_path):
    d = tmp_path / "txt"
    d.mkdir()
    (d / "a.txt").write_text("\n".join(SALES_SAMPLE[:5]) + "\n")
    s = line_stream(spark, "text", str(d), maxFilesPerTrigger=1)
    out = run_available_now(s, "text_lines")
    assert sorted(r.value for r in out.collect()) == sorted(SALES_SAMPLE[:5])


def test_processing_time_windows_keep_totals(spark):
    src = shared_dir(spark, "pt")
    spark.range(0, 300).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("k")) \
         .repartition(3).write.parquet(src)
    s = spark.readStream.schema("seq long, k long").option("maxFilesPerTrigger", 1).parquet(src)
    agg = arrival_windows(s, "2 seconds", "k", [F.count(F.lit(1)).alias("n")])
    ck, out = shared_dir(spark, "pt-ck"), shared_dir(spark, "pt-out")
    q = agg.writeStream.outputMode("update").format("memory").queryName("pt_w") \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.sql("select k, window_start, max(n) as n from pt_w group by k, window_start").collect()
    assert sum(r.n for r in rows) == 300


def test_rolling_file_sink(spark):
    src = shared_dir(spark, "roll-src")
    spark.range(0, 100).withColumnRenamed("id", "seq").repartition(1).write.parquet(src)
    s = spark.readStream.schema("seq long").parquet(src)
    out, ck = shared_dir(spark, "roll-out"), shared_dir(spark, "roll-ck")
    run_to_files(s, out, ck, fmt="text", max_records_per_file=30)
    assert spark.read.text(out).count() == 100


def test_files_roll_by_bytes_however_uneven_the_lines(spark):
    lines = [(i, "x" * (5000 if i < 20 else i % 7)) for i in range(600)] + [(600, "é" * 300), (601, "")]
    df = spark.createDataFrame(lines, "s long, t string").repartition(4)
    path = shared_dir(spark, "rolled")
    write_rolled(df, path, "s", 8192, 50, F.col("t"))
    files = spark.read.text(path).select("value", "file_no", F.col("_metadata.file_path").alias("f"),
                                         F.col("_metadata.file_size").alias("size")).collect()
    per = {}
    for r in files:
        per.setdefault(r.file_no, []).append(r)
    assert all(len({r.f for r in rows}) == 1 for rows in per.values())
    assert all(rows[0].size <= 8192 + 5001 for rows in per.values()) and len(per) > 10
    # laid out one after another, the files are the lines in order
    assert [r.value for k in sorted(per) for r in per[k]] == [t for _, t in lines]
    out = roll_by_bytes(df, "s", F.octet_length("t"), 10, 7).orderBy("s").collect()
    at = 0
    for r in out:
        assert r.file_no == at // 10
        at += len(r.t.encode())


def test_small_files_are_written_by_many_tasks_and_read_whole(spark):
    from keyfold.sinks import rolled_lines, rolling_writer
    path = shared_dir(spark, "rolled")
    write = rolling_writer(path, "s", 64, 50, F.col("t"))
    texts = [f"{i} é " + "x" * (i % 9) for i in range(400)] + [""]
    df = spark.createDataFrame(list(enumerate(texts)), "s int, t string")
    conf = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(conf)
    for epoch in (0, 1, 1):  # a repeated epoch writes the same again
        write(df, epoch)
    rows = rolled_lines(spark, path).collect()
    assert spark.conf.get(conf) == old
    for epoch in (0, 1):
        files = {}
        for r in rows:
            if r.epoch == epoch:
                files.setdefault((r.file_no, r.file, r.size), []).append(r.value)
        assert [t for k in sorted(files) for t in files[k]] == texts
        assert all(k[2] == sum(len(t.encode()) + 1 for t in v) for k, v in files.items())
        assert len(files) == len({k[0] for k in files}) > 50
        assert len({k[1].rsplit("/", 1)[1].split("-")[1] for k in files}) >= 3  # tasks


def test_rolled_files_are_listed_and_read_some_at_a_time(spark, monkeypatch):
    import os

    from keyfold import sinks
    monkeypatch.setattr(sinks, "FOLDER_FILES", 10)
    monkeypatch.setattr(sinks, "READ_FILES", 25)
    path = shared_dir(spark, "rolled")
    write = sinks.rolling_writer(path, "s", 16, 50, F.col("t"))
    texts = [f"{i} é" + "x" * (500 if i == 77 else i % 9) for i in range(300)]
    write(spark.createDataFrame(list(enumerate(texts)), "s int, t string"), 0)
    write(spark.createDataFrame([(None, None), (5, "last")], "s int, t string"), 1)
    on_disk = []  # the driver lists a folder and holds the files of a read, however many there are
    for folder, below, files in os.walk(path):
        assert len([d for d in below if d.startswith("file_no=")]) <= 10
        on_disk += [f for f in files if f.endswith(".txt")]
    seen = []

    def each(lines):
        seen.append({r.file for r in lines.select("file").distinct().collect()})
        return lines

    out = sinks.rolled_lines(spark, path, each)
    assert out.dtypes == [("epoch", "int"), ("file_no", "int"), ("file", "string"),
                          ("size", "bigint"), ("value", "string")]
    rows = out.collect()
    assert len(seen) > 5 and max(map(len, seen)) <= 25
    assert sum(map(len, seen)) == len(set().union(*seen)) == len(on_disk) > 100
    files = {}
    for r in rows:
        files.setdefault((r.epoch, r.file_no if r.file_no is not None else -1, r.file, r.size),
                         []).append(r.value)
    assert [t for k in sorted(files) for t in files[k] if k[0] == 0] == texts
    assert sorted((k[1], *v) for k, v in files.items() if k[0] == 1) == [(-1, ""), (0, "last")]
    assert all(k[3] == sum(len(t.encode()) + 1 for t in v) for k, v in files.items())
    empty = shared_dir(spark, "rolled")
    sinks.rolling_writer(empty, "s", 16, 50, F.col("t"))(
        spark.createDataFrame([], "s int, t string"), 0)
    assert sinks.rolled_lines(spark, empty).collect() == []


def test_rejects_and_good_rows_are_all_lines(spark):
    from keyfold.streaming.operators import reject_writer
    base = shared_dir(spark, "rejects")
    w = reject_writer(parse_sales, f"{base}/good", f"{base}/bad")
    batch = spark.createDataFrame([("a,b,c,d,5",), ("a,b,c,d,x",), ("a,b",), (None,), ("",)], "value string")
    w(batch, 0)
    w(batch, 0)  # a repeated epoch writes the same again
    w(batch.limit(0), 1)
    good, bad = spark.read.parquet(f"{base}/good").collect(), spark.read.parquet(f"{base}/bad").collect()
    assert [r.profit for r in good] == [5] and len(good) + len(bad) == 5
    assert {r.bad_line for r in bad} == {"a,b,c,d,x", "a,b", None, ""} and all(r.reason for r in bad)


def test_late_rows_are_kept_and_counted(spark):
    from datetime import datetime
    from keyfold.streaming.operators import late_writer
    base = shared_dir(spark, "late")
    w = late_writer(spark, "ts", "10 seconds", "5 seconds", *[f"{base}/{x}" for x in ("s", "ok", "late", "n")])
    rows = lambda *r: spark.createDataFrame(
        [(i, None if t is None else datetime(2024, 1, 1, 0, t // 60, t % 60)) for i, t in r], "s int, ts timestamp_ntz")
    for e, b in enumerate([rows((1, 3), (2, 31)), rows((4, 19), (5, 20), (6, None)), rows((7, 9)), rows()]):
        w(b, e)
        w(b, e)
    # watermark 26 s: the window up to 20 s is closed, the one up to 30 s is not
    assert sorted(r.s for r in spark.read.parquet(f"{base}/late").collect()) == [4, 6, 7]
    assert sorted(r.s for r in spark.read.parquet(f"{base}/ok").collect()) == [1, 2, 5]
    assert sorted((r.epoch, r.on_time, r.late) for r in spark.read.parquet(f"{base}/n").collect()) \
        == [(0, 2, 0), (1, 1, 2), (2, 0, 1), (3, 0, 0)]


def test_two_live_sources_at_any_pace(spark):
    from datetime import datetime, timedelta
    from keyfold.streaming.operators import event_time, exclude_between_streams
    from keyfold.streaming.runner import play
    t0 = datetime(2024, 1, 1)
    at = lambda s: t0 + timedelta(seconds=s)
    main = spark.createDataFrame([(i, u, at(i * 10)) for i, u in enumerate([1, 2, 1, None, 3, 2, 1, 3])],
                                 "s int, u int, ts timestamp_ntz")
    ex = spark.createDataFrame([(2, at(10)), (1, at(25)), (1, at(5000)), (None, at(0))], "u int, ts timestamp_ntz")
    far = at(10**8)
    ends = {"main": spark.createDataFrame([(99, 9, far)], main.schema), "list": spark.createDataFrame([(8, far)], ex.schema)}
    plan = lambda s: exclude_between_streams(event_time(s["main"], "ts", "1 minute"),
                                             event_time(s["list"], "ts", "1 minute"), "u", "ts", "ts", salts=3)
    for name, steps in (("a", [{"main": main}, {"list": ex}]), ("b", [{"list": ex}, {"main": main}]),
                        ("c", [{"main": main.filter("s < 4"), "list": ex.filter("u = 2")},
                               {"list": ex.filter("u <> 2 or u is null")}, {"main": main.filter("s >= 4")}])):
        out = play(spark, [*steps, ends, ends], f"two-{name}", plan)
        # 2 is out from 10 s on, 1 from 25 s on; a null id never is
        assert sorted(r.s for r in out.collect() if r.s != 99) == [0, 2, 3, 4, 7], name


def test_two_live_sources_as_tables(spark):
    from datetime import datetime, timedelta
    from keyfold.streaming.operators import exclude_sources_writer, two_sources
    from keyfold.streaming.runner import play
    t0 = datetime(2024, 1, 1)
    at = lambda s: None if s is None else t0 + timedelta(seconds=s)
    times = [0, 10, 20, 30, 40, 50, 60, 70, None]
    main = spark.createDataFrame([(i, u, at(t)) for i, (u, t) in enumerate(zip([1, 2, 1, None, 3, 2, 1, 3, 3], times))],
                                 "s int, u int, ts timestamp_ntz")
    # announced again and again: only the first time counts
    ex = spark.createDataFrame([(2, at(10)), (None, at(0)), (5, None)] + [(1, at(25 + i)) for i in range(300)],
                               "u int, ts timestamp_ntz")
    far = at(10**8)
    ends = {"main": spark.createDataFrame([(99, 9, far)], main.schema), "list": spark.createDataFrame([(8, far)], ex.schema)}
    late = {"main": spark.createDataFrame([(50, 7, at(5))], main.schema), "list": spark.createDataFrame([(3, at(1))], ex.schema)}
    for name, steps in (("a", [{"main": main}, {"list": ex}]), ("b", [{"list": ex}, {"main": main}]),
                        ("c", [{"main": main.filter("s < 4"), "list": ex.filter("u = 2")},
                               {"list": ex.filter("u <> 2 or u is null")}, {"main": main.filter("s >= 4")}])):
        base = shared_dir(spark, f"sources-{name}")
        write = exclude_sources_writer(spark, "u", "ts", "1 minute", f"{base}/state", f"{base}/out")

        def twice(batch, epoch, write=write):  # a repeated epoch writes the same again
            write(batch, epoch)
            write(batch, epoch)
        play(spark, [*steps, ends, late], f"sources-{name}",
             lambda s: two_sources(s["main"], s["list"], "u", "ts", "ts"), foreach_batch=twice)
        out = spark.read.parquet(f"{base}/out")
        assert set(out.columns) == {"s", "u", "ts", "epoch"}
        # 2 is out from 10 s on, 1 from 25 s on; a null id never is; late rows count no more
        assert sorted(r.s for r in out.collect()) == [0, 2, 3, 4, 7], name
