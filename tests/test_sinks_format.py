from pyspark.sql import functions as F

from keyfold.functions.format import alert_report, int_average, two_decimals
from keyfold.sinks import tuple_text, write_delimited, write_text


def test_text_and_delimited_sinks(spark, tmp_path):
    df = spark.createDataFrame([("June", 12.0), ("July", 50.0)], "month string, avg double")
    out = str(tmp_path / "t")
    write_text(df.coalesce(1), out)
    text = sorted(spark.read.text(out).collect())
    assert [r.value for r in text] == ["(July,50.0)", "(June,12.0)"]
    write_text(df.coalesce(1), out, mode="overwrite")  # SNK-2 replaces
    assert spark.read.text(out).count() == 2
    d = str(tmp_path / "d")
    write_delimited(df.coalesce(1), d)
    assert sorted(r.value for r in spark.read.text(d).collect()) == ["July 50.0", "June 12.0"]


def test_format_helpers(spark):
    r = spark.range(1).select(
        two_decimals(F.lit(2.0)).alias("a"), int_average(F.lit(7), F.lit(2)).alias("b"),
        alert_report(F.lit(-8.0), F.lit(102.0), F.lit(93.84), F.lit("06/10/2010:08:16:00")).alias("c"),
        tuple_text(F.lit("x"), F.lit(1)).alias("d")).first()
    assert (r.a, r.b, r.d) == ("2.00", 3, "(x,1)")
    assert r.c == "Large Change Detected of -8.00% (102.0 - 93.84) at  06/10/2010:08:16:00"


def test_int_div_truncates_toward_zero(spark):
    from keyfold.functions.format import int_div
    rows = [(7, 2), (-7, 2), (7, -2), (-7, -2), (6, 3), (2**52 + 1, 1), (5, 0)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = [r.q for r in df.select(int_div(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [3, -3, -3, 3, 2, 2**52 + 1, None]
