import pytest

from conftest import lines_df
from fixtures import SALES_SAMPLE
from keyfold.functions.parse import (parse_cab, parse_cab_strict, parse_click,
                                     parse_employee, parse_event_pair, parse_number,
                                     parse_pair, parse_sales, parse_trade)
from keyfold.sources.text import read_lines

BAD = ["01-06-2018,June,Category5,Bat", "01-06-2018,June,Category5,Bat,twelve", ""]


def test_sales_good_and_rejects(spark):
    good, bad = parse_sales(lines_df(spark, SALES_SAMPLE + BAD))
    assert good.count() == 18
    assert dict(good.dtypes)["profit"] == "int"
    rej = bad.orderBy("seq").collect()
    assert [r.seq for r in rej] == [19, 20, 21]
    assert all(r.reason.startswith("bad field: ") for r in rej)
    assert "profit" in rej[0].reason and "profit" in rej[1].reason


def test_fail_mode_raises(spark):
    good, _ = parse_sales(lines_df(spark, SALES_SAMPLE + BAD[:1]), mode="fail")
    with pytest.raises(Exception):
        good.count()


def test_cab_tolerant_and_strict(spark):
    lines = ["id_4213,PB7526,Sedan,Wanda,yes,Sector 19,Sector 10,5",
             "id_1234,PB1111,SUV,Erika,no,'null','null','null'",
             "id_1,PB2,Mini,Kazuko,YES,Sector 1,Sector 2,x"]
    good, bad = parse_cab(lines_df(spark, lines))
    assert [r.passengers for r in good.orderBy("seq").collect()] == [5.0, 0.0, 0.0]
    assert bad.count() == 0
    good, bad = parse_cab_strict(lines_df(spark, lines))
    rows = good.orderBy("seq").collect()
    assert [(r.ongoing, r.passengers) for r in rows] == [(True, 5), (False, 0)]
    assert [r.seq for r in bad.collect()] == [3]  # ongoing with a non-number


def test_click_trade_pair_employee(spark):
    c, _ = parse_click(lines_df(spark, ["u1,net1,1.2.3.4,US,a.com,35"]))
    r = c.first()
    assert (r.website, r.time_spent, r.line) == ("a.com", 35, "u1,net1,1.2.3.4,US,a.com,35")
    t, tb = parse_trade(lines_df(spark, ["06/10/2010,08:00:00,106.0,348746",
                                         "31/02/2010,08:00:00,1.0,1"]))
    r = t.first()
    assert (r.price, r.volume, r.symbol, str(r.ts)) == (106.0, 348746, "XYZ", "2010-10-06 08:00:00")
    assert tb.count() == 1
    p, _ = parse_pair(lines_df(spark, ["1,5"]))
    assert tuple(p.first())[:2] == (1, 5)
    e, _ = parse_employee(lines_df(spark, ["AXPM175755,Nana,Developer,Purchase,GH67D"]))
    assert (e.first().emp_id, e.first().dept) == ("AXPM175755", "Purchase")
    ep, _ = parse_event_pair(lines_df(spark, ["1000,5"]))
    assert str(ep.first().ts) == "1970-01-01 00:00:01"
    n, nb = parse_number(lines_df(spark, ["454", "x"]))
    assert n.count() == 1 and nb.count() == 1


def test_read_lines_numbers_in_file_order(spark, tmp_path):
    p = tmp_path / "lines.txt"
    p.write_text("\n".join(f"line{i}" for i in range(1, 501)) + "\n")
    df = read_lines(spark, str(p))
    rows = df.collect()
    assert sorted((r.seq, r.value) for r in rows) == [(i, f"line{i}") for i in range(1, 501)]
