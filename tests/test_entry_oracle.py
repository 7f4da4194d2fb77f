"""The driver contract: entry, query registry and oracle SQL agree (sf0.001)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from keyfold.sources.tables import TABLES


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.columns == ["event_id", "event_type", "running_avg"]
    assert df.count() == 1000


def test_every_query_has_a_docstring_and_sql():
    q, o = E.queries(), E.oracle_sql()
    assert {n for n in o if n.startswith("q_")} == {n for n in q if n.startswith("q_")}
    assert all(fn.__doc__ for n, fn in q.items() if n.startswith("q_"))


def _norm(df):
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        out = []
        for v in rec:
            if isinstance(v, pd.Timestamp):
                v = v.to_pydatetime()
            if isinstance(v, float) and math.isnan(v):
                v = None
            if hasattr(v, "item"):
                v = v.item()
            out.append(v)
        rows.append(tuple(out))
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


BATCH = sorted(n for n in E.queries() if n.startswith("q_") and not n.startswith("q_stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert _norm(sdf) == _norm(odf)
