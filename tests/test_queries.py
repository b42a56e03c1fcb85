"""Every registered query on the smallest tables: against its SQL, or at least for rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

PATH = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{PATH}/{t}.parquet'")
    return c


def text(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        assert not math.isnan(v) and not math.isinf(v)
        return repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, PATH)
    got = [tuple(r) for r in df.collect()]
    if name not in entry.oracle_sql():
        assert got
        return
    cur = con.execute(entry.oracle_sql()[name])
    assert table(df.columns, got) == table([d[0] for d in cur.description], cur.fetchall())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
