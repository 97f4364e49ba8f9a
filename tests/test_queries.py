"""Every registered query beside its SQL on the smallest tables, if they are there."""

import collections
from functools import cache
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith(("p1_", "p5_", "p6_", "p7_", "p8_")))


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


@cache
def connection():
    c = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    compare(spark, name)


def compare(spark, name):
    con = connection()
    df = entry.queries()[name](spark, str(FOLDER))
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = collections.Counter(tuple(plain(v) for v in r) for r in cursor.fetchall())
    assert collections.Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["table_name", "field_name", "row_id", "period"]
