import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sedimark.functions import ids
from sedimark.operators.orphans import Reference, Referrer, Target, orphan_references, orphan_report

T0 = dt.datetime(2024, 1, 1)
PARENT = "key string, loaded_at timestamp_ntz, retired_at timestamp_ntz, period string"
CHILD = "row_id long, ref string, loaded_at timestamp_ntz, key string, target int"


def found(spark, parents, children, partitions=None):
    p = spark.createDataFrame(parents, PARENT)
    c = spark.createDataFrame(children, CHILD)
    return orphan_references([Target("p", p, ids.taxon_key(F.col("key")))], [Referrer("c", c, [Reference("ref", "p", ids.taxon_key(F.col("ref")))])], partitions)


def brute(parents, children):
    rows = []
    for row_id, ref, at, *_ in children:
        if ref is None or not ref.strip():
            continue
        live = at is not None and any(k in ref and a is not None and a <= at and (b is None or b > at) for k, a, b, _ in parents if k)
        if not live:
            rows.append((row_id, at and at.strftime("%Y-%m")))
    return sorted(rows, key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_against_brute_force_with_a_hot_key(spark, partitions):
    r = random.Random(1)
    day = lambda: T0 + dt.timedelta(days=r.randrange(200), microseconds=r.randrange(3))
    keys = ["%010d" % i for i in range(40)]
    parents = [(k, day(), r.choice([None, day()]), "x") for k in keys[:30] for _ in range(r.randrange(4))] + [(None, T0, None, "x"), (keys[31], None, None, "x")]
    children = [(i, r.choice([None, "", "  ", "none", keys[0], keys[0], keys[39], f"IMG_{r.choice(keys)}", f" {r.choice(keys)}.0"]), r.choice([None, *[day() for _ in range(30)]]), "k", 1) for i in range(1500)]
    children += [children[5]]
    rows = found(spark, parents, children, partitions).collect()
    assert sorted([(x.row_id, x.period) for x in rows], key=str) == brute(parents, children)


def test_boundaries_and_empty_tables(spark):
    k = "1234567890"
    at = [T0 + dt.timedelta(days=i) for i in range(6)]
    parents = [(k, at[1], at[2], ""), (k, at[2], at[3], ""), (k, at[1], at[2], ""), (k, at[5], at[4], "")]
    children = [(i, k, t, "", 0) for i, t in enumerate(at)]
    assert sorted(r.row_id for r in found(spark, parents, children).collect()) == [0, 3, 4, 5]
    assert found(spark, parents, []).count() == 0
    assert found(spark, [], children).count() == 6
    report = orphan_report(found(spark, [], children)).collect()
    assert [tuple(r) for r in report] == [("c", "ref", "2024-01", 6)]


def test_canonical_ids(spark):
    s = "A-_" + "b" * 40
    df = spark.createDataFrame([(x,) for x in (f"lcl|Ssu_{s} ", f'"SSU_{s}"', f"SSU_{s[:-1]}", None)], "x string")
    rows = df.select(ids.canonical_sequence_id(F.col("x")).alias("c"), ids.sequence_key(F.col("x")).alias("k")).collect()
    assert [r.c for r in rows] == ["SSU_" + s] * 2 + [None] * 2
    assert rows[0].k == rows[1].k and rows[2].k is None and len(rows[0].k) == 33
    h = "0Af" + "9" * 61
    row = spark.createDataFrame([(f" src_{h}\n", "oid:0123456789", "12345678901")], "a string, b string, c string").select(
        ids.canonical_record_id(F.col("a")), ids.canonical_taxon_oid(F.col("b")), ids.canonical_taxon_oid(F.col("c"))).first()
    assert tuple(row) == ("SRC_" + h.lower(), "0123456789", None)
