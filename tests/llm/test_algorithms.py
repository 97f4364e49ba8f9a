import random

import pytest
from pyspark.sql import functions as F

from sedimark.llm.survivors import Field, all_records, consensus_index, merged_records, progressive_alignment, survivors
from sedimark.llm.topn import top_n


def brute_top(rows, n):
    best = {}
    for g, i, s in rows:
        if g and g.strip() and i and i.strip() and s is not None and abs(s) < float("inf"):
            best[g, i] = max(s, best.get((g, i), s))
    answer = []
    for g in {g for g, _ in best}:
        ranked = sorted(((-s, i.encode(), i) for (h, i), s in best.items() if h == g))
        answer += [(g, i, -s, k + 1) for k, (s, _, i) in enumerate(ranked[:n])]
    return sorted(answer)


@pytest.mark.parametrize("partitions", [1, 9])
def test_top_n_with_a_hot_group(spark, partitions):
    r = random.Random(2)
    rows = [(r.choice(["hot", "hot", None, "", "é", f"q{r.randrange(30)}"]), r.choice([None, " ", f"s{r.randrange(200)}", f"S{r.randrange(200)}"]), r.choice([None, float("nan"), float("inf"), -float("inf"), float(r.randrange(20))])) for _ in range(4000)]
    df = spark.createDataFrame([(*x, 1, "p") for x in rows], "query string, subject string, bit_score double, position int, part string")
    assert sorted(tuple(x) for x in top_n(df, "query", "subject", "bit_score", 5, partitions).collect()) == brute_top(rows, 5)
    assert top_n(df.limit(0), "query", "subject", "bit_score", 5).count() == 0


def test_alignment_and_consensus():
    rows = progressive_alignment([["a", "b", "c"], ["a", "c"], ["x", "a", "b"]])
    assert rows == [["", "a", "b", "c"], ["", "a", "", "c"], ["x", "a", "b", ""]]
    assert consensus_index(["p q", "r s", "r s t"]) == 0
    assert consensus_index(["p q", "r s", "r s t"], [1, 2, 1]) == 1
    assert consensus_index(["A;B;C", "A;X;C", "A;B"], [1, 1, 1]) == 0
    assert consensus_index(["one"]) == 0 and consensus_index(["", "x"]) == 0


def test_survivors(spark):
    schema = "row_id long, k string, trust int, a string, b boolean, key string, o int"
    rows = [(1, "g", 2, "x", None, "c", 0), (2, "g", 1, None, None, "c", 0), (3, "g", 3, "y", True, "c", 0), (4, "g", 2, "y", False, "c", 0),
            (5, "single", 1, "x", True, "c", 0), (6, None, 1, "x", True, "c", 0), (7, None, 1, "x", True, "c", 0), (8, "none", 1, None, None, "c", 0), (9, "none", 1, None, None, "c", 0),
            (10, "twice", 1, "z", None, "c", 0), (10, "twice", 1, "z", None, "c", 0), (12, "tie", 1, "q", None, "c", 0), (11, "tie", 1, "p", None, "c", 0)]
    df = spark.createDataFrame(rows, schema)
    fields = [Field("a", F.col("a")), Field("b", F.col("b").cast("string"))]
    out = survivors(df, F.col("k"), fields, [F.col("trust")])
    assert sorted(tuple(r) for r in out.collect()) == [("g", "a", 1, "x"), ("g", "b", 4, "false"), ("tie", "a", 11, "p"), ("twice", "a", 10, "z")]
    assert {r.key: (r.a, r.b) for r in merged_records(out, ["a", "b"]).collect()}["g"] == ("x", "false")
    by_rows = survivors(df, F.col("k"), fields, [F.col("trust")], vote="rows")
    assert ("g", "a", 4, "y") in [tuple(r) for r in by_rows.collect()]
    assert survivors(df.limit(0), F.col("k"), fields, [F.col("trust")]).count() == 0


def test_consensus_differs_from_trust(spark):
    """Planted groups in which the most trusted path is an outlier: rows vote token by token for another, trust does not."""
    rows = []
    for g in range(40):
        rows += [(10 * g, f"g{g}", 1, "Bacteria;Oddota;Oddia"), (10 * g + 1, f"g{g}", 2, "Bacteria;Firmota;Bacillia"), (10 * g + 2, f"g{g}", 3, "Bacteria;Firmota;Bacillia"), (10 * g + 3, f"g{g}", 4, "Bacteria;Firmota;Clostria")]
        rows += [(10 * g + 4, f"tokens{g}", 1, "A;x;C"), (10 * g + 5, f"tokens{g}", 2, "A;B;C"), (10 * g + 6, f"tokens{g}", 3, "A;B;y")]
    df = spark.createDataFrame(rows, "row_id long, k string, trust int, a string")
    of = lambda vote: {r.key: r.row_id for r in survivors(df, F.col("k"), [Field("a", F.col("a"))], [F.col("trust")], vote=vote).collect()}
    by_rows, by_trust = of("rows"), of("trust")
    for g in range(40):
        assert (by_rows[f"g{g}"], by_trust[f"g{g}"]) == (10 * g + 1, 10 * g)
        # no path is held twice here: only the vote per token makes the middle one the closest
        assert (by_rows[f"tokens{g}"], by_trust[f"tokens{g}"]) == (10 * g + 5, 10 * g + 4)


@pytest.mark.parametrize("name", ["p5_found", "p5_survivors", "p5_records", "p5_consensus"])
def test_only_the_vote_by_rows_aligns(spark, tmp_path, name):
    """Under a strict order of trust alignment and vote cannot alter a row: they must not run, and nothing be gathered for them."""
    import __spark_entry__ as entry

    columns = "row_id long, sequence_id string, taxonomy string, taxonomy_source string, assignment_method string, cross_domain_conflict boolean, loaded_at timestamp_ntz"
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "preferred_taxonomy.parquet"))
    plan = entry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    stages = {s for s in ("ArrowEvalPython", "collect_list") if s in plan}
    assert stages == ({"ArrowEvalPython", "collect_list"} if name == "p5_consensus" else set())


def test_survivors_by_trust_equal_brute_force(spark):
    r = random.Random(5)
    rows = [(i, f"k{r.randrange(60)}" if r.random() < 0.5 else r.choice(["hot", None, f"one{i}"]), r.randrange(3), r.choice([None, "", "x", "y z", "é"]), r.choice([None, None, None, "p"])) for i in r.sample(range(5000), 1500)]
    rows += rows[:50]
    groups, want = {}, []
    for i, k, trust, *values in rows:
        groups.setdefault(k, []).append((trust, i, values))
    for k, held in groups.items():
        for f, name in enumerate("ab"):
            if k is not None and len(held) > 1 and (best := min(((t, i, v[f]) for t, i, v in held if v[f] is not None), default=None)):
                want.append((k, name, *best[1:]))
    df = spark.createDataFrame(rows, "row_id long, k string, trust int, a string, b string").repartition(5)
    out = survivors(df, F.col("k"), [Field("a", F.col("a")), Field("b", F.col("b"))], [F.col("trust")])
    assert sorted(tuple(x) for x in out.collect()) == sorted(want)


@pytest.mark.parametrize("name", ["p1_found", "p1_ranked", "p5_found", "p5_survivors", "p5_records"])
def test_query_equals_sql(spark, name):
    from tests.test_queries import FOLDER, compare

    if not FOLDER.exists():
        pytest.skip("no test tables")
    compare(spark, name)


def test_all_records_keeps_single_rows_and_groups_without_values(spark):
    schema = "row_id long, k string, trust int, a string, b boolean"
    rows = [(1, "g", 2, "x", None), (2, "g", 1, None, None), (3, "g", 3, "y", True), (4, "single", 1, "x", True), (5, "hole", 1, None, None), (6, None, 1, "x", True), (7, "none", 1, None, None), (8, "none", 1, None, None)]
    df = spark.createDataFrame(rows, schema)
    fields = [Field("a", F.col("a")), Field("b", F.col("b").cast("string"))]
    got = sorted(tuple(r) for r in all_records(df, F.col("k"), fields, [F.col("trust")]).collect())
    assert got == [("g", "x", "true"), ("hole", None, None), ("none", None, None), ("single", "x", "true")]
    assert all_records(df.limit(0), F.col("k"), fields, [F.col("trust")]).count() == 0


def test_p5_records_has_every_sequence(spark, tmp_path):
    import __spark_entry__ as entry

    one, two, three = ("SSU_" + c * 43 for c in "abc")
    rows = [(1, one, "SILVA", "native", True), (2, f" ssu_{two[4:]} ", "?", "", None), (3, two, None, None, None), (4, three, "PR2", "native", False), (5, three, "SILVA", "other", True), (6, "no id", "PR2", "native", True)]
    df = spark.createDataFrame(rows, "row_id long, sequence_id string, taxonomy_source string, assignment_method string, cross_domain_conflict boolean")
    df.withColumn("loaded_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).write.parquet(str(tmp_path / "preferred_taxonomy.parquet"))
    got = {r.sequence_id: (r.taxonomy_source, r.assignment_method, r.cross_domain_conflict) for r in entry.queries()["p5_records"](spark, str(tmp_path)).collect()}
    assert got == {one: ("silva", "native", "true"), two: (None, None, None), three: ("pr2", "native", "false")}
