import random

import pytest
from pyspark.sql import functions as F

from sedimark.operators import integrity as I
from sedimark.operators import intervals as V
from sedimark.operators import lineage as L
from sedimark.operators import ranking as R
from sedimark.operators import summaries as A
from sedimark.operators.trees import classify_by_neighbours, distances_from, leaf_distances, leaf_mismatches, ranked_neighbours


def brute_lca(paths):
    paths = [p for p in ([x.strip() for x in p.split(";")] if p else [] for p in paths)]
    for p in paths:
        while p and not p[-1]:
            p.pop()
    paths = [p for p in paths if p and p[0]]
    prefix = []
    for ranks in zip(*paths) if paths else []:
        if not ranks[0] or any(r != ranks[0] for r in ranks):
            break
        prefix.append(ranks[0])
    return ";".join(prefix)


def test_lowest_common_ancestor(spark):
    r = random.Random(5)
    groups = {f"g{i}": [r.choice([None, "", ";x", ";".join(r.choice(["a", "a", "b", "", " a "]) for _ in range(r.randrange(1, 6)))]) for _ in range(r.randrange(1, 5))] for i in range(200)}
    groups["gap"] = ["Bacteria;P;;OrderA", "Bacteria;P;ClassB;OrderB"]
    df = spark.createDataFrame([(k, p) for k, ps in groups.items() for p in ps], "k string, path string")
    got = {x.k: x.lca for x in L.lowest_common_ancestor(df, ["k"], "path").collect()}
    assert got == {k: brute_lca(ps) for k, ps in groups.items()} and got["gap"] == "Bacteria;P"


def test_common_value_and_preferred(spark):
    df = spark.createDataFrame([("a", "x"), ("a", ""), ("b", "x"), ("b", "y"), ("c", None), ("c", "")], "k string, v string")
    assert {r.k: r.v for r in df.groupBy("k").agg(L.common_value(F.col("v")).alias("v")).collect()} == {"a": "x", "b": "mixed", "c": ""}
    rows = spark.createDataFrame([(1, 0, "Bacteria", "Bacteria;P;C"), (1, 0, "Bacteria", "Bacteria;P;D"), (1, 9, "Archaea", "Archaea"), (2, 5, "Bacteria", "Bacteria"), (2, 5, "Archaea", "Archaea"), (3, 1, "Unclassified", "")], "k int, p int, d string, t string")
    got = {r.k: tuple(r)[1:] for r in L.preferred(rows, ["k"], F.col("p"), "d", "t").collect()}
    assert got == {1: (0, "Bacteria", "Bacteria;P", 2, True, False), 2: (5, "ambiguous", "", 2, True, True), 3: (1, "", "", 1, False, False)}


def test_contest(spark):
    schema = "s string, hit long, model string, a int, b int, e double, bits double"
    rows = [("c", 1, "RF00177", 14154, 15690, 0.0, 1612.8), ("c", 2, "RF01960", 14159, 15685, 3.8e-216, 719.0),
            ("d", 3, "RF00177", 1, 100, 1e-9, 50.0), ("d", 4, "RF01960", 90, 200, 1e-8, 60.0), ("d", 5, "RF00177", 190, 300, 1e-7, 40.0), ("e", 6, "RF00177", 1, 10, 1.0, 1.0)]
    df = spark.createDataFrame(rows, schema)
    won = V.greedy_overlap(df, ["s"], "hit", "model", "a", "b", F.col("e"), F.col("bits"), frozenset({"RF00177", "RF01960"}))
    assert sorted(r.hit for r in won.collect()) == [1, 3, 5, 6]  # 4 loses to 3 and does not block 5
    assert V.greedy_overlap(df.limit(0), ["s"], "hit", "model", "a", "b", F.col("e"), F.col("bits")).count() == 0
    hit = {"hit": 1, "model": "x", "start": 1, "end": 5, "e_value": 1.0, "bit_score": 1.0}
    with pytest.raises(V.Contest):
        V.settle([hit, hit | {"hit": 2, "model": "y"}], frozenset({"x"}))
    with pytest.raises(V.Contest):
        V.settle([hit, hit | {"hit": 2, "model": "y"}], frozenset({"x", "y"}))


def test_contest_against_brute_force(spark):
    r = random.Random(6)
    rows = [(f"s{r.randrange(3)}", i, r.choice("xy"), (a := r.randrange(300)), a + r.randrange(40), r.random(), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "s string, hit long, model string, a int, b int, e double, bits double")
    won = {x.hit for x in V.greedy_overlap(df, ["s"], "hit", "model", "a", "b", F.col("e"), F.col("bits")).collect()}
    expected = set()
    for s in ("s0", "s1", "s2"):
        hits = [dict(zip(("hit", "model", "start", "end", "e_value", "bit_score"), x[1:], strict=True)) for x in rows if x[0] == s]
        expected |= {h["hit"] for h in V.settle(hits)}
    assert won == expected


def test_regions(spark):
    schema = "k string, model_from int, model_to int, model_length int, seq_from int, seq_to int, strand string"
    rows = [("full", 1, 100, 100, 5, 104, "+"), ("one", 3, 50, 100, 60, 13, "-"), ("joint", 1, 40, 100, 10, 49, "+"), ("joint", 50, 90, 100, 200, 240, "+"),
            ("minus", 1, 40, 100, 300, 261, "-"), ("minus", 50, 90, 100, 200, 160, "-"), ("crossed", 1, 40, 100, 200, 239, "+"), ("crossed", 50, 90, 100, 10, 50, "+"),
            ("strands", 1, 40, 100, 10, 49, "+"), ("strands", 50, 90, 100, 240, 200, "-")]
    got = sorted(tuple(r) for r in V.extraction_regions(spark.createDataFrame(rows, schema), ["k"]).collect())
    assert got == [("crossed", 10, 50, "+", "simple"), ("crossed", 200, 239, "+", "simple"), ("full", 5, 104, "+", "simple"), ("joint", 10, 240, "+", "assembled"),
                   ("minus", 160, 300, "-", "assembled"), ("one", 13, 60, "-", "simple"), ("strands", 10, 49, "+", "simple"), ("strands", 200, 240, "-", "simple")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_contest_of_a_hot_key(spark, partitions):
    """A key that fills many partitions, with islands that go over their edges, against the contest of all its hits at once."""
    r = random.Random(11)
    rows = [(r.choice(["hot", "hot", "hot", "other"]), i, r.choice("AB"), s := r.randrange(2000), s + r.randrange(1, 60), float(r.randrange(1000)), float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "s string, hit long, model string, a int, b int, e double, bits double")
    won = V.greedy_overlap(df, ["s"], "hit", "model", "a", "b", F.col("e"), F.col("bits"), partitions=partitions)
    expected = set()
    for key in ("hot", "other"):
        hits = [{"hit": h, "model": m, "start": a, "end": b, "e_value": e, "bit_score": x} for s, h, m, a, b, e, x in rows if s == key]
        accepted = []
        for hit in sorted(hits, key=lambda h: (h["e_value"], -h["bit_score"], h["start"], h["end"], h["model"], h["hit"])):
            if not any(x["model"] != hit["model"] and x["start"] <= hit["end"] and hit["start"] <= x["end"] for x in accepted):
                accepted.append(hit)
        expected |= {(key, x["hit"]) for x in accepted}
    assert {tuple(x) for x in won.collect()} == expected


def test_ranking(spark):
    df = spark.createDataFrame([("q", f"s{i}", float(s), src) for i, (s, src) in enumerate([(9, "A"), (9, "B"), (8, "A"), (7, "C"), (1, "D")])], "q string, s string, bits double, src string")
    assert [tuple(r) for r in R.equal_best(df, ["q"], "bits", 1).collect()] == [("q", 9.0, 2, True)]
    assert R.first_rows(df, ["q"], [F.desc("bits"), F.col("s")], 2).count() == 2
    top = R.top_with_evidence(df, ["q"], [-F.col("bits"), F.col("s")], "bits", F.array("src"), ["B", "C", "D", "E"], 1)
    assert {r.s: (r.rank, r.reasons) for r in top.collect()} == {
        "s0": (1, "overall_top_n|equal_best_assignment"), "s1": (2, "equal_best_assignment|best_B"), "s3": (4, "best_C"), "s4": (5, "best_D")}
    assert top.where("false").count() == 0 and R.top_with_evidence(df.limit(0), ["q"], [-F.col("bits"), F.col("s")], "bits", F.array("src"), ["B"], 1).count() == 0
    near = spark.createDataFrame([("t", x, d) for x, d in (("a", 0.1), ("b", 0.2), ("c", 0.2 + 1e-13), ("d", 0.3))], "t string, leaf string, distance double")
    assert sorted(r.leaf for r in R.nearest_with_ties(near, ["t"], "distance", [F.col("leaf")], 2).collect()) == ["a", "b", "c"]
    plan = [tuple(r) for r in R.chunk_plan(spark.range(10).toDF("i"), "i", 4).orderBy("chunk").collect()]
    assert plan == [(1, 3, 0, 2), (2, 3, 3, 5), (3, 2, 6, 7), (4, 2, 8, 9)]


def test_ranking_with_nulls_ties_and_no_rows(spark):
    rows = [("q", "a", 5.0, "A"), ("q", "b", 5.0, "A"), ("q", "c", None, "B"), (None, "d", 9.0, "A"), ("p", "e", None, "A"), ("r", "f", 1.0, None)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "q string, s string, bits double, src string, rank_ int")
    order = [-F.col("bits"), F.col("s")]
    for frame, best, top, near in ((df, {"a", "b", "f"}, {"a": 1, "b": 2, "f": 1}, {"a", "b", "f"}), (df.limit(0), set(), {}, set())):
        assert {r.s for r in R.best_score_rows(frame, ["q"], "bits").collect()} == best
        assert {r.s: r["rank"] for r in R.top_with_evidence(frame, ["q"], order, "bits", F.array("src"), ["A", "B"], 1).collect()} == top
        got = R.candidates(frame, ["q"], F.col("bits"), [F.desc("bits"), F.col("s")], "0.98", F.col("bits") > 0, 1)
        assert {r.s for r in got.collect()} == near and got.columns == [*df.columns, "threshold", "truncated"]
    assert {r.q: r.truncated for r in R.candidates(df, ["q"], F.col("bits"), [F.desc_nulls_last("bits"), F.col("s")], "0.98", F.col("bits") > 0, 1).collect()} == {"q": True, "r": False}
    votes = R.vote(df.where("src is not null"), ["q"], "s", "src", ["A", "B"], [F.desc("bits"), F.col("s")], "bits", 5)
    assert {r.q: (r.votes_A, r.votes_B, r.chosen) for r in votes.collect()} == {"q": (2, 1, "A"), "p": (1, 0, "A")}


def test_nearest_vectors_of_every_query(spark):
    r = random.Random(7)
    vectors = {i: [float(r.randrange(4)) for _ in range(3)] for i in range(90)}  # a coarse grid, so that many tie
    rows = spark.createDataFrame([*vectors.items(), (90, None)], "id long, v array<float>").repartition(3)
    expected = set()
    for q in range(0, 90, 20):
        far = {i: round(sum((a - b) ** 2 for a, b in zip(vectors[q], v, strict=True)) ** 0.5, 6) for i, v in vectors.items() if i != q}
        expected |= {(q, i, d) for i, d in far.items() if d <= sorted(far.values())[3]}
    for block in (7, 1024):
        got = R.nearest_vectors(rows, rows.where("id % 20 = 0"), "id", "v", 4, block=block)
        assert sorted(tuple(x) for x in got.collect()) == sorted(expected)
    assert sorted(x.item for x in R.nearest_vectors(rows.where("id < 3"), rows.where("id = 0"), "id", "v", 10).collect()) == [1, 2]


def test_boundary_knn_searches_every_query(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(i, [float(i), 0.0]) for i in range(61)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = entry.queries()["boundary_knn"](spark, str(tmp_path)).collect()
    assert {r.query_id for r in got} == {0, 20, 40, 60} and sorted(r.vec_id for r in got if r.query_id == 20) == [*range(15, 20), *range(21, 26)]


def test_gap_columns_of_whole_lines(spark, tmp_path):
    import __spark_entry__ as entry

    lines = ["A-" * 30 + "x", "short", "", None, "~" * 50 + ".", "AC"]
    spark.createDataFrame([(x,) for x in lines], "line string").write.parquet(str(tmp_path / "raw_headers.parquet"))
    got = {r.pos: (r.rows, r.gaps, r.inserted) for r in entry.queries()["gap_columns"](spark, str(tmp_path)).collect()}
    expected = {}
    for i in range(61):
        column = [x[i] for x in lines if x and len(x) > i]
        expected[i + 1] = (len(column), sum(c in ".-_~" for c in column), any(c == "." or "a" <= c <= "z" for c in column))
    assert got == expected


def test_revcomp_of_whole_texts(spark, tmp_path):
    import __spark_entry__ as entry

    texts = ["ACGU" * 40 + "é", "short", "", None, "x\r\nA\U0001f9ec"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.piece for r in entry.queries()["substr_revcomp"](spark, str(tmp_path)).collect()}
    assert got == {i: x.translate(str.maketrans("ACGTUacgtu", "TGCAAtgcaa"))[::-1] for i, x in enumerate(texts) if x is not None}


def test_summaries(spark):
    n = spark.createDataFrame([(95, 100), (0, 0)], "k long, n long").select(A.wilson_lower_bound(F.col("k"), F.col("n")).alias("w")).collect()
    assert abs(n[0].w - 0.888250) < 1e-5 and n[1].w == 0
    caps = spark.createDataFrame([("a", 0, True), ("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 0, False), ("c", 0, True)], "k string, i int, ok boolean")
    assert {r.k: r.cap for r in A.contiguous_cap(caps, ["k"], "i", F.col("ok")).collect()} == {"a": 1, "b": -1, "c": 0}


def test_integrity(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(I.IntegrityError, match="twice"):
        I.require({"twice": I.duplicate_keys(df, ["k"]), "fine": df.limit(0)})
    I.require({"fine": df.limit(0)})
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "x")], "k int, v string")
    b = spark.createDataFrame([(2, None), (3, "y"), (4, "x")], "k int, v string")
    assert {r.k: r.status for r in I.full_difference(a, b, ["k"], ["v"]).collect()} == {1: "missing", 2: "same", 3: "changed", 4: "extra"}


def test_trees(spark):
    tree = "((q:1,'b c':2)90:0.5,(c:1,d:1.5)80:1[x])root;"
    assert distances_from(tree, "q") == [("b c", 3.0, "90"), ("c", 3.5, "90"), ("d", 4.0, "90")]
    assert distances_from("(q:1,b:2,(c:1,d:1)80:1)99;", "q")[0] == ("b", 3.0, None)  # the parent is the root, which has no edge
    with pytest.raises(ValueError):
        distances_from(tree, "z")
    trees = spark.createDataFrame([(1, tree, "q"), (2, None, "q"), (3, tree, "q")], "t int, newick string, query string")
    schema = "tree int, leaf string, hit_rank int, taxonomy string, taxonomy_source string, taxonomy_domain string, compartment string, centroid_taxonomy string, centroid_taxonomy_source string"
    references = spark.createDataFrame([
        (1, "b c", 1, "", "PR2", "ambiguous", "x", "B;Z", "PR2"), (1, "c", 2, "B;P", "SILVA", "B", "", "B;P;C", "PR2"), (1, "d", 3, "B;P;D", "PR2", "B", "plastid", "B;P;X", "SILVA"),
        (3, "b c", 1, "", "", "", "", "", ""), (3, "c", 2, "Unclassified", "", "Unclassified", "", "", ""), (3, "d", 3, "", "", "ambiguous", "", "", "")], schema)
    ranked = ranked_neighbours(leaf_distances(trees, "t", "newick", "query"), references, 2)
    got = {(r.tree, r.leaf): (r.neighbour_rank, r.used, ";".join(r.path), r.source, r.basis) for r in ranked.collect()}
    assert got[1, "b c"] == (1, False, "", "", "ambiguous") and got[1, "c"] == (2, True, "B;P;C", "PR2", "centroid_taxonomy") and got[1, "d"] == (3, True, "B;P;D", "PR2", "preferred_taxonomy")
    assert got[3, "c"] == (2, False, "", "", "unclassified")
    rows = {r.tree: tuple(r)[1:] for r in classify_by_neighbours(ranked).collect()}
    assert rows == {1: ("B;P", "B", "PR2", "plastid", "tree_nearest_named_lca", 2, "b c", 3.0, "90"), 3: ("Unclassified", "Unclassified", "", "", "tree_unclassified_no_named_neighbors", 0, "b c", 3.0, "90")}
    wrong = leaf_mismatches(leaf_distances(trees, "t", "newick", "query"), references.where("leaf <> 'd'"))
    assert {k: df.count() for k, df in wrong.items()} == {"leaf without reference": 2, "reference without leaf": 0}


def test_newick_distance_reaches_every_leaf(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(i, 1) for i in range(1500)] + [(2000, 2), (2001, 2), (3000, 3)]
    spark.createDataFrame(rows, "s_suppkey long, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    got = sorted(tuple(r) for r in entry.queries()["newick_distance"](spark, str(tmp_path)).collect())
    assert got == sorted([(1, f"n{i}", 1.75 + 0.5 * (i - 1), "90") for i in range(1, 1500)] + [(2, "n2001", 1.75, None)])


def test_regions_beside_a_full_hit(spark):
    """A full hit and two collinear partial hits of one subject: the full one, and one assembled from the others."""
    schema = "k string, model_from int, model_to int, model_length int, seq_from int, seq_to int, strand string"
    rows = [("s", 1, 100, 100, 5, 104, "+"), ("s", 1, 40, 100, 200, 239, "+"), ("s", 50, 90, 100, 250, 290, "+")]
    got = sorted(tuple(r) for r in V.extraction_regions(spark.createDataFrame(rows, schema), ["k"]).collect())
    assert got == [("s", 5, 104, "+", "simple"), ("s", 200, 290, "+", "assembled")]


def test_assignment_from_equally_best_rows(spark):
    schema = "q string, taxonomy string, domain string, cross_domain_conflict boolean, compartment string, assignment_method string, taxonomy_alternatives string"
    rows = [
        ("lca", "Bacteria;P;C", "Bacteria", False, "plastid", "native", ""), ("lca", "Bacteria;P;D", "Bacteria", False, "", "native", ""),
        ("conflict", "", "ambiguous", True, "mixed", "cross_domain_ambiguous_exact_sequence", '[{"domain":"Archaea","taxonomy":"Ä","n":1}]'),
        ("two", "Bacteria;P", "Bacteria", False, "plastid", "native", ""), ("two", "", "ambiguous", False, "", "native", ""),
        ("cut", "Bacteria;P", "Bacteria", False, "plastid", "a", ""), ("cut", "Bacteria;P", "Bacteria", False, "plastid", "b", ""), ("cut", "Bacteria;P", "Bacteria", False, "plastid", "b", ""),
        ("none", "", "", False, "", "", ""), ("domain", ";x", "Archaea", None, None, None, None), ("domain", None, "Archaea", None, None, None, None)]
    got = {r.q: (r.domain, r.taxonomy, r.compartment, r.assignment_method, r.ties, r.truncated, r.taxonomy_alternatives) for r in L.assign_taxonomy(spark.createDataFrame(rows, schema), ["q"], 2, alternatives=True).collect()}
    assert got["lca"] == ("Bacteria", "Bacteria;P", "plastid", "native", 2, False, "")
    assert got["conflict"] == ("ambiguous", "", "mixed", "cross_domain_ambiguous_exact_sequence", 1, False, '[{"domain":"Archaea","n":"1","taxonomy":"\\u00c4"}]')
    assert got["two"][:4] == ("ambiguous", "", "mixed", "cross_domain_ambiguous_equal_best") and got["two"][6].startswith('[{"assignment_method":"native","compartment":""') and got["two"][6].count("{") == 2
    assert got["cut"] == ("Bacteria", "Bacteria", "", "truncated_equal_best_lca", 3, True, "")
    assert got["none"] == ("", "Unclassified", "", "", 1, False, "") and got["domain"] == ("Archaea", "Archaea", "", "", 2, False, "")
    wrong = spark.createDataFrame([("w", "", "ambiguous", True, "", "", "{}")], schema)
    with pytest.raises(Exception, match="JSON array"):
        L.assign_taxonomy(wrong, ["q"], 2, alternatives=True).collect()
    assert L.assign_taxonomy(wrong, ["q"], 2, alternatives=True, checked=False).first().taxonomy_alternatives.startswith('[{"assignment_method"')


def test_integrity_of_texts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",), ("",)], "t string")
    assert sorted(tuple(r) for r in I.duplicate_texts(df.where("t is not null"), "t").collect()) == [("", 2), ("a", 2)]


def test_region_collinear_sees_both_ends(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [("apart", 1, 5, 1, 1, "N"), ("apart", 10, 5, 5, 2, "N"), ("enclosed", 1, 20, 1, 1, "N"), ("enclosed", 10, 5, 5, 2, "N"), ("same end", 1, 14, 1, 1, "N"), ("same end", 10, 5, 5, 2, "N"),
            ("minus", 1, 5, 9, 1, "R"), ("minus", 10, 5, 5, 2, "R"), ("crossed", 1, 5, 5, 1, "R"), ("crossed", 10, 5, 9, 2, "R"), ("strands", 1, 5, 1, 1, "N"), ("strands", 10, 5, 5, 2, "R")]
    spark.createDataFrame(rows, "l_orderkey string, l_partkey long, l_quantity int, l_suppkey long, l_linenumber int, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.l_orderkey: r.collinear for r in entry.queries()["region_collinear_ends"](spark, str(tmp_path)).collect()}
    assert got == {"apart": True, "enclosed": False, "same end": False, "minus": True, "crossed": False, "strands": False}
    got = {r.l_orderkey: r.collinear for r in entry.queries()["region_collinear"](spark, str(tmp_path)).collect()}
    assert got == {"apart": True, "enclosed": True, "same end": True, "minus": True, "crossed": False, "strands": False}
