import json

import pytest
from pyspark.sql import functions as F

from sedimark import storage
from sedimark.operators.integrity import IntegrityError
from sedimark.plans import calibrate, chunks, release
from tests.test_pipeline import PREPARED


def queries(spark, n=10):
    return spark.range(n).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("id"), F.lit("ACGT").alias("sequence"))


def test_interrupted_search(spark, tmp_path):
    folder, ran, state = str(tmp_path / "s"), [], ["v1"]

    def search(df):
        ran.append(sorted(r.id for r in df.collect()))
        if fail and len(ran) == fail:
            raise RuntimeError("interrupted")
        return df.select("id", F.length("sequence").alias("hits"))

    fail = 3
    with pytest.raises(RuntimeError):
        chunks.searched(queries(spark), folder, search, lambda: state[0], 4)
    assert [len(r) for r in ran] == [3, 3, 2]
    with pytest.raises(IntegrityError, match="chunk 3: no receipt; chunk 4: no receipt"):
        chunks.gather(spark, folder, "v1")
    assert not storage.exists(spark, folder + "/complete.json")
    fail = 0
    whole = chunks.searched(queries(spark).repartition(3), folder, search, lambda: state[0], 4)
    assert len(ran) == 5 and sorted(sum(ran[:2] + ran[3:], [])) == sorted(f"q{i}" for i in range(10)) and whole.count() == 10
    complete = json.loads(storage.read_text(spark, folder + "/complete.json"))
    assert complete["chunks"] == 4 and complete["results"] == chunks.fingerprint(whole)
    assert not chunks.run(spark, folder, 1, search, lambda: "v1") and chunks.run(spark, folder, 1, search, lambda: "v1", force=True)
    # a result that was changed, another database, a database that changes meanwhile, another plan
    spark.createDataFrame([("x", 1)], "id string, hits int").write.mode("overwrite").parquet(folder + "/results/2")
    with pytest.raises(IntegrityError, match="chunk 2: result differs"):
        chunks.gather(spark, folder, "v1")
    with pytest.raises(IntegrityError, match="another database"):
        chunks.gather(spark, folder, "v2")
    moving = iter(["v1", "v2"])
    with pytest.raises(IntegrityError, match="database changed"):
        chunks.run(spark, folder, 2, search, lambda: next(moving), force=True)
    with pytest.raises(IntegrityError, match="chunk 2: no receipt"):
        chunks.gather(spark, folder, "v1")
    with pytest.raises(IntegrityError, match="other queries"):
        chunks.prepare(queries(spark, 9), folder, 4)
    with pytest.raises(IntegrityError, match="duplicate key"):
        chunks.prepare(queries(spark).union(queries(spark)), str(tmp_path / "d"), 2)
    with pytest.raises(IntegrityError):
        chunks.run(spark, folder, 5, search, lambda: "v1")
    storage.write_text(spark, folder + "/receipts/1.json", "{damaged")
    with pytest.raises(IntegrityError, match="chunk 1: no receipt"):
        chunks.gather(spark, folder, "v1")


def test_more_chunks_than_queries_and_none(spark, tmp_path):
    search = lambda df: df.select("id")
    assert chunks.searched(queries(spark, 2), str(tmp_path / "a"), search, lambda: "v", 3).count() == 2
    assert chunks.searched(queries(spark, 0), str(tmp_path / "b"), search, lambda: "v").count() == 0


def test_portable_and_reused(spark, tmp_path):
    value = {"files": ["/data/db/16S.nin", "plain"], "query": "/work/q.fna", "n": 3}
    assert chunks.portable(value, {"/data/db": "database", "/work/q.fna": "query"}) == {"files": ["<database>/16S.nin", "plain"], "query": "<query>", "n": 3}
    with pytest.raises(IntegrityError):
        chunks.portable(value, {"/data/db": "database"})
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for key in ({"a": 1}, {"a": 1}, {"a": 2}):
        assert chunks.reused(spark, str(tmp_path / "r"), key, make).count() == 3
    assert len(made) == 2


def test_published_folder_comes_back(spark, tmp_path):
    for name in ("old", "new"):
        storage.write_text(spark, str(tmp_path / name / "f"), name)
    target = str(tmp_path / "old")

    def refuse(path):
        raise ValueError(path)

    with pytest.raises(ValueError):
        storage.publish(spark, str(tmp_path / "new"), target, refuse)
    assert storage.read_text(spark, target + "/f") == "old"
    storage.write_text(spark, str(tmp_path / "new" / "f"), "new")
    storage.publish(spark, str(tmp_path / "new"), target)
    assert storage.read_text(spark, target + "/f") == "new" and sorted(p.name for p in tmp_path.iterdir()) == ["old"]


def test_build(spark, tmp_path):
    prepared = spark.createDataFrame([("SILVA", "1", "a", "h", "16S", None, "ACGT", "Bacteria;P", "", "native"), ("IMG", "9", "c", "h", "16S", "33", "GGGG", None, "", "")], PREPARED)
    columns = "source_identifier string, taxonomy string, taxonomy_source string, compartment string, assignment_method string, evidence string, centroid_name string, centroid_taxonomy string, centroid_taxonomy_source string"
    derived = spark.createDataFrame([("c", "Bacteria", "SILVA", "", "updated_reference_cluster", "IMGEV_1", "n", "Bacteria;Q", "SILVA")], columns)
    places = spark.createDataFrame([("33", "1", "2")], "taxon_oid string, latitude string, longitude string")
    folder = str(tmp_path / "release")
    tables = release.build(prepared, folder, derived, places)
    assert {k: df.count() for k, df in tables.items()} == {"sequences": 2, "source_records": 2, "taxonomy_assignments": 2, "img_location": 1, "preferred_taxonomy": 2}
    assert json.loads(storage.read_text(spark, folder + "/release.json"))["rows"]["sequences"] == 2
    with pytest.raises(IntegrityError, match="IMG record without taxonomy"):
        release.build(prepared, folder)
    assert spark.read.parquet(folder + "/preferred_taxonomy").count() == 2 and [p.name for p in tmp_path.iterdir()] == ["release"]


def test_outcomes_fit_their_calibration(spark):
    schema = "cluster_id string, centroid string, status string, reason string, taxonomy string, taxonomy_source string, centroid_taxonomy string, centroid_taxonomy_source string, domain string, rank_cap int, propagation_cap int"
    good = ("k", "q", "classified", "", "B", "SILVA", "B;P", "SILVA", "B", 1, 0)
    change = lambda name, **k: (name, *[k.get(c.split()[0], v) for c, v in zip(schema.split(", ")[1:], good[1:], strict=True)])
    rows = [good, change("cap", rank_cap=2), change("deep", taxonomy="B;P"), change("reason", reason="x"), change("stratum", taxonomy_source="PR2", centroid_taxonomy_source="PR2", rank_cap=None), change("failed", domain="A", taxonomy="A", centroid_taxonomy="A", rank_cap=None),
            change("member", propagation_cap=None), change("centroid", centroid_taxonomy="A"), change(" ")]
    strata = spark.createDataFrame([("16S", "SILVA", "B", "calibrated", 1, ""), ("16S", "SILVA", "A", "failed", None, "x")], "marker string, taxonomy_source string, domain string, status string, rank_cap int, reason string")
    found = {k: sorted(r.cluster_id for r in df.collect()) for k, df in calibrate.outcome_violations(spark.createDataFrame(rows, schema), strata, "16S").items()}
    assert found == {
        "no cluster or centroid": [" "], "classified with a reason": ["reason"], "missing stratum": ["stratum"], "failed stratum of a classified outcome": ["failed"], "wrong calibration cap": ["cap"],
        "wrong propagation cap": ["member"], "member taxonomy beyond its cap": ["deep"], "centroid taxonomy of another domain": ["centroid"]}
