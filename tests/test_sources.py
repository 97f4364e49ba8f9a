import pytest
from pyspark.sql import functions as F

from sedimark.functions import sequences as S
from sedimark.operators.integrity import IntegrityError, require
from sedimark.plans import annotate, config
from sedimark.sinks import files
from sedimark.sources import text


def counts(violations):
    return {k: df.count() for k, df in violations.items() if df.count()}


def test_whole_records_join_to_the_file(spark, tmp_path):
    (tmp_path / "q.fna").write_text(">a one\nAC\nGT\n>b\n\n\n>c\nA")
    records = text.whole_records(spark, str(tmp_path / "q.fna"))
    rows = records.orderBy("place").collect()
    assert "".join(r.text for r in rows) == ">a one\nAC\nGT\n>b\n\n\n>c\nA\n" and [r.id for r in rows] == ["a", "b", "c"]
    assert counts(text.record_violations(records)) == {"empty sequence": 1}
    (tmp_path / "w.fna").write_text(">é\nAC\n>a\nA\n>a\nC\n")
    assert counts(text.record_violations(text.whole_records(spark, str(tmp_path / "w.fna")))) == {"id is not ASCII": 1, "duplicate id": 1}
    assert counts(text.query_violations(text.fasta(spark, str(tmp_path / "q.fna")))) == {"empty sequence": 1}
    found = text.assemblies(spark, str(tmp_path))
    assert sorted(r["sample"] for r in found.collect()) == ["q", "w"]
    (tmp_path / "-bad.fa").write_text(">a\nA\n")
    with pytest.raises(Exception, match="invalid sample identifier"):
        text.assemblies(spark, str(tmp_path)).collect()


MODEL = "INFERNAL1/a [1.1]\nNAME  SSU_rRNA_bacteria\nACC   RF00177\nCLEN  1533\n//\nHMMER3/f\nNAME other\nACC x y z\n//\n"


def test_covariance_models(spark, tmp_path):
    assert text.covariance_model(MODEL, "RF00177") == ("SSU_rRNA_bacteria", "RF00177", 1533)
    assert text.covariance_model("INFERNAL1/a\nNAME own\nCLEN 7\n//\n", "x") == ("own", "own", 7)
    for broken in (MODEL.replace("RF00177", "RF01960"), MODEL.replace("//", ""), MODEL.replace("CLEN  1533", "CLEN  0"), MODEL.replace("CLEN", "LEN"), MODEL + "INFERNAL1/a\n", MODEL.replace("ACC   RF00177\n", ""), MODEL.replace("ACC ", "NAME x\nACC ")):
        with pytest.raises(IntegrityError):
            text.covariance_model(broken, "RF00177")
    with pytest.raises(IntegrityError):
        text.covariance_model(MODEL, "mine")
    (tmp_path / "RF00177.cm").write_text(MODEL)
    assert [tuple(r) for r in text.models(spark, str(tmp_path), {"RF00177": "16S"}).collect()] == [("RF00177", "SSU_rRNA_bacteria", "RF00177", 1533, "16S")]
    with pytest.raises(IntegrityError):
        text.models(spark, str(tmp_path), {})


def test_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("sample\tmodel\ns1\tm\n")
    (tmp_path / "b.tsv").write_text("sample\tmodel\n")
    (tmp_path / "c.tsv").write_text('sample\tmodel\ns3\t"q"\n\t\n')
    rows = text.tables(spark, str(tmp_path / "*.tsv"), ["sample", "model"])
    assert sorted(tuple(r) for r in rows.collect()) == [("s1", "m", "a.tsv"), ("s3", '"q"', "c.tsv")]
    table, twice = text.keyed(spark, str(tmp_path / "a.tsv"), ["sample", "model"], ["sample"])
    assert table.count() == 1 and twice.count() == 0
    (tmp_path / "d.tsv").write_text("model\tsample\ns1\tm\n")
    with pytest.raises(Exception, match="(?i)header"):
        text.tables(spark, str(tmp_path / "d.tsv"), ["sample", "model"]).collect()
    (tmp_path / "h.tsv").write_text("subject\tmodel\tmodel_accession\tmodel_from\tmodel_to\tsequence_from\tsequence_to\tstrand\tbit_score\te_value\n" + "c\tm\ta\t1\t9\t3\t12\t+\t5.5\t1e-9\n" * 2 + "\tm\ta\t1\t9\t3\t12\t+\t5.5\t1e-9\n")
    assert counts(text.accepted_violations(text.accepted(spark, str(tmp_path / "h.tsv")))) == {"duplicate accepted hit": 1, "incomplete accepted hit": 1}
    (tmp_path / "map").write_text("c1_d_7\t9\t3\t-\tassembled\nc2\t1\t2\t+\tsimple\n")
    assert sorted(tuple(r) for r in text.region_map(spark, str(tmp_path / "map")).collect()) == [("c1", 3, 9, "-", "assembled"), ("c2", 1, 2, "+", "simple")]


def test_taxonomy_and_centroids(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("sequence_id\ttaxonomy\ttaxonomy_source\tdomain\tcross_domain_conflict\n a \tB;P\tSILVA\tB\t\nb\t\tSILVA\tambiguous\tTrue\n")
    rows = {r.sequence_id: (r.taxonomy, r.cross_domain_conflict, r.compartment) for r in text.taxonomy(spark, str(tmp_path / "t.tsv")).collect()}
    assert rows == {"a": ("B;P", False, ""), "b": ("", True, "")}
    text.taxonomy(spark, str(tmp_path / "t.tsv")).write.parquet(str(tmp_path / "t.parquet"))
    assert text.taxonomy(spark, str(tmp_path / "t.parquet")).count() == 2
    with pytest.raises(IntegrityError):
        text.named_columns(spark, str(tmp_path / "t.tsv"), ["nothing"])
    (tmp_path / "c.tsv").write_text("centroid\tother\tcluster_id\nh1 x\t\tk1\nh2\t\tk2\nh2\t\tk2\n\t\tk3\n")
    (tmp_path / "f.fna").write_text(">h1 x\nacgu\n>h9\nA\n")
    pairs, records = text.centroids(spark, str(tmp_path / "c.tsv")), text.fasta(spark, str(tmp_path / "f.fna"))
    assert [tuple(r) for r in text.centroid_sequences(pairs, records).collect()] == [("k1", "ACGT")]
    assert counts(text.centroid_violations(pairs, records)) == {"no cluster or centroid": 1, "duplicate cluster": 1, "centroid of several clusters": 1, "centroid without record": 2}
    (tmp_path / "l.tsv").write_text("IMG Genome ID\tLatitude\tLongitude\n33\t1\tNA\n")
    assert [tuple(r) for r in text.location_table(spark, str(tmp_path / "l.tsv")).collect()] == [("33", "1", "NA")]
    (tmp_path / "g.tsv").write_text("cluster_id\tcentroid\tsequences\nc1\tx\t['IMG_1', 'IMG_2']\nc1\ty\t['IMG_3']\nc2\tz\t['IMG_2']\n")
    assert counts(text.cluster_violations(text.clusters(spark, str(tmp_path / "g.tsv")))) == {"duplicate cluster": 1, "member of two clusters": 1}
    (tmp_path / "e.m8").write_text("q\ts\t90\t10\t10\t10\t90\t5\n" * 2 + "q\tz\t190\t10\t10\t10\t90\t5\n")
    assert counts(text.hit_violations(text.exact_hits(spark, str(tmp_path / "e.m8")))) == {"duplicate pair": 1, "figure out of range": 1}


def test_alignment_quality(spark):
    rows = spark.createDataFrame([("QUERY", "AC-.Ga-"), ("r1", "A--.GT-"), ("r2", "U--~GT-"), ("r3", "A_--GT-")], "id string, row string")
    require(S.alignment_violations(rows, "id", "row"))
    got = S.alignment_quality(rows, "id", "row", 0.5).first().asDict()
    assert got == {"input_columns": 7, "retained_columns": 2, "removed_insert_columns": 2, "removed_high_gap_columns": 3, "query_residue_columns": 2}
    wrong = rows.where("id <> 'QUERY'").withColumn("row", F.when(F.col("id") == "r1", "A!").otherwise(F.col("row")))
    assert counts(S.alignment_violations(wrong, "id", "row")) == {"too few rows": 1, "no query": 1, "unequal lengths": 1, "unexpected character": 1}


def test_more_sinks(spark, tmp_path):
    (tmp_path / "b.m8").write_text("b1\nb2\n")
    (tmp_path / "a.m8").write_text("a1\na2\n")
    files.concatenated(spark, str(tmp_path / "*.m8"), str(tmp_path / "whole"))
    assert [r.value for r in spark.read.text(sorted(str(p) for p in (tmp_path / "whole").glob("part-*"))).collect()] == ["a1", "a2", "b1", "b2"]
    schema = "sample string, model string, subject string, start int, end int, strand string, kind string, name string, sequence string"
    samples = spark.createDataFrame([("s", "m"), ("none", "m")], "sample string, model string")
    files.extraction(spark.createDataFrame([("s", "m", "c", 3, 6, "+", "simple", "c|3-6|strand_+|simple", "ACGT")], schema), samples, str(tmp_path / "x"))
    assert [r.value for r in spark.read.text(str(tmp_path / "x" / "sequences")).collect()] == [">c|3-6|strand_+|simple", "ACGT"]
    assert text.tables(spark, str(tmp_path / "x" / "hits"), annotate.HIT_FIELDS).first().coordinates == "3-6" and text.tables(spark, str(tmp_path / "x" / "samples"), ["sample", "model"]).count() == 2
    nested = spark.createDataFrame([(1, {"z": 1, "a": 2}, [(1, "x")])], "k int, m map<string,int>, l array<struct<z:int,b:string>>")
    files.json_lines(nested, str(tmp_path / "j"), ["k"], single=True)
    assert spark.read.text(str(tmp_path / "j")).first().value == '{"k":1,"l":[{"b":"x","z":1}],"m":{"a":2,"z":1}}'
    decisions = spark.createDataFrame([("IMGEV_" + "0" * 64, '{"reason":"x"}')], "evidence_id string, decision string")
    files.evidence_catalog(decisions, str(tmp_path / "catalog"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "catalog")).collect()]
    assert lines[0].startswith('{"evidence_records":1,') and lines[1] == '{"content_sha256":"' + "0" * 64 + '","decision":{"reason":"x"},"evidence_id":"IMGEV_' + "0" * 64 + '","record_type":"evidence"}'
    one, two = (files.archive(str(tmp_path / "x"), str(tmp_path / f"{n}.tar.zst")) for n in "ab")
    assert one == two and (tmp_path / "a.tar.zst").read_bytes()[:4] == b"\x28\xb5\x2f\xfd"


def test_configuration():
    text_ = '{"schema_version": 1, "models": {"RF00177": "16S", "RF01960": "18S"}}'
    markers = config.marker_map(text_, '{"schema_version": 1, "models": {"mine": "16S"}}')
    assert markers == {"RF00177": "16S", "RF01960": "18S", "mine": "16S"} and config.tree_models(config.marker_map(text_)) == {"16S": "RF00177", "18S": "RF01960"}
    for broken in ("{", '{"a": 1, "a": 2}', '{"schema_version": 2, "models": {}}', '{"schema_version": 1, "models": {"x": "23S"}}', '{"schema_version": 1, "models": {"-x": "16S"}}'):
        with pytest.raises(IntegrityError):
            config.marker_map(broken)
    with pytest.raises(IntegrityError):
        config.tree_models(markers)
    installed = {"img": {"16S": "/img/16S"}}
    assert config.index_of("mine", markers, "img", installed) == "/img/16S" and config.index_of("mine", markers, "curated", installed, "/old") == "/old"
    for model, profile in (("none", "img"), ("RF01960", "img"), ("mine", "other")):
        with pytest.raises(IntegrityError):
            config.index_of(model, markers, profile, installed, "/old")
    assert config.Parameters.read({"top_hits": 3}).top_hits == 3
    for wrong in ({"top_hits": 0}, {"top_hits": "3"}, {"tree_references": 2}, {"tree_gap_fraction": 1}, {"tree_classification": "yes"}, {"database_profile": "a b"}, {"nothing": 1}, {"minimum_length": -1}, {"max_targets": True}):
        with pytest.raises(IntegrityError):
            config.Parameters.read(wrong)
