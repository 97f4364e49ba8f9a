import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sedimark.functions import sequences as S
from sedimark.functions import text as X
from sedimark.operators.integrity import IntegrityError, require
from sedimark.operators.trees import classify_by_neighbours, leaf_distances, ranked_neighbours
from sedimark.plans import annotate, calibrate, release, reports
from sedimark.sinks import files
from sedimark.sources import headers, text
from sedimark.streaming import arrivals


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_scalars(spark):
    seq = "ACGTNRY"
    assert one(spark, S.reverse_complement(F.lit(seq))) == "RYNACGT"
    assert one(spark, S.normal_sequence(F.lit(" acg\nu "))) == "ACGT"
    assert one(spark, S.content_id(F.lit(seq))) == "SSU_" + base64.urlsafe_b64encode(hashlib.sha256(seq.encode()).digest()).decode().rstrip("=")
    assert one(spark, S.stable_id("SRC_", [F.lit("a"), F.lit(None).cast("string"), F.lit("b")])) == "SRC_" + hashlib.sha256(b"a\0\0b").hexdigest()
    assert one(spark, S.wrapped(F.lit("ABCDEFGH"), 4)) == "ABCD\nEFGH"
    assert [one(spark, S.coordinate(F.lit(x), 90.0)) for x in ("12.5", "NA", "", "91", "x", "nan")] == [12.5, None, None, None, None, None]
    assert one(spark, S.plain_decimal(F.lit("20.5000").cast("decimal(9,4)"))) == "20.5" and one(spark, S.plain_decimal(F.lit("20.0000").cast("decimal(9,4)"))) == "20"
    numbers = spark.createDataFrame([(20.0,), (97.125,), (2.675,), (0.1234567,), (None,)], "v double").select(X.general_format()(F.col("v")).alias("g"), X.rounded_text(2)(F.col("v")).alias("r")).collect()
    assert [tuple(n) for n in numbers] == [("20", "20.0"), ("97.125", "97.12"), ("2.675", "2.67"), ("0.123457", "0.12"), ("", "")]
    for t in ("plain", "Größe", "😀 中", 'tab\t"'):
        assert one(spark, X.ascii_escaped(F.to_json(F.struct(F.lit(t).alias("a"))))) == json.dumps({"a": t}, separators=(",", ":"))
    rows = spark.createDataFrame([(1, "AC-.Ga"), (2, "A--.GT")], "id int, row string")
    assert {r.id: r.row for r in S.trimmed_alignment(rows, "id", "row", 0.5).collect()} == {1: "ACG", 2: "A-G"}


def test_fasta_and_adapters(spark, tmp_path):
    silva, pr2 = tmp_path / "s.fasta", tmp_path / "p.fasta"
    silva.write_text(">A1.1.4 Bacteria;Phy;Cla;str. 1\nACG\nU\n>A2.1.4 Eukaryota;X\nACGU\n>bad\nAXX-\n")
    pr2.write_text(">B1.1.4_U|18S_rRNA|plastid||Eukaryota:plas|a:plas|b||||||\nACGT\n>B2.1.4_U|16S_rRNA|nucleus||Bacteria|||||||||\nACGT\n>B3.1.4_U|16S_rRNA|nucleus||Eukaryota:mito||||||||\nACGT\n")
    records = text.fasta(spark, str(silva))
    assert sorted((r.id, r.sequence) for r in records.collect()) == [("A1.1.4", "ACGU"), ("A2.1.4", "ACGU"), ("bad", "AXX-")]
    assert [(r.header, r.reason) for r in text.fasta_violations(records).collect()] == [("bad", "not_nucleotide")]
    ranks = spark.createDataFrame([("Bacteria", "domain"), ("Bacteria;Phy", "phylum"), ("Bacteria;Phy;Cla", "order")], "path string, rank string")
    got = headers.silva_records(records, ranks, "1").collect()
    assert [(r.source_identifier, r.taxonomy, r.marker) for r in got] == [("A1.1.4", "Bacteria;Phy;;Cla", "16S")]
    assert headers.silva_records(records.union(records), ranks, "1").count() == 2  # repeated records stay
    assert [(r.header, r.reason) for r in headers.header_violations(records, "SILVA").collect()] == [("bad", "identifier")]
    with pytest.raises(Exception, match="rank table without the domain"):
        headers.silva_records(records, ranks.where("path <> 'Bacteria'"), "1").collect()
    (tmp_path / "ranks.tsv").write_text("Bacteria; Phy ;;\t1\tPhylum\t\t\nBacteria;\t2\tdomain\t\t\n")
    assert sorted(tuple(r) for r in text.rank_table(spark, str(tmp_path / "ranks.tsv")).collect()) == [("Bacteria", "domain"), ("Bacteria;Phy", "phylum")]
    (tmp_path / "ranks.tsv").write_text("Bacteria\t1\tdomain\t\t\nBacteria;\t2\tphylum\t\t\n")
    with pytest.raises(IntegrityError):
        text.rank_table(spark, str(tmp_path / "ranks.tsv"))
    got = {r.source_identifier: (r.taxonomy, r.marker, r.compartment, r.problem) for r in headers.pr2_records(text.fasta(spark, str(pr2)), "5").collect()}
    assert got["B1.1.4_U"] == ("Eukaryota;a;b", "18S", "plastid", None) and got["B3.1.4_U"][3] == "suffix_of_other_compartment"


def test_search_tables(spark, tmp_path):
    t = tmp_path / "a.tblout"
    t.write_text("# c\ncontig1 - model RFTEST cm 1 10 12 3 - no 1 0.50 0.0 42.0 1e-9 ! description with spaces\nshort line\n")
    rows = text.tblout(spark, str(t)).collect()
    good = next(r for r in rows if r.reason is None)
    assert (good.model_accession, good.start, good.end, good.included, good.bit_score) == ("RFTEST", 3, 12, True, 42.0)
    assert [r.reason for r in rows if r.reason] == ["field_count"]
    m = tmp_path / "a.m8"
    m.write_text("q\ts\t90\t100\t0\t0\t1\t100\t1\t100\t1e-9\t50\nq\ts\t95\t100\t0\t0\t1\t100\t1\t100\t1e-9\t50\nq\tz\t80\t10\t0\t0\t1\t10\t1\t10\t1\t5\n")
    assert sorted((r.subject, r.percent_identity) for r in text.blast_hits(spark, str(m)).collect()) == [("s", 95.0), ("z", 80.0)]
    c = tmp_path / "c.tsv"
    c.write_text("cluster_id\tcentroid\tsequences\nc1\tIMG_1\t['IMG_2', 'REF_x', 'IMG_1', 'IMG_2']\n")
    assert [r.members for r in text.clusters(spark, str(c)).collect()] == [["IMG_1", "IMG_2"]]
    with pytest.raises(IntegrityError):
        text.delimited(spark, str(c), "a string, b string", header=True)
    query = arrivals.write_batches(arrivals.arriving_hits(spark, str(tmp_path / "in")) if (tmp_path / "in").mkdir() is None else None, str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(60)
    (tmp_path / "in" / "x.m8").write_text(m.read_text())
    arrivals.write_batches(arrivals.arriving_hits(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


HITS = "query string, subject string, bit_score double, percent_identity double, alignment_length int"
TAXONOMY = "sequence_id string, taxonomy string, taxonomy_source string, domain string, compartment string, reference_source string, assignment_method string, cross_domain_conflict boolean, taxonomy_alternatives string, centroid_names string, centroid_taxonomy string, centroid_taxonomy_source string"


def known(spark, *rows):
    return annotate.taxonomy_records(spark.createDataFrame([(*r, *[""] * (12 - len(r))) for r in rows], TAXONOMY))


def test_annotation(spark):
    hits = spark.createDataFrame([("q1", "a", 100.0, 99.0, 10), ("q1", "b", 100.0, 98.0, 10), ("q1", "c", 90.0, 99.0, 10), ("q2", "a", 50.0, 90.0, 10), ("q2", "d", 50.0, 90.0, 10), ("q4", "v", 9.0, 97.125, 5)], HITS)
    taxonomy = known(
        spark, ("a", "Bacteria;P;C", "SILVA", "Bacteria", "plastid", "SILVA", "native", False, "", '["n1","n2"]', "Bacteria", "SILVA"), ("b", "Bacteria;P;D", "SILVA", "Bacteria", "", "IMG", "updated_reference_cluster", False),
        ("c", "Bacteria", "SILVA", "Bacteria", "", "SILVA", "native", False), ("d", "Archaea", "SILVA", "Archaea", "", "SILVA", "native", False), ("v", "", "SILVA+PR2", "ambiguous", "mixed", "PR2+SILVA", "cross_domain_ambiguous_exact_sequence", True, '[{"taxonomy":"B"}]'))
    records = spark.createDataFrame([("a", "SILVA", "1", "x"), ("a", "PR2", "2", "y"), ("c", "IMG", "3", "z"), ("b", "IMG", "3", "w"), ("d", "IMG", "3", "u"), ("v", "IMG", "3", "t")], "sequence_id string, reference_source string, source_version string, source_identifier string")
    labels = annotate.reference_labels(records)
    queries = spark.createDataFrame([(q, "s", "m", "600", "5-604", "+", "simple", "k|1", "false") for q in ("q1", "q2", "q3", "q4")], ", ".join(f"{c} string" for c in annotate.HIT_FIELDS))
    rows = {r.name: r for r in annotate.annotated(queries, hits, taxonomy, labels).collect()}
    assert (rows["q1"].subject, rows["q1"].domain, rows["q1"].taxonomy, rows["q1"].reference_source, rows["q1"].compartment, rows["q1"].assignment_method) == ("a", "Bacteria", "Bacteria;P", "mixed", "plastid", "mixed")
    assert (rows["q1"].centroid_names, rows["q1"].identifiers, rows["q1"].versions, rows["q1"].ties) == ("n1|n2", "PR2:y|SILVA:x", "PR2:2|SILVA:1", 2)
    assert (rows["q2"].domain, rows["q2"].taxonomy, rows["q2"].assignment_method) == ("ambiguous", "", "cross_domain_ambiguous_equal_best") and rows["q2"].taxonomy_alternatives.count("{") == 2
    assert (rows["q4"].domain, rows["q4"].assignment_method, rows["q4"].taxonomy_alternatives) == ("ambiguous", "cross_domain_ambiguous_exact_sequence", '[{"taxonomy":"B"}]')
    assert (rows["q3"].subject, rows["q3"].taxonomy, rows["q3"].ties) == ("", "", None)
    cut = {r.name: (r.taxonomy, r.truncated, r.compartment) for r in annotate.annotated(queries, hits, taxonomy, labels, 1).collect()}
    assert cut["q1"] == ("Bacteria", True, "") and cut["q3"] == ("", None, "")
    report = annotate.summary(annotate.annotated(queries, hits, taxonomy, labels), spark.createDataFrame([("q1", "ACGT")], "id string, sequence string"))
    assert report.columns == annotate.SUMMARY_FIELDS
    text = {r.name: r for r in report.collect()}
    assert (text["q4"].blast_pident, text["q4"].blast_bitscore, text["q4"].blast_tied_subjects, text["q4"].blast_ties_truncated, text["q1"].query_sequence, text["q1"].coordinates) == ("97.12", "9", "1", "false", "ACGT", "5-604")
    assert (text["q3"].blast_sseqid, text["q3"].blast_pident, text["q3"].blast_tied_subjects, text["q3"].blast_ties_truncated, text["q3"].taxonomy_mode) == ("", "", "", "", "blast")
    with pytest.raises(Exception, match="missing taxonomy of d"):
        annotate.annotated(queries, hits, taxonomy.where("sequence_id <> 'd'"), labels).collect()
    wrong = annotate.annotation_violations(hits, taxonomy.where("sequence_id <> 'c'"), records.where("sequence_id <> 'd'"))
    assert {k: [r.sequence_id for r in df.collect()] for k, df in wrong.items()} == {"duplicate preferred taxonomy row": [], "missing taxonomy of a subject": ["c"], "missing source record of a subject": ["d"]}
    with pytest.raises(Exception, match="centroid_names"):
        known(spark, ("a", "B", "S", "B", "", "S", "native", False, "", "n1")).collect()
    with pytest.raises(Exception, match="invalid source label"):
        annotate.reference_labels(records.withColumn("source_identifier", F.lit("a|b"))).collect()


def test_top_hits(spark):
    """All equally best hits are kept, whatever n, and the first of each source however deep it lies."""
    hits = spark.createDataFrame([("q", f"s{i}", s, 90.0, 10) for i, s in enumerate([9.0, 9.0, 9.0, 9.0, 8.0, 7.0, 6.0, 1.0])], HITS)
    records = spark.createDataFrame([(f"s{i}", src, "1", f"i{i}") for i, src in enumerate(["SILVA"] * 6 + ["PR2", "IMG"])] + [("s7", "PR2", "1", "second")], "sequence_id string, reference_source string, source_version string, source_identifier string")
    taxonomy = known(spark, *[(f"s{i}", "", "SILVA", "Bacteria" if i else "", "", "SILVA", "native", False) for i in range(7)])
    top = annotate.top_hits(hits, taxonomy, annotate.reference_labels(records), 1)
    got = {r.subject: (r.rank, r.reasons, r.taxonomy) for r in top.collect()}
    assert got == {
        "s0": (1, "overall_top_n|equal_best_assignment|best_SILVA", "Unclassified"), "s1": (2, "equal_best_assignment", "Bacteria"), "s2": (3, "equal_best_assignment", "Bacteria"),
        "s3": (4, "equal_best_assignment", "Bacteria"), "s6": (7, "best_PR2", "Bacteria"), "s7": (8, "best_IMG", "")}
    whole = top.withColumn("mismatches", F.lit(1)).withColumn("gap_opens", F.lit(0)).withColumn("query_start", F.lit(1)).withColumn("query_end", F.lit(9)).withColumn("subject_start", F.lit(1)).withColumn("subject_end", F.lit(9)).withColumn("e_value", F.lit(1e-9))
    queries = spark.createDataFrame([("q", "s", "m", "600")], "name string, sample string, model string, length string")
    report = annotate.top_hit_report(whole, queries)
    assert report.columns == annotate.TOP_HIT_FIELDS
    assert [(r.hit_rank, r.blast_evalue, r.query_length, r.reference_identifiers) for r in annotate.ordered_top_hits(report).collect()][-1] == ("8", "1e-09", "600", "IMG:i7|PR2:second")


def test_extraction(spark):
    schema = "sample string, model string, subject string, model_from int, model_to int, model_length int, sequence_from int, sequence_to int, strand string"
    hits = spark.createDataFrame([("s", "m", "c1", 1, 10, 10, 2, 5, "+"), ("s", "m", "c2", 1, 10, 10, 6, 3, "-")], schema)
    contigs = spark.createDataFrame([("s", "c1", "AACCGGTT"), ("s", "c2", "AACXGRTT"), ("s", "c3", "A")], "sample string, id string, sequence string")
    got = {r.subject: (r.sequence, r["name"]) for r in annotate.extracted(hits, contigs, 4).collect()}
    assert got == {"c1": ("ACCG", "c1|2-5|strand_+|simple"), "c2": ("YCXG", "c2|3-6|strand_-|simple")}  # letters that code nothing stay as they are
    assert annotate.extracted(hits, contigs, 5).count() == 0
    assert annotate.hit_table(annotate.extracted(hits, contigs, 4)).columns == annotate.HIT_FIELDS
    with pytest.raises(Exception, match="subject missing from FASTA: c2"):
        annotate.extracted(hits, contigs.where("id <> 'c2'"), 4).collect()
    with pytest.raises(Exception, match="invalid interval c1:2-5"):
        annotate.extracted(hits, contigs.withColumn("sequence", F.substring("sequence", 1, 4)), 4).collect()
    wrong = annotate.extraction_violations(hits, contigs.where("id <> 'c2'").union(contigs.where("id = 'c1'")).withColumn("sequence", F.substring("sequence", 1, 4)))
    assert {k: df.count() for k, df in wrong.items()} == {"subject missing from FASTA": 1, "duplicate FASTA identifier": 1, "interval outside its sequence": 2}
    models = spark.createDataFrame([("SSU_rRNA_bacteria", "RF00177"), ("SSU_rRNA_eukarya", "RF01960"), ("other", None)], "model string, model_accession string")
    assert annotate.model_hits(models, "SSU_rRNA_bacteria", "RF00177").count() == 1
    with pytest.raises(Exception, match="hit disagrees"):
        annotate.model_hits(models, "SSU_rRNA_bacteria", "RF01960").collect()


def test_categories(spark, tmp_path):
    schema = "sample string, contig_name string, blast_sseqid string, taxonomy string, taxonomy_domain string, compartment string"
    rows = [("a", "k1", "x", "Bacteria;Cyanobacteria;Chloroplast", "Bacteria", ""), ("a", "k1", "x", "Eukaryota", "Eukaryota", ""), ("a", "k2", "s-Archaea|x", "", "", "apicoplast"), ("a", "k2", "x", "Bacteria;x_Mitochondria", "", None),
            ("a", "k3", "", "Bacteria", "Bacteria", ""), ("b", "k4", None, "Bacteria", "Bacteria", ""), ("a", None, "x", "Bacteria", "", "")]
    samples = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "sample string")
    matrix = annotate.sample_categories(spark.createDataFrame(rows, schema), samples)
    got = {r["sample"]: {c: r[c] for c in matrix.columns if c != "sample" and r[c]} for r in matrix.collect()}
    assert got == {"a": {"BacteriaSSU": 2, "CyanobacteriaSSU": 1, "PlastidSSU": 2, "EukaryotaSSU": 1, "ArchaeaSSU": 1, "MitochondriaSSU": 1}, "b": {}, "c": {}}
    files.category_table(matrix, str(tmp_path / "c.tsv"))
    assert (tmp_path / "c.tsv").read_text() == "\tBacteriaSSU\tMitochondriaSSU\tPlastidSSU\tCyanobacteriaSSU\tArchaeaSSU\tEukaryotaSSU\na\t2\t1\t2\t1\t1\t1\nb\t0\t0\t0\t0\t0\t0\nc\t0\t0\t0\t0\t0\t0\n"
    files.category_table(annotate.sample_categories(spark.createDataFrame([], schema), samples), str(tmp_path / "none.tsv"))
    assert (tmp_path / "none.tsv").read_text() == "\na\nb\nc\n"


def test_tree_assignments(spark):
    rows = spark.createDataFrame([("s", "m", f"q{i}", "blast", "B;P", "S", "B", "", "native", "[]", *[""] * len(annotate.TREE_FIELDS)) for i in (1, 2)],
                                 ", ".join(f"{c} string" for c in ("sample", "model", "name", "taxonomy_mode", "taxonomy", "taxonomy_source", "taxonomy_domain", "compartment", "taxonomy_assignment_method", "taxonomy_alternatives", *annotate.TREE_FIELDS)))
    values = {"q1": {"tree_taxonomy": "B;T", "tree_taxonomy_source": "PR2", "tree_taxonomy_domain": "B", "tree_compartment": "plastid", "tree_assignment_method": "tree_nearest_named_lca"}, "q2": {"tree_assignment_method": "tree_skipped_insufficient_references"}}
    new = spark.createDataFrame([("s", "m", q, *[v.get(c, "-") for c in annotate.TREE_FIELDS]) for q, v in values.items()], ", ".join(f"{c} string" for c in ("sample", "model", "name", *annotate.TREE_FIELDS)))
    got = {r.name: r for r in annotate.with_trees(rows, new).collect()}
    assert (got["q1"].taxonomy_mode, got["q1"].taxonomy, got["q1"].compartment, got["q1"].taxonomy_assignment_method, got["q1"].taxonomy_alternatives) == ("tree", "B;T", "plastid", "tree_nearest_named_lca", "")
    assert (got["q2"].taxonomy_mode, got["q2"].taxonomy, got["q2"].taxonomy_alternatives, got["q2"].tree_assignment_method) == ("blast", "B;P", "[]", "tree_skipped_insufficient_references")
    wrong = annotate.tree_mismatches(rows, new.where("name = 'q1'").union(new.where("name = 'q1'")).withColumn("model", F.lit("m")).union(new.withColumn("name", F.lit("z")).limit(1)))
    assert {k: [r.name for r in df.collect()] for k, df in wrong.items()} == {"missing tree assignment": ["q2"], "extra tree assignment": ["z"], "duplicate tree assignment": ["q1"]}
    with pytest.raises(Exception, match="no tree assignment of q2"):
        annotate.with_trees(rows, new.where("name = 'q1'")).collect()


PREPARED = "reference_source string, source_version string, source_identifier string, original_header string, marker string, taxon_oid string, sequence string, taxonomy string, compartment string, assignment_method string"


def test_release(spark, tmp_path):
    prepared = spark.createDataFrame([
        ("SILVA", "1", "a", "h", "16S", None, "ACGT", "Bacteria;P", "", "native"), ("PR2", "5", "b", "h", "18S", None, "ACGT", "Eukaryota", "plastid", "native"), ("IMG", "9", "c", "h", "16S", "33", "GGGG", None, "", ""),
        ("IMG", "9", "c", "other header", "16S", "33", "GGGG", None, "", "")], PREPARED)
    seqs, records = release.sequences(prepared), release.source_records(prepared)
    assert sorted(r.markers for r in seqs.collect()) == ["16S", "16S;18S"]
    ids = {(r.source_identifier, r.original_header): (r.source_record_id, r.sequence_id) for r in records.collect()}
    assert len(ids) == 4 and ids["a", "h"][0] == "SRC_" + hashlib.sha256("\0".join(["SILVA", "1", "a", "h", "16S"]).encode()).hexdigest()
    own = release.assignments(prepared)
    first = own.where("taxonomy_source = 'SILVA'").first()
    assert first.taxonomy_assignment_id == "TAX_" + hashlib.sha256("\0".join([ids["a", "h"][0], "Bacteria;P", "SILVA", "", "native", ""]).encode()).hexdigest() and own.count() == 2
    derived = spark.createDataFrame([("c", "Bacteria;Q", "SILVA", "", "updated_reference_cluster", "IMGEV_1", "n", "Bacteria;Q;R", "SILVA")],
                                    "source_identifier string, taxonomy string, taxonomy_source string, compartment string, assignment_method string, evidence string, centroid_name string, centroid_taxonomy string, centroid_taxonomy_source string")
    require(release.derived_violations(derived, records))
    broken = derived.union(derived.withColumn("source_identifier", F.lit("z"))).union(derived.withColumn("centroid_taxonomy", F.lit("Archaea"))).union(derived.withColumn("evidence", F.lit(" "))).union(
        derived.withColumn("taxonomy", F.lit(";"))).union(derived.withColumn("centroid_name", F.lit("a|b"))).union(derived.withColumn("centroid_name", F.lit(None))).union(
        derived.withColumn("assignment_method", F.lit("updated_reference_unclassified")).withColumn("centroid_name", F.lit("")))
    counts = {k: df.count() for k, df in release.derived_violations(broken, records).items()}
    assert counts == {"unknown source identifier": 1, "no source, method or evidence": 1, "no taxonomy": 1, "invalid centroid name": 1, "no centroid evidence": 1, "taxonomy beside its centroid's": 2, "no centroid name": 1}
    held = own.unionByName(release.derived_assignments(derived, records))
    assert held.count() == 4  # both records of the identifier
    preferred = release.preferred_taxonomy(held)
    got = {r.sequence_id: r for r in preferred.collect()}
    both, img = got[ids["a", "h"][1]], got[ids["c", "h"][1]]
    assert (both.domain, both.taxonomy, both.compartment, both.cross_domain_conflict, both.taxonomy_source, both.reference_source) == ("ambiguous", "", "mixed", True, "PR2+SILVA", "PR2+SILVA")
    assert both.taxonomy_alternatives == json.dumps([{"assignment_method": "native", "compartment": c, "domain": d, "taxonomy": t, "taxonomy_source": s} for s, t, d, c in (("PR2", "Eukaryota", "Eukaryota", "plastid"), ("SILVA", "Bacteria;P", "Bacteria", ""))], separators=(",", ":"))
    assert (img.reference_source, img.assignment_method, img.taxonomy, img.domain, img.centroid_names, img.centroid_taxonomy, img.centroid_taxonomy_source) == ("IMG", "updated_reference_cluster", "Bacteria;Q", "Bacteria", '["n"]', "Bacteria;Q;R", "SILVA")
    places = release.locations(spark.createDataFrame([("33", "1.5", "2"), ("33", "1.50", "2.0"), ("34", "91", "2"), ("35", "NA", " ")], "taxon_oid string, latitude string, longitude string"))
    assert sorted(tuple(r) for r in places.collect()) == [("33", 1.5, 2.0), ("34", None, None), ("35", None, None)]
    with_sequence = seqs.join(prepared.select(S.content_id(F.col("sequence")).alias("sequence_id"), "sequence").distinct(), "sequence_id")
    require(release.release_violations(with_sequence, records, held, preferred, places))
    files.parquet(seqs, str(tmp_path / "r" / "sequences"), ["sequence_id"], single=True)
    files.tsv(preferred, str(tmp_path / "r" / "preferred"), ["sequence_id"])
    files.json_lines(preferred, str(tmp_path / "r" / "json"), ["sequence_id"])
    files.fasta(prepared.select(S.content_id(F.col("sequence")).alias("id"), "sequence").distinct(), str(tmp_path / "r" / "fasta"), "id", "sequence", 2)
    files.write_manifest(str(tmp_path / "r"))
    assert files.check_manifest(str(tmp_path / "r")) == []
    assert spark.read.parquet(str(tmp_path / "r" / "sequences")).count() == 2
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r" / "fasta")).collect() if r.value[0] != ">") == ["AC", "GG", "GG", "GT"]
    assert sorted(tuple(r) for r in release.provenance_counts(records).collect()) == [("IMG", "9", "", 2), ("IMG", "9", "16S", 2), ("PR2", "5", "", 1), ("PR2", "5", "18S", 1), ("SILVA", "1", "", 1), ("SILVA", "1", "16S", 1)]


def test_every_release_rule_finds_its_violation(spark):
    a, b = "SSU_" + "a" * 43, "SSU_" + "b" * 43
    seqs = spark.createDataFrame([(a, "16S", "ACGT"), (a, "16S", "ACGT"), (b, "", "GG")], "sequence_id string, markers string, sequence string")
    records = spark.createDataFrame([("r1", a, "SILVA", "18S"), ("r1", a, "SILVA", "18S"), ("r2", "gone", "IMG", "16S"), ("r3", b, "SILVA", "16S")], "source_record_id string, sequence_id string, reference_source string, marker string")
    row = {c: "" for c in release.ASSIGNMENT}
    base = row | {"source_record_id": "r3", "sequence_id": b, "taxonomy": "Bacteria", "taxonomy_source": "SILVA", "domain": "Bacteria", "assignment_method": "native"}
    changed = [
        {}, {}, {"source_record_id": "none"}, {"sequence_id": "gone"}, {"source_record_id": "r1"}, {"taxonomy_source": "PR2", "taxonomy": "Eukaryota:plas"}, {"centroid_name": "a\tb"},
        {"centroid_name": "n", "assignment_method": "updated_reference_cluster", "centroid_taxonomy": "Archaea", "centroid_taxonomy_source": "SILVA"}, {"assignment_method": "updated_reference_unclassified"}]
    held = spark.createDataFrame([tuple((base | c | {"taxonomy_assignment_id": f"t{max(i, 1)}"})[k] for k in release.ASSIGNMENT) for i, c in enumerate(changed)], ", ".join(f"{c} string" for c in release.ASSIGNMENT))
    columns = "sequence_id string, taxonomy string, taxonomy_source string, domain string, compartment string, assignment_method string, cross_domain_conflict boolean, taxonomy_alternatives string, centroid_names string, centroid_taxonomy string, centroid_taxonomy_source string"
    good = ("Bacteria;P", "SILVA", "Bacteria", "", "native", False, "", "", "", "")
    swap = lambda **k: tuple(k.get(n.split()[0], v) for n, v in zip(columns.split(", ")[1:], good, strict=True))
    preferred = spark.createDataFrame([
        (a, *good), (a, *good), ("extra1", *swap(compartment="attic")), ("extra2", *swap(domain="Archaea")), ("extra3", *swap(taxonomy="Bacteria;P:plas", taxonomy_source="PR2+SILVA")), ("extra4", *swap(cross_domain_conflict=True)),
        ("extra5", *swap(centroid_names='["b","a"]')), ("extra6", *swap(centroid_names='["a"]', centroid_taxonomy="Archaea", centroid_taxonomy_source="SILVA")), ("extra7", *swap(centroid_taxonomy="Bacteria"))], columns)
    places = spark.createDataFrame([("1", 1.0, 2.0), ("1", 1.0, 2.0), ("2", 91.0, 0.0)], "taxon_oid string, latitude double, longitude double")
    counts = {k: df.count() for k, df in release.release_violations(seqs, records, held, preferred, places).items()}
    assert counts == {
        "sequence twice": 1, "record twice": 1, "assignment twice": 1, "preferred twice": 1, "record without sequence": 1, "assignment without record": 1, "assignment without sequence": 1, "assignment of another sequence": 3,
        "sequence without marker": 1, "markers differ": 3, "suffix of a compartment in an assignment": 1, "invalid centroid name": 1, "invalid centroid evidence": 1, "no centroid name": 1, "IMG record without taxonomy": 1,
        "sequence without preferred row": 1, "preferred row without sequence": 7, "invalid compartment": 1, "domain beside the taxonomy": 1, "suffix of a compartment in a preferred row": 1, "unsettled conflict": 1, "invalid centroid names": 1,
        "invalid centroid taxonomy": 1, "centroid taxonomy without names": 1, "id of another sequence": 3, "location twice": 1, "location out of range": 1}
    with pytest.raises(IntegrityError):
        require(release.release_violations(seqs, records, held, preferred))


def test_priority_and_locations(spark):
    rows = [("native", "pr2", "Bacteria", "Plastid", 0), ("NATIVE", "SILVA", "Archaea", "", 0), ("native", "SILVA", "Eukaryota", "", 20), ("native", "PR2", "Eukaryota", None, 0), ("Updated_Reference_Cluster", "SILVA", "Bacteria", "", 10), (None, None, None, None, 20), ("native", "PR2", "Bacteria", "", 20)]
    df = spark.createDataFrame(rows, "assignment_method string, taxonomy_source string, domain string, compartment string, expected int")
    assert df.where(release.priority() != F.col("expected")).count() == 0
    with pytest.raises(Exception, match="no common taxonomy domain for s"):
        release.preferred_taxonomy(spark.createDataFrame([("s", "r", "", "SILVA", "", "", "native", "", "", "")], "sequence_id string, source_record_id string, taxonomy string, taxonomy_source string, domain string, compartment string, assignment_method string, centroid_name string, centroid_taxonomy string, centroid_taxonomy_source string")).collect()
    raw = spark.createDataFrame([("x1", "1", "2"), ("7", "1", "2"), ("7", "1", "3"), ("8", "1", "181"), ("9", "abc", "1"), ("10", "n/a", "1")], "taxon_oid string, latitude string, longitude string")
    assert {k: df.count() for k, df in release.location_violations(raw).items()} == {"taxon_oid is not digits": 1, "conflicting locations": 1}
    assert sorted(r.taxon_oid for r in release.location_corrections(raw).collect()) == ["8", "9"]
    assert [tuple(r) for r in release.locations(raw).where("taxon_oid = '10'").collect()] == [("10", None, 1.0)]
    with pytest.raises(IntegrityError, match="persons"):
        release.locations(raw.withColumn("contact_email", F.lit("")))
    with pytest.raises(IntegrityError, match="beside"):
        release.locations(raw.withColumn("depth", F.lit("")))


SEARCH = "query string, subject string, bits string, identity string, alignment_length int, query_length int, subject_length int, coverage string"


def search(spark, *rows):
    return spark.createDataFrame([(*r, *("100", 10, 10, 10, "90")[len(r) - 3:]) for r in rows], SEARCH).select(
        "query", "subject", F.col("bits").cast("decimal(18,6)").alias("bit_score"), F.col("identity").cast("decimal(18,6)").alias("percent_identity"), "alignment_length", "query_length", "subject_length", F.col("coverage").cast("decimal(18,6)").alias("query_coverage"))


REFERENCE = "sequence_id string, taxonomy string, domain string, taxonomy_source string, cross_domain_conflict boolean, compartment string, taxonomy_alternatives string"


def references(spark, *rows):
    return spark.createDataFrame([(*r, *("SILVA", False, "", "")[len(r) - 3:]) for r in rows], REFERENCE)


def test_leave_one_out_and_calibration(spark):
    hits = search(spark, ("q", "q", "100"), ("q", "a", "99"), ("q", "b", "98"), ("q", "c", "99", "100", 10, 10, 10, "50"))
    taxonomy = references(spark, ("a", "B;P;C", "B"), ("b", "B;P;D", "B"), ("c", "A", "A"), ("x", "", "ambiguous", "SILVA", True))
    predicted = calibrate.leave_one_out(hits, taxonomy)
    assert [(r.query, r.predicted) for r in predicted.collect()] == [("q", ["B", "P"])]
    assert calibrate.leave_one_out(hits, taxonomy, 1).collect()[0].predicted == ["B"]
    conflict = hits.union(search(spark, ("q", "x", "99")))
    assert [r.predicted for r in calibrate.leave_one_out(conflict, taxonomy).collect()] == [[]]
    with pytest.raises(Exception, match="taxonomy is missing for y"):
        calibrate.leave_one_out(hits.union(search(spark, ("q", "y", "99"))), taxonomy).collect()
    truth = spark.createDataFrame([("q", "16S", "SILVA", "B", "B;P;C"), ("none", "16S", "SILVA", "B", "B"), ("deep", "18S", "PR2", "E", "E;1;2;3;4;5;6;7;8")], "query string, marker string, taxonomy_source string, domain string, taxonomy string")
    deep = predicted.union(spark.createDataFrame([("deep", ["E", "1", "2", "3", "4", "5", "6", "7", "8"])], "query string, predicted array<string>"))
    figures = {(r.taxonomy_source, r["rank"]): (r.sampled, r.truth_available, r.called, r.correct, r.required) for r in calibrate.calibration(deep, truth).collect()}
    # what the truth lacks is neither available nor called; the genus needs more, the species of PR2 is not there
    assert figures["SILVA", "domain"] == (2, 2, 1, 1, 0.95) and figures["SILVA", "phylum"] == (2, 1, 1, 1, 0.95) and figures["SILVA", "class"] == (2, 1, 0, 0, 0.95) and figures["SILVA", "order"] == (2, 0, 0, 0, 0.95)
    assert figures["SILVA", "genus"][4] == 0.98 and figures["PR2", "genus"] == (1, 1, 1, 1, 0.98) and ("PR2", "species") not in figures and len(figures) == 14
    longer = calibrate.calibration(spark.createDataFrame([("none", ["B", "P"])], "query string, predicted array<string>"), truth.where("query = 'none'")).where("rank = 'phylum'").first()
    assert (longer.truth_available, longer.called, longer.correct) == (0, 0, 0)
    assert calibrate.search_violations(hits, truth.where("query = 'none'"))["missing query"].count() == 1


def test_strata_and_their_file(spark):
    rows = [("16S", "SILVA", "B", i, 200 if d else 50, d, ok) for i, (d, ok) in enumerate([(0.99, True), (0.97, True), (0.9, False), (0.99, True)])]
    rows += [("18S", "PR2", "E", 0, 50, 0.5, False), ("18S", "PR2", "F", 0, 50, 0.99, False), ("18S", "PR2", "G", 0, 500, 0.5, False)]
    got = {r.domain: (r.status, r.rank_cap, r.reason) for r in calibrate.strata(spark.createDataFrame(rows, "marker string, taxonomy_source string, domain string, rank_index int, called long, lower_bound double, accepted boolean")).collect()}
    assert got == {"B": ("calibrated", 1, ""), "E": ("failed", None, "insufficient_domain_calls_and_precision_below_threshold"), "F": ("failed", None, "insufficient_domain_calls"), "G": ("failed", None, "domain_precision_below_threshold")}
    good = {"schema_version": 2, "rank_caps": {"16S|SILVA|B": 1}, "strata": {"16S|SILVA|B": {"status": "calibrated", "rank_cap": 1, "reason": ""}, "18S|PR2|E": {"status": "failed", "rank_cap": None, "reason": "x"}}}
    assert {tuple(r) for r in calibrate.read_calibration(spark, json.dumps(good)).collect()} == {("16S", "SILVA", "B", "calibrated", 1, ""), ("18S", "PR2", "E", "failed", None, "x")}
    for path, value in ((("schema_version",), 1), (("rank_caps",), {}), (("rank_caps", "16S|SILVA|B"), 2), (("strata", "16S|SILVA|B", "rank_cap"), -1), (("strata", "18S|PR2|E", "reason"), ""), (("strata", "18S|PR2|E", "status"), "maybe"), (("strata",), {})):
        bad = json.loads(json.dumps(good))
        at = bad
        for key in path[:-1]:
            at = at[key]
        at[path[-1]] = value
        with pytest.raises(IntegrityError):
            calibrate.read_calibration(spark, json.dumps(bad))


def clusters(spark, *rows):
    return spark.createDataFrame(list(rows), "cluster_id string, centroid string, members array<string>")


def strata(spark, *rows):
    return spark.createDataFrame([("16S", *r) for r in rows], "marker string, taxonomy_source string, domain string, status string, rank_cap int, reason string")


def test_classified_clusters(spark):
    taxonomy = references(spark, ("a", "B;P;C", "B"), ("b", "B;P;D", "B", "PR2"), ("other", "A;P", "A"), ("vague", "", "ambiguous", "SILVA", True), ("e", "E;x", "E"))
    caps = strata(spark, ("SILVA", "B", "calibrated", 1, ""), ("PR2", "B", "calibrated", 0, ""), ("SILVA", "A", "calibrated", 1, ""), ("SILVA", "E", "failed", None, "x"))
    hits = search(spark, ("k1", "a", "100"), ("q2", "a", "100"), ("q2", "b", "99"), ("q3", "a", "100"), ("q3", "other", "99"), ("q4", "vague", "100"), ("q5", "nobody", "100"), ("q6", "e", "100"), ("q7", "a", "100", "100", 10, 10, 10, "79"))
    groups = clusters(spark, ("k1", "q1", ["IMG_1", "IMG_2"]), *[(f"k{i}", f"q{i}", [f"IMG_{i}0"]) for i in range(2, 9)], ("k9", "q2x", []))
    rows = {r.cluster_id: r for r in calibrate.classified_clusters(groups, hits, taxonomy, caps, "16S").collect()}
    assert {k: (r.reason, r.taxonomy) for k, r in rows.items()} == {
        "k1": ("", "B;P"), "k2": ("", "B"), "k3": ("no_common_domain", ""), "k4": ("ambiguous_reference_taxonomy", ""), "k5": ("missing_reference_taxonomy", ""), "k6": ("calibration_stratum_failed", ""),
        "k7": ("no_hits_at_minimum_query_coverage", ""), "k8": ("no_hits", ""), "k9": ("no_img_members", "")}
    assert (rows["k2"].taxonomy_source, rows["k2"].candidates, rows["k7"].covered_too_little, rows["k1"].best_bit_score, rows["k1"].threshold, rows["k1"].rank_cap) == ("PR2+SILVA", 2, 1, "100", "98", 1)
    with pytest.raises(Exception, match="calibration lacks stratum 16S.SILVA.E"):
        calibrate.classified_clusters(groups, hits, taxonomy, caps.where("domain <> 'E'"), "16S").collect()
    cut = calibrate.classified_clusters(groups, hits, taxonomy, None, propagation_cap=0).where("cluster_id = 'k1'").first()
    assert (cut.taxonomy, cut.centroid_taxonomy) == ("B", "B;P;C")
    outcomes = calibrate.with_evidence(calibrate.classified_clusters(groups, hits, taxonomy, caps, "16S"))
    members = {r.source_identifier: r for r in calibrate.member_assignments(outcomes).collect()}
    assert len(members) == 9 and (members["IMG_2"].taxonomy, members["IMG_2"].centroid_taxonomy, members["IMG_2"].centroid_name) == ("B;P", "B;P", "q1") and members["IMG_1"].evidence_id in members["IMG_1"].evidence
    assert (members["IMG_30"].taxonomy, members["IMG_30"].taxonomy_source, members["IMG_30"].assignment_method) == ("Unclassified", "SILVA+PR2", "updated_reference_unclassified") and members["IMG_30"].evidence.endswith("reason=no_common_domain")
    catalog = calibrate.evidence_catalog(outcomes)
    assert catalog.count() == 9 and not any("IMG_1" in r.decision or "q1" in r.decision for r in catalog.collect())
    details = calibrate.candidate_evidence(groups, hits, taxonomy)
    assert {r.cluster_id: (len(r.evidence), r.missing_subjects, r.ambiguous_subjects) for r in details.collect()} == {
        "k1": (1, [], []), "k2": (2, [], []), "k3": (2, [], []), "k4": (1, [], ["vague"]), "k5": (1, ["nobody"], []), "k6": (1, [], [])}
    shown = {r.cluster_id: json.loads(r.decision) for r in calibrate.with_evidence(calibrate.classified_clusters(groups, hits, taxonomy, caps, "16S"), "16S", details).collect()}
    assert [c["subject"] for c in shown["k2"]["candidates"]] == ["a", "b"] and shown["k2"]["candidates"][0]["bit_score"] == "100" and shown["k2"]["marker"] == "16S" and shown["k5"]["missing_taxonomy_subjects"] == ["nobody"]
    assert list(shown["k1"]) == sorted(shown["k1"]) and "candidates" not in shown["k8"] and not {"cluster_id", "centroid", "members"} & set(shown["k1"])
    with pytest.raises(Exception, match="name of an IMG record"):
        calibrate.with_evidence(calibrate.classified_clusters(groups, hits, taxonomy, caps, "16S").withColumn("reason", F.lit("IMG_7"))).collect()
    counters = {r.counter: r.value for r in calibrate.quality(outcomes).collect()}
    assert (counters["clusters_total"], counters["clusters_classified"], counters["assignments_written"], counters["unclassified_by_reason:no_hits"], counters["classified_by_domain:B"], counters["hits_total"]) == (9, 2, 9, 1, 2, 9)
    wrong = calibrate.alias_violations(clusters(spark, ("k1", "q1", []), ("q1", "q3", []), ("k4", "q4", [])), search(spark, ("k4", "a", "1"), ("q4", "a", "1"), ("zz", "a", "1")))
    assert {k: df.count() for k, df in wrong.items()} == {"ambiguous alias": 1, "query of no cluster": 1, "hits under both names": 1}


def test_species_are_guarded(spark):
    nine, other = "Eukaryota;a;b;c;d;e;f;g;h", "Eukaryota;a;b;c;d;e;f;g;i"
    taxonomy = references(spark, ("x", nine, "Eukaryota", "PR2"), ("x2", nine, "Eukaryota", "PR2"), ("y", other, "Eukaryota", "PR2"), ("s", nine, "Eukaryota", "SILVA"))
    exact = ("100", "100", 10, 10, 10, "100")
    hits = search(spark, ("exact", "x", *exact), ("exact", "x2", *exact), ("two", "x", *exact), ("two", "y", *exact), ("near", "x", "100", "99"), ("short", "x", "100", "100", 9, 10, 10, "100"), ("silva", "s", *exact))
    groups = clusters(spark, *[(k, k + "_", ["IMG_1"]) for k in ("exact", "two", "near", "short", "silva")])
    caps = strata(spark, ("PR2", "Eukaryota", "calibrated", 6, ""), ("SILVA", "Eukaryota", "calibrated", 4, ""))
    got = {r.cluster_id: (len(r.taxonomy.split(";")), r.species_called, r.species_guarded) for r in calibrate.classified_clusters(groups, hits, taxonomy, caps, "16S").collect()}
    assert got == {"exact": (9, True, False), "two": (7, False, False), "near": (7, False, True), "short": (7, False, True), "silva": (5, False, False)}
    free = {r.cluster_id: len(r.taxonomy.split(";")) for r in calibrate.classified_clusters(groups, hits, taxonomy).collect()}
    assert free == {"exact": 9, "two": 8, "near": 8, "short": 8, "silva": 9}


def test_hits_beyond_the_targets_are_candidates(spark):
    taxonomy = references(spark, ("a", "B;P;C", "B"), ("b", "B;P;D", "B"), ("other", "A;P", "A"), ("vague", "", "ambiguous", "SILVA", True))
    caps = strata(spark, ("SILVA", "B", "calibrated", 1, ""))
    for last, reason in (("b", ""), ("other", "no_common_domain"), ("vague", "ambiguous_reference_taxonomy"), ("unknown", "missing_reference_taxonomy")):
        subjects = ["a", "b", last] if last != "b" else ["a", "b"]
        rows = search(spark, *[("q", s, "100", str(100 - i)) for i, s in enumerate(subjects)])
        out = calibrate.classified_clusters(clusters(spark, ("k", "q", ["IMG_1"])), rows, taxonomy, caps, "16S", len(subjects) - 1).collect()
        assert [(r.reason, r.taxonomy, r.truncated) for r in out] == [(reason, "" if reason else "B", True)]
        assert calibrate.candidates(rows, len(subjects) - 1).count() == len(subjects)
    rows = search(spark, *[("q", s, "100", str(100 - i)) for i, s in enumerate(["a", "b", "other"])])
    assert [r.predicted for r in calibrate.leave_one_out(rows, taxonomy, 2).collect()] == [[]]


def test_remapped_evidence(spark):
    rows = spark.createDataFrame([("m1", "e1", "B", "x evidence_id=e1 y"), ("m2", "e2", "A", "evidence_id=e2")], "source_identifier string, evidence_id string, taxonomy string, evidence string")
    mapping = spark.createDataFrame([("e1", "n1", "B"), ("e2", "n2", "A")], "evidence_id string, new_id string, taxonomy string")
    assert {r.source_identifier: (r.evidence_id, r.evidence) for r in calibrate.remapped_evidence(rows, mapping).collect()} == {"m1": ("n1", "x evidence_id=n1 y"), "m2": ("n2", "evidence_id=n2")}
    for broken, message in ((mapping.where("evidence_id = 'e1'"), "does not resolve"), (mapping.withColumn("taxonomy", F.lit("B")), "taxonomy does not match")):
        with pytest.raises(Exception, match=message):
            calibrate.remapped_evidence(rows, broken).collect()
    with pytest.raises(Exception, match="text without"):
        calibrate.remapped_evidence(rows.withColumn("evidence", F.lit("e1")), mapping).collect()


def test_reference_rules(spark):
    rows = references(spark, ("a", "B;P", "B"), ("a", "B", "B"), ("b", "B", ""), ("c", "", "B", "SILVA", True, "", "[]"), ("d", "A", "B"), ("e", "", "ambiguous", "SILVA", True, "", '[{"taxonomy":"B"}]'))
    assert {k: [r.sequence_id for r in df.collect()] for k, df in calibrate.reference_violations(rows).items()} == {
        "duplicate reference taxonomy row": ["a"], "row without source or domain": ["b"], "conflict without alternatives": ["c"], "taxonomy without its domain": ["b", "d"]}


def test_tree_tasks_and_markers(spark):
    hits = spark.createDataFrame([("q", f"s{i}", "16S", float(i), 1.0, 1) for i in range(5)] + [("q", "z", "18S", 99.0, 1.0, 1), ("p", "s1", "16S", 1.0, 1.0, 1)],
                                 "query string, subject string, marker string, bit_score double, percent_identity double, alignment_length int")
    markers = spark.createDataFrame([("q", "16S"), ("p", "16S"), ("none", "18S")], "query string, marker string")
    tasks, skipped = annotate.tree_tasks(hits, markers, 4)
    assert [(r.leaf, r.subject) for r in tasks.orderBy("rank").collect()] == [("REF0001", "s4"), ("REF0002", "s3"), ("REF0003", "s2"), ("REF0004", "s1")]
    assert {r.query: r.n for r in skipped.collect()} == {"p": 1, "none": 0}
    more = hits.union(spark.createDataFrame([("tie", "u", "16S", 5.0, 1.0, 1), ("tie", "w", "18S", 7.0, 1.0, 1), ("even", "u", "16S", 5.0, 1.0, 1), ("even", "w", "18S", 5.0, 1.0, 1), ("same", "u", "16S", 5.0, 1.0, 1), ("same", "u", "18S", 5.0, 1.0, 1)], hits.schema))
    queries = spark.createDataFrame([(q, "18S") for q in ("q", "p", "tie", "even", "same", "none")], "query string, detected string")
    got = {r["query"]: (r.marker, r.decision, r.votes_16S, r.votes_18S) for r in annotate.choose_marker(queries, more).collect()}
    assert got == {
        "q": ("16S", "majority_global_top_hits", 5, 1), "p": ("16S", "majority_global_top_hits", 1, 0), "tie": ("18S", "best_bitscore_tiebreak", 1, 1), "even": ("18S", "detected_model_tiebreak", 1, 1),
        "same": ("18S", "majority_global_top_hits", 0, 1), "none": ("18S", "detected_model_no_blast_hits", 0, 0)}


def test_suffixes_left_in_preferred_rows(spark, tmp_path):
    rows = [("Eukaryota;Obazoa:plas;x", "Eukaryota"), ("Eukaryota;Obazoa", "Eukaryota"), ("Eukaryota", "Eukaryota"), ("Bacteria;a:mito", "Bacteria"), (None, "Eukaryota")]
    spark.createDataFrame(rows, "taxonomy string, domain string").write.parquet(str(tmp_path / "preferred_taxonomy.parquet"))
    assert [r.suffix for r in reports.compartment_suffixes(spark, str(tmp_path)).collect()] == ["plas"]


def test_tree_reports(spark):
    columns = "query string, subject string, marker string, bit_score double, percent_identity double, alignment_length int, e_value double"
    hits = spark.createDataFrame([("t1", f"s{i}", "16S", 100.5 - i, 97.125, 10, 1e-9) for i in range(3)] + [("t2", "s0", "16S", 5.0, 90.0, 10, 1.0)], columns)
    queries = spark.createDataFrame([("s", "m", "q1", "t1"), ("s", "m", "q2", "t2")], "sample string, model string, name string, tree string")
    routes = annotate.choose_marker(spark.createDataFrame([("t1", "16S"), ("t2", "16S")], "query string, detected string"), hits)
    tasks, skipped = annotate.tree_tasks(hits, routes)
    taxonomy = known(spark, ("s0", "B;P;C", "SILVA", "B", "", "SILVA", "native", False), ("s1", "B;P;D", "PR2", "B", "plastid", "PR2", "native", False), ("s2", "", "", "Unclassified", "", "", "", False))
    labels = annotate.reference_labels(spark.createDataFrame([("s0", "SILVA", "1", "x")], "sequence_id string, reference_source string, source_version string, source_identifier string"))
    references = annotate.reference_rows(tasks, hits, taxonomy, labels)
    assert references.columns == ["query", *annotate.REFERENCE_FIELDS] and [(r.leaf_id, r.reference_identifiers, r.blast_pident, r.blast_evalue) for r in references.orderBy("leaf_id").collect()] == [
        ("REF0001", "SILVA:x", "97.125", "1e-09"), ("REF0002", "s1", "97.125", "1e-09"), ("REF0003", "s2", "97.125", "1e-09")]
    trees = spark.createDataFrame([("t1", "((QUERY:0.1,REF0002:0.25)88:0.5,(REF0001:1,REF0003:1)70:0.125);", "QUERY")], "tree string, newick string, query string")
    named = references.select(F.col("query").alias("tree"), F.col("leaf_id").alias("leaf"), F.col("hit_rank").cast("int").alias("hit_rank"), "taxonomy", "taxonomy_source", "taxonomy_domain", "compartment", "centroid_taxonomy", "centroid_taxonomy_source")
    ranked = ranked_neighbours(leaf_distances(trees, "tree", "newick", "query"), named, 5)
    got = {r.name: r for r in annotate.tree_assignments(queries, routes, classify_by_neighbours(ranked), references, {"16S": "RF00177", "18S": "RF01960"}).collect()}
    assert (got["q1"].tree_taxonomy, got["q1"].tree_nearest_sseqid, got["q1"].tree_nearest_distance, got["q1"].tree_query_edge_support, got["q1"].tree_basis_neighbors, got["q1"].tree_route_16s_best_bitscore, got["q1"].tree_route_18s_best_bitscore) == (
        "B;P", "s1", "0.35", "88", "2", "100.5", "")
    assert (got["q2"].tree_assignment_method, got["q2"].tree_basis_neighbors, got["q2"].tree_model, got["q2"].tree_inference_model) == (annotate.SKIPPED, "0", "RF00177", "") and skipped.count() == 1
    near = annotate.tree_neighbours(queries, routes, ranked, references, {"16S": "RF00177", "18S": "RF01960"})
    assert near.columns == annotate.NEIGHBOUR_FIELDS and [(r.leaf_id, r.tree_neighbor_rank, r.used_for_assignment, r.tree_distance, r.tree_lineage_basis) for r in near.collect()] == [
        ("REF0002", "1", "true", "0.35", "preferred_taxonomy"), ("REF0001", "2", "true", "1.725", "preferred_taxonomy"), ("REF0003", "3", "false", "1.725", "unclassified")]
    assert one(spark, annotate.task_key(F.lit("s"), F.lit("m"), F.lit("q"))) == "q_" + hashlib.sha256(b"s\0m\0q").hexdigest()[:16]


def test_streams(spark, tmp_path):
    """Best hits so far and hourly counts over files that arrive one after the other."""
    folder = tmp_path / "in"
    folder.mkdir()
    line = "q{}\ts{}\t90\t100\t0\t0\t1\t100\t1\t100\t1e-9\t{}\n"
    stream = arrivals.arriving_hits(spark, str(folder))
    best = arrivals.best_so_far(stream).writeStream.format("memory").queryName("best").outputMode("complete").start()
    hours = arrivals.hourly_counts(stream).writeStream.format("memory").queryName("hours").outputMode("complete").start()
    try:
        for i, rows in enumerate([[(1, "a", 5), (2, "b", 7)], [(1, "c", 9), (2, "d", 6)]]):
            (tmp_path / f"{i}.m8").write_text("".join(line.format(*r) for r in rows))
            (tmp_path / f"{i}.m8").rename(folder / f"{i}.m8")
            best.processAllAvailable()
            hours.processAllAvailable()
        assert {r["query"]: (r.subject, r.bit_score) for r in spark.table("best").collect()} == {"q1": ("sc", 9.0), "q2": ("sb", 7.0)}
        assert sum(r.hits for r in spark.table("hours").collect()) == 4
    finally:
        best.stop()
        hours.stop()
