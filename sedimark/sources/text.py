"""Sources of the marker-gene pipeline: FASTA, search tables, TSV and JSON lines, each under an explicit schema.

A source returns rows; ``violations`` of a source are rows that break its rules, so that a caller can keep the
valid ones or raise with ``operators.integrity.require``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions.sequences import is_nucleotide, normal_sequence
from sedimark.operators.integrity import IntegrityError, duplicate_keys, missing_parents

# Columns of the search tables.
TBLOUT = {"subject": 0, "model": 2, "model_accession": 3, "model_from": 5, "model_to": 6, "sequence_from": 7, "sequence_to": 8, "strand": 9, "bit_score": 14, "e_value": 15, "inclusion": 16}
BLAST_12 = "query string, subject string, percent_identity double, alignment_length int, mismatches int, gap_opens int, query_start int, query_end int, subject_start int, subject_end int, e_value double, bit_score double"
BLAST_8 = "query string, subject string, percent_identity decimal(18,6), alignment_length int, query_length int, subject_length int, query_coverage decimal(18,6), bit_score decimal(18,6)"


def fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, header, id, sequence`` of plain or compressed FASTA files; records are split by Spark's reader, lines joined."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\A>|\r|\n+\z", "").alias("value"))
    cut = F.instr("value", "\n")
    header = F.when(cut > 0, F.substring("value", F.lit(1), cut - 1)).otherwise(F.col("value"))
    body = F.when(cut > 0, F.substring("value", cut + 1, F.length("value"))).otherwise("")
    return raw.where(F.trim("value") != "").select("file", header.alias("header"), F.regexp_extract(header, r"\A\s*(\S*)", 1).alias("id"), F.regexp_replace(body, r"\s+", "").alias("sequence"))


def fasta_violations(records: DataFrame) -> DataFrame:
    """``file, header, reason`` of records without a header, without a sequence or with letters that code no nucleotide."""
    normal = normal_sequence(F.col("sequence"))
    reason = F.when(F.trim("header") == "", "empty_header").when(normal == "", "empty_sequence").when(~is_nucleotide(normal), "not_nucleotide")
    return records.select("file", "header", reason.alias("reason")).where("reason is not null")


def tblout(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Covariance-model hits of tblout files: white-space columns, the last of which is free text.

    Columns as in TBLOUT with numbers cast, ``included`` for the inclusion flag, ``start`` and ``end`` in ascending
    order, and ``reason`` for lines that break the format.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where("line <> '' and not startswith(line, '#')")
    parts = F.split("line", r"\s+", 18)
    number = {"model_from": "int", "model_to": "int", "sequence_from": "int", "sequence_to": "int", "bit_score": "double", "e_value": "double"}
    picked = lines.select("line", F.size(parts).alias("n"), *[(F.get(parts, i).try_cast(number[c]) if c in number else F.get(parts, i)).alias(c) for c, i in TBLOUT.items()])
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    reason = (
        F.when(F.col("n") < 17, "field_count").when(F.greatest(*[F.col(c).isNull() for c in list(number)[:4]]), "coordinate")
        .when(~F.col("strand").isin("+", "-"), "strand").when(~finite("bit_score") | ~finite("e_value"), "score"))
    return picked.select(
        "subject", "model", F.nullif("model_accession", F.lit("-")).alias("model_accession"), *list(number), "strand", (F.col("inclusion") == "!").alias("included"),
        F.least("sequence_from", "sequence_to").alias("start"), F.greatest("sequence_from", "sequence_to").alias("end"), reason.alias("reason"), "line")


def delimited(spark: SparkSession, path: str | list[str], schema: str, header: bool = False, separator: str = "\t") -> DataFrame:
    """Delimited rows under ``schema``; the header, if there is one, must be exactly the schema's names."""
    reader = spark.read.schema(schema).option("sep", separator).option("mode", "FAILFAST").option("quote", "").option("emptyValue", "").option("nullValue", "\0")
    if header:
        names = spark.read.text(path).limit(1).collect()
        expected = separator.join(c.split()[0] for c in schema.split(", "))
        if names and names[0].value != expected:
            raise IntegrityError(f"header {names[0].value!r} instead of {expected!r}")
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.csv(path)


def blast_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Twelve-column search hits, the best row of each (query, subject): score, identity, length, each descending."""
    order = F.struct("bit_score", "percent_identity", "alignment_length", F.struct("query_start", "subject_start", "query_end", "subject_end"))
    rows = delimited(spark, path, BLAST_12)
    best = rows.groupBy("query", "subject").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("query", "subject")]), order).alias("h"))
    return best.select("query", "subject", "h.*")


def exact_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Eight-column hits with exact decimals."""
    return delimited(spark, path, BLAST_8)


def out_of_range(hits: DataFrame) -> DataFrame:
    """Eight-column hits whose percentages, lengths or scores cannot be."""
    percent = lambda c: ~F.col(c).between(0, 100)
    return hits.where(percent("percent_identity") | percent("query_coverage") | (F.col("alignment_length") <= 0) | (F.col("query_length") <= 0) | (F.col("subject_length") <= 0) | (F.col("bit_score") < 0))


def hit_violations(hits: DataFrame) -> dict[str, DataFrame]:
    """Of exact_hits: pairs that are there twice, and figures that cannot be."""
    return {"duplicate pair": duplicate_keys(hits, ["query", "subject"]), "figure out of range": out_of_range(hits)}


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def clusters(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``cluster_id, centroid, members`` of a TSV whose last column is a list literal; members start with ``IMG_``, sorted, once."""
    rows = delimited(spark, path, "cluster_id string, centroid string, sequences string", header=True)
    quoted = F.regexp_extract_all("sequences", F.lit(r"'([^']*)'|\"([^\"]*)\""), 0)
    members = F.array_sort(F.array_distinct(F.filter(F.transform(quoted, lambda x: F.substring(x, F.lit(2), F.length(x) - 2)), lambda x: F.startswith(x, F.lit("IMG_")))))
    return rows.select("cluster_id", "centroid", members.alias("members"))


def cluster_violations(rows: DataFrame) -> dict[str, DataFrame]:
    """Of clusters: clusters that are there twice, and members of two of them."""
    return {"duplicate cluster": duplicate_keys(rows, ["cluster_id"]), "member of two clusters": duplicate_keys(rows.select(F.explode("members").alias("member")), ["member"])}


def rank_table(spark: SparkSession, path: str) -> DataFrame:
    """``path, rank`` of a TSV of taxon paths, in one spelling; a row without path or rank, or a path with two ranks, is an error."""
    rows = delimited(spark, path, "path string, id string, rank string, remark string, release string")
    parts = F.filter(F.transform(F.split(F.coalesce("path", F.lit("")), ";", -1), lambda x: F.trim(x)), lambda x: x != "")
    named = rows.select(F.array_join(parts, ";").alias("path"), F.lower(F.trim(F.coalesce("rank", F.lit("")))).alias("rank")).distinct()
    wrong = named.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("rank")).where("n > 1 or path = '' or rank = ''").limit(5).collect()
    if wrong:
        raise IntegrityError(f"paths with two ranks or none: {[r.path for r in wrong]}")
    return named


def with_optional(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Optional columns as empty text where they are missing; either all are there or none."""
    there = [c for c in columns if c in df.columns]
    if there and len(there) < len(columns):
        raise IntegrityError(f"only {there} of {list(columns)}")
    return df if there else df.select("*", *[F.lit("").alias(c) for c in columns])


def wanted(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among ``ids``: a semi join, which Spark broadcasts only while ids are few; integrity.missing_parents lists ids without a row."""
    return df.join(ids.select(F.col(key)).distinct(), key, "left_semi")


def empty_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


# ---- more FASTA -----------------------------------------------------------------------------------------------------


def whole_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``place, id, text`` of FASTA records with their text as it is, line ends included, so that texts in order of place join to the file.

    The last record gets a line end if it has none.  Nothing may stand before the first record.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).where("value <> ''").select(
        F.monotonically_increasing_id().alias("place"), F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\A>", "").alias("v"))
    last = raw.groupBy("file").agg(F.max("place").alias("place"), F.lit(True).alias("last"))  # one row a file
    end = F.when(F.col("last") & F.endswith("v", F.lit("\n")), "").otherwise("\n")
    return raw.join(last, ["file", "place"], "left").select("place", F.regexp_extract("v", r"\A([^\s]*)", 1).alias("id"), F.concat(F.lit(">"), "v", F.coalesce(end, F.lit("\n"))).alias("text"))


def record_violations(records: DataFrame) -> dict[str, DataFrame]:
    """Of whole_records: ids that are empty or not ASCII, records without a sequence, ids that occur twice."""
    return {
        "id is not ASCII": records.where((F.col("id") == "") | F.col("id").rlike(r"[^\x21-\x7E]")).select("id"),
        "empty sequence": records.where(~F.regexp_replace("text", r"\A[^\n]*\n", "").rlike(r"\S")).select("id"),
        "duplicate id": duplicate_keys(records, ["id"]),
    }


def query_violations(records: DataFrame) -> dict[str, DataFrame]:
    """Of fasta: ids that occur twice and records without a sequence."""
    return {"duplicate id": duplicate_keys(records, ["id"]), "empty sequence": records.where("sequence = ''").select("id")}


def assemblies(spark: SparkSession, path: str) -> DataFrame:
    """``sample, path`` of a FASTA file or of all in a folder; sample is the name without its ending, and must be an identifier."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{fna,fa,fasta}").load(path).select("path")
    name = F.regexp_extract("path", r"([^/]+)\.(?:fna|fa|fasta)\z", 1)
    sample = F.when(name.rlike(IDENTIFIER), name).otherwise(F.raise_error(F.concat(F.lit("invalid sample identifier: "), name)))
    return files.select(sample.alias("sample"), "path")


# ---- models ---------------------------------------------------------------------------------------------------------

# What names samples and models, models whose names and accessions belong together.
IDENTIFIER = r"\A[A-Za-z0-9][A-Za-z0-9._-]*\z"
BUNDLED = {"RF00177": "SSU_rRNA_bacteria", "RF01960": "SSU_rRNA_eukarya"}


def covariance_model(text: str, stem: str) -> tuple[str, str, int]:
    """``name, accession, length`` of a covariance-model file named ``stem``; the name stands for a missing accession.

    Exactly one model, closed by ``//``, with one NAME and one CLEN before it; what follows (a filter with fields of the
    same names) is not read.  Names and accessions of bundled models must belong together and to the file's name.
    """
    fields: dict[str, list[str]] = {}
    lines = [line.split() for line in text.splitlines()]
    models = sum(1 for words in lines if words and words[0].startswith("INFERNAL"))
    if models != 1:
        raise IntegrityError(f"{stem}: {models} models instead of one")
    if ["//"] not in [words[:1] for words in lines]:
        raise IntegrityError(f"{stem}: no // terminator")
    for words in lines[:[w[:1] for w in lines].index(["//"])]:
        if words and words[0] in ("NAME", "ACC", "CLEN"):
            if len(words) != 2 or words[0] in fields:
                raise IntegrityError(f"{stem}: malformed or repeated {words[0]}")
            fields[words[0]] = words[1]
    length = fields.get("CLEN", "")
    if "NAME" not in fields or not length.isdecimal() or int(length) < 1:
        raise IntegrityError(f"{stem}: NAME or CLEN missing or invalid")
    name, accession = fields["NAME"], fields.get("ACC")
    for a, n in BUNDLED.items():
        if (accession == a) != (name == n):
            raise IntegrityError(f"{stem}: model {name!r} with accession {accession!r}")
        if accession == a and stem != a:
            raise IntegrityError(f"{stem}: {a} must be in a file of that name")
    return name, accession or name, int(length)


def models(spark: SparkSession, path: str, markers: dict[str, str]) -> DataFrame:
    """``model_id, model, model_accession, model_length, marker`` of the covariance models of a folder: a handful, read in the driver."""
    rows = []
    for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.cm").load(path).select("path", "content").toLocalIterator():
        stem = f.path.rsplit("/", 1)[-1].removesuffix(".cm")
        if stem not in markers:
            raise IntegrityError(f"no marker is configured for model {stem!r}")
        rows.append((stem, *covariance_model(bytes(f.content).decode("utf-8"), stem), markers[stem]))
    return spark.createDataFrame(rows, "model_id string, model string, model_accession string, model_length int, marker string")


# ---- more tables ----------------------------------------------------------------------------------------------------


def named_columns(spark: SparkSession, path: str | list[str], required: Sequence[str], separator: str = "\t") -> DataFrame:
    """All columns of delimited text with a header, as text; ``required`` ones must be there."""
    rows = spark.read.option("sep", separator).option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "\0").csv(path)
    missing = sorted(set(required) - set(rows.columns))
    if missing:
        raise IntegrityError(f"columns missing: {missing}")
    return rows.na.fill("")


def tables(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """The rows of many TSV files (a pattern or a list), all text, with ``file``; every file must have exactly the header ``columns``.

    A file of only a header, as samples without results have it, gives no rows, and a line of only separators is none.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("quote", "").option("emptyValue", "").option("nullValue", "\0")
    return reader.csv(path).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns], F.col("_metadata.file_name").alias("file"))


ACCEPTED = "subject string, model string, model_accession string, model_from int, model_to int, sequence_from int, sequence_to int, strand string, bit_score double, e_value double"


def accepted(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Accepted hits of a TSV with exactly the columns of ACCEPTED."""
    return delimited(spark, path, ACCEPTED, header=True)


def accepted_violations(hits: DataFrame) -> dict[str, DataFrame]:
    """Accepted hits that are there twice, or without a subject, a model or a strand."""
    return {"duplicate accepted hit": duplicate_keys(hits, [c.split()[0] for c in ACCEPTED.split(", ")]),
            "incomplete accepted hit": hits.where(~F.coalesce((F.col("subject") != "") & (F.col("model") != "") & F.col("strand").isin("+", "-"), F.lit(False)))}


def region_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``subject, start, end, strand, kind`` of a five-column map of regions; what follows ``_d_`` in a subject is cut off, the ends are put in order."""
    rows = delimited(spark, path, "name string, first int, last int, strand string, kind string")
    return rows.select(F.get(F.split("name", "_d_", 2), 0).alias("subject"), F.least("first", "last").alias("start"), F.greatest("first", "last").alias("end"), "strand", "kind")


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Reference taxonomy from Parquet or from TSV, as the ending of the path says."""
    if path.lower().rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    rows = named_columns(spark, path, ["sequence_id", "taxonomy", "taxonomy_source", "domain"])
    for c in ("compartment", "cross_domain_conflict", "taxonomy_alternatives"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(""))
    said = F.lower(F.trim("cross_domain_conflict"))
    conflict = F.when(said.isin("true", "1"), True).when(said.isin("", "false", "0"), False).otherwise(F.raise_error(F.concat(F.lit("invalid boolean: "), said)))
    return rows.withColumn("sequence_id", F.trim("sequence_id")).withColumn("cross_domain_conflict", conflict)


def centroids(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, centroid`` of a cluster table, trimmed."""
    return named_columns(spark, path, ["cluster_id", "centroid"]).select(F.trim("cluster_id").alias("cluster_id"), F.trim("centroid").alias("centroid"))


def centroid_violations(pairs: DataFrame, records: DataFrame) -> dict[str, DataFrame]:
    """Clusters or centroids that are empty or there twice, and centroids without exactly one FASTA record of that header."""
    found = records.join(pairs.withColumnRenamed("centroid", "header"), "header").select("header")
    return {
        "no cluster or centroid": pairs.where("cluster_id = '' or centroid = ''"), "duplicate cluster": duplicate_keys(pairs, ["cluster_id"]), "centroid of several clusters": duplicate_keys(pairs, ["centroid"]),
        "several records of a centroid": duplicate_keys(found, ["header"]), "centroid without record": missing_parents(pairs.select(F.col("centroid").alias("header")), records, ["header"]),
    }


def centroid_sequences(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``id, sequence``: the sequence of every cluster's centroid under the cluster's name, in one form."""
    return records.join(pairs.withColumnRenamed("centroid", "header"), "header").select(F.col("cluster_id").alias("id"), normal_sequence(F.col("sequence")).alias("sequence"))


def location_table(spark: SparkSession, path: str) -> DataFrame:
    """``taxon_oid, latitude, longitude`` of a TSV, as text, its other columns refused; the oid may be called ``img genome id``."""
    rows = named_columns(spark, path, [])
    names = {c: c.strip().lower() for c in rows.columns}
    renamed = rows.select(*[F.col(f"`{c}`").alias("taxon_oid" if n == "img genome id" else n) for c, n in names.items()])
    if "taxon_oid" not in renamed.columns:
        raise IntegrityError("columns missing: ['taxon_oid']")
    for c in ("latitude", "longitude"):
        if c not in renamed.columns:
            renamed = renamed.withColumn(c, F.lit(None).cast("string"))
    return renamed


ASSIGNMENT_COLUMNS = ("source_identifier", "taxonomy", "taxonomy_source", "assignment_method", "evidence", "compartment", "centroid", "centroid_name", "centroid_taxonomy", "centroid_taxonomy_source")


def assignment_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Assignments of cluster members from TSV, all text; see calibrate.remapped_evidence and release.derived_violations for their rules."""
    return named_columns(spark, path, ASSIGNMENT_COLUMNS)


def keyed(spark: SparkSession, path: str, columns: Sequence[str], keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A TSV with exactly ``columns``, and its keys that occur twice."""
    rows = tables(spark, path, columns).drop("file")
    return rows, duplicate_keys(rows, keys)
