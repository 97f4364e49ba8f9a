"""Sinks: Parquet tables, TSV, FASTA and JSON lines in a stated order, and a manifest that makes them valid.

Large results are sorted by range and written in as many files as there are
partitions, which keeps the order over the files; ``single`` joins them into one
file where a consumer needs one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.functions.sequences import content_id, wrapped
from sedimark.operators.integrity import duplicate_keys, require
from sedimark.plans.annotate import hit_table


def _ordered(df: DataFrame, keys: Sequence[str], single: bool) -> DataFrame:
    return df.coalesce(1).sortWithinPartitions(*keys) if single else df.orderBy(*keys)


def parquet(df: DataFrame, path: str, keys: Sequence[str], single: bool = False) -> None:
    """A table in the order of its keys, Zstandard compressed."""
    _ordered(df, keys, single).write.mode("errorifexists").option("compression", "zstd").parquet(path)


def tsv(df: DataFrame, path: str, keys: Sequence[str], single: bool = True) -> None:
    """Tab-separated text with a header; nulls and empty values are empty fields."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    _ordered(text, keys, single).write.mode("errorifexists").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("lineSep", "\n").csv(path)


def fasta(df: DataFrame, path: str, key: str, sequence: str, width: int = 80, single: bool = False) -> None:
    """Records in the order of their ids, wrapped; ids must be unique and, where they are content ids, fit their sequence."""
    require({
        "duplicate id": duplicate_keys(df, [key]),
        "id of another sequence": df.where(F.startswith(key, F.lit("SSU_")) & (F.length(key) == 47) & (content_id(F.col(sequence)) != F.col(key))).select(key),
    })
    ordered = _ordered(df, [key], single)
    ordered.select(F.concat(F.lit(">"), F.col(key), F.lit("\n"), wrapped(F.col(sequence), width))).write.mode("errorifexists").text(path)


def category_table(matrix: DataFrame, path: str, sample: str = "sample") -> None:
    """A category matrix as one local file: samples in order, categories that any sample has, nothing above the samples.

    Without any category it is an empty line and the samples.  A row is a sample, so the table is written by the driver,
    row by row.
    """
    names = [c for c in matrix.columns if c != sample]
    any_ = matrix.agg(*[F.max(c).alias(c) for c in names]).first() if names else None
    held = [c for c in names if any_[c]]
    with Path(path).open("w", encoding="utf-8", newline="\n") as out:
        out.write("\t".join(["", *held]) + "\n")
        for row in matrix.select(sample, *held).orderBy(sample).toLocalIterator():
            out.write("\t".join([row[0], *[str(v) for v in row[1:]]]) + "\n")


def _sorted(column: Column, kind: T.DataType) -> Column:
    """A value with the members of every structure in it in alphabetical order."""
    if isinstance(kind, T.StructType):
        members = F.struct(*[_sorted(column[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(column.isNotNull(), members)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _sorted(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(column)))
    return column


def json_lines(df: DataFrame, path: str, keys: Sequence[str], single: bool = False) -> None:
    """Compact JSON with keys in alphabetical order, at every level."""
    line = F.to_json(_sorted(F.struct(*df.columns), df.schema), {"ignoreNullFields": "false"})
    _ordered(df, keys, single).select(line).write.mode("errorifexists").text(path)


def extraction(records: DataFrame, samples: DataFrame, folder: str) -> None:
    """The three results of an extraction below ``folder``: sequences, table of hits and the pairs of sample and model that were searched.

    ``samples`` has every pair, also those without a hit, so the last is complete however little was found.
    """
    rows = records.orderBy("sample", "model", "subject", "start", "end", "strand")
    rows.select(F.concat(F.lit(">"), "name", F.lit("\n"), "sequence")).write.mode("errorifexists").text(f"{folder}/sequences")
    order = lambda i: F.get(F.split("coordinates", "-"), i).cast("bigint")
    hit_table(records).orderBy("sample", "model", "contig_name", order(0), order(1), "strand").write.mode("errorifexists").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(f"{folder}/hits")
    tsv(samples.select("sample", "model").distinct(), f"{folder}/samples", ["sample", "model"])


def concatenated(spark: SparkSession, path: str | list[str], target: str) -> None:
    """The lines of all files in the order of their names, each file's in its own order, as one table of text.

    Line numbers are Spark's own, which rise within a file.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))
    lines.orderBy("file", "line").select("value").write.mode("errorifexists").text(target)


def evidence_catalog(decisions: DataFrame, path: str) -> None:
    """``evidence_id, decision`` as JSON lines in the order of the ids, after one line that says how many there are and what they leave out."""
    spark = decisions.sparkSession
    privacy = {k: False for k in ("centroid_ids_packaged", "cluster_ids_packaged", "img_member_ids_packaged", "raw_cluster_tables_packaged")}
    header = json.dumps({"evidence_records": decisions.count(), "privacy": privacy, "record_type": "catalog", "schema_version": 1}, sort_keys=True, separators=(",", ":"))
    digest = F.substring("evidence_id", F.length(F.lit("IMGEV_")) + 1, F.lit(64))
    body = decisions.select(F.lit(1).alias("part"), "evidence_id", F.concat(F.lit('{"content_sha256":"'), digest, F.lit('","decision":'), "decision", F.lit(',"evidence_id":"'), "evidence_id", F.lit('","record_type":"evidence"}')).alias("value"))
    first = spark.createDataFrame([(0, "", header)], "part int, evidence_id string, value string")
    first.unionByName(body).orderBy("part", "evidence_id").select("value").write.mode("errorifexists").text(path)


def archive(folder: str, target: str, level: int = 19) -> str:
    """A local folder as a Zstandard-compressed tar that is the same for the same files: names in order, no times, no owners.  Gives its SHA-256."""
    import io
    import tarfile

    import zstandard

    root = Path(folder)
    draft = Path(target + ".draft")
    with draft.open("wb") as raw, zstandard.ZstdCompressor(level=level).stream_writer(raw, closefd=False) as packed, tarfile.open(fileobj=packed, mode="w|", format=tarfile.PAX_FORMAT) as tar:
        for p in sorted(q for q in root.rglob("*") if q.is_file()):
            info = tarfile.TarInfo(f"{root.name}/{p.relative_to(root).as_posix()}")
            info.size, info.mode, info.mtime, info.uid, info.gid = p.stat().st_size, 0o644, 0, 0, 0
            with p.open("rb") as f:
                tar.addfile(info, io.BufferedReader(f))
    draft.replace(target)
    return hashlib.sha256(Path(target).read_bytes()).hexdigest()


def _digest(path: Path) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def write_manifest(folder: str, name: str = "manifest.json") -> dict:
    """List every file of a local release folder with size and SHA-256; written last, so a reader that finds it finds all."""
    root = Path(folder)
    files = []
    for p in sorted(root.rglob("*")):
        if p.is_file() and p.name != name and not p.name.startswith((".", "_")):
            files.append({"path": str(p.relative_to(root)), "bytes": p.stat().st_size, "sha256": _digest(p)})
    manifest = {"files": files, "schema_version": 1}
    target = root / name
    draft = target.with_suffix(".tmp")
    draft.write_text(json.dumps(manifest, sort_keys=True, indent=2) + "\n", encoding="utf-8")
    draft.replace(target)
    return manifest


def check_manifest(folder: str, name: str = "manifest.json") -> list[str]:
    """Files that are missing or differ from the manifest, files it does not list, and paths in it that lead out of the folder."""
    root = Path(folder)
    listed = json.loads((root / name).read_text(encoding="utf-8"))["files"]
    wrong, known = [], set()
    for f in listed:
        p = root / f["path"]
        known.add(f["path"])
        if Path(f["path"]).is_absolute() or ".." in Path(f["path"]).parts:
            wrong.append(f["path"])
        elif not p.is_file() or p.stat().st_size != f["bytes"] or _digest(p) != f["sha256"]:
            wrong.append(f["path"])
    there = {str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and p.name != name and not p.name.startswith((".", "_"))}
    return wrong + sorted(there - known)
