"""Searches in chunks that can be interrupted: a plan, a receipt for every chunk, and a result that exists only when all are there.

The search itself is any function from a DataFrame of queries to a DataFrame of hits, such as one that pipes partitions
through an external program.  Plan, results and receipts lie in a folder that all executors share.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sedimark import storage
from sedimark.operators.integrity import IntegrityError, duplicate_keys, require
from sedimark.operators.ranking import chunk_bounds

Search = Callable[[DataFrame], DataFrame]


def fingerprint(df: DataFrame) -> dict[str, object]:
    """Number of rows and two sums of their hashes: equal for equal rows, in whatever order and partitions they come."""
    hashed = df.select(F.xxhash64(*sorted(df.columns)).alias("h"))
    row = hashed.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("h").alias("mixed")).first()
    return {"rows": row.rows, "total": str(row.total or 0), "mixed": str(row.mixed or 0)}


def _write(spark: SparkSession, path: str, value: dict) -> None:
    storage.write_text(spark, path, json.dumps(value, sort_keys=True, indent=1) + "\n")


def _read(spark: SparkSession, path: str) -> dict | None:
    """A JSON file, None where there is none or it is damaged."""
    if not storage.exists(spark, path):
        return None
    try:
        value = json.loads(storage.read_text(spark, path))
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def prepare(queries: DataFrame, folder: str, chunks: int, key: str = "id") -> dict:
    """Divide ``queries`` by the order of ``key`` into chunks whose sizes differ by one at most, write them and the plan.

    The chunks together must be the queries again.  A key that is null or there twice is an error; a plan that is there
    already must be of the same queries and as many chunks.
    """
    spark = queries.sparkSession
    whole = fingerprint(queries)
    known = _read(spark, f"{folder}/plan.json")
    if known is not None:
        if known["queries"] != whole or known["chunks"] != chunks:
            raise IntegrityError("the plan in this folder is of other queries")
        return known
    require({"key is null": queries.where(F.col(key).isNull()).select(key), "duplicate key": duplicate_keys(queries, [key])})
    chunk_bounds(queries, key, chunks).write.mode("overwrite").partitionBy("chunk").parquet(f"{folder}/queries")
    written = _queries(spark, folder, queries.schema)
    if fingerprint(written.select(*queries.columns)) != whole:
        raise IntegrityError("the chunks are not the queries")
    sizes = {str(r.chunk): r["count"] for r in written.groupBy("chunk").count().collect()}  # one row a chunk
    plan = {"chunks": chunks, "queries": whole, "schema": queries.schema.jsonValue(), "schema_version": 1, "sizes": sizes}
    _write(spark, f"{folder}/plan.json", plan)
    return plan


def _queries(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The written queries with ``chunk``; the schema is given, as chunks may be empty."""
    return spark.read.schema(StructType([*schema.fields, StructField("chunk", LongType())])).parquet(f"{folder}/queries")


def _plan(spark: SparkSession, folder: str) -> dict:
    plan = _read(spark, f"{folder}/plan.json")
    if plan is None:
        raise IntegrityError(f"no plan in {folder}")
    return plan


def _receipt_problem(spark: SparkSession, folder: str, chunk: int, database: str) -> str | None:
    """What is wrong with the receipt of a chunk, None if it stands for what is there."""
    receipt = _read(spark, f"{folder}/receipts/{chunk}.json")
    if receipt is None:
        return "no receipt"
    if receipt.get("plan") != _plan(spark, folder)["queries"] or receipt.get("chunk") != chunk:
        return "receipt of another plan"
    if receipt.get("database") != database:
        return "receipt of another database"
    if not storage.exists(spark, f"{folder}/results/{chunk}") or fingerprint(spark.read.parquet(f"{folder}/results/{chunk}")) != receipt.get("result"):
        return "result differs from its receipt"
    return None


def run(spark: SparkSession, folder: str, chunk: int, search: Search, database: Callable[[], str], force: bool = False) -> bool:
    """Search one chunk unless its receipt is valid; whether it was searched.

    ``database`` names the state of what is searched; it must be the same after the search as before.  The receipt is
    removed first and written last, so a search that was interrupted leaves none.
    """
    plan = _plan(spark, folder)
    if not 1 <= chunk <= plan["chunks"]:
        raise IntegrityError(f"chunk {chunk} of {plan['chunks']}")
    state = database()
    if not force and _receipt_problem(spark, folder, chunk, state) is None:
        return False
    receipt = f"{folder}/receipts/{chunk}.json"
    storage.remove(spark, receipt)
    queries = _queries(spark, folder, StructType.fromJson(plan["schema"])).where(F.col("chunk") == chunk).drop("chunk")
    search(queries).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/results/{chunk}")
    if database() != state:
        raise IntegrityError(f"the database changed while chunk {chunk} was searched")
    _write(spark, receipt, {"chunk": chunk, "database": state, "plan": plan["queries"], "result": fingerprint(spark.read.parquet(f"{folder}/results/{chunk}")), "schema_version": 1})
    return True


def gather(spark: SparkSession, folder: str, database: str) -> DataFrame:
    """The results of all chunks with ``chunk``, once every receipt is valid; a file that says so is written last."""
    plan = _plan(spark, folder)
    done = f"{folder}/complete.json"
    storage.remove(spark, done)
    problems = {c: p for c in range(1, plan["chunks"] + 1) if (p := _receipt_problem(spark, folder, c, database)) is not None}
    if problems:
        raise IntegrityError("; ".join(f"chunk {c}: {p}" for c, p in problems.items()))
    parts = [spark.read.parquet(f"{folder}/results/{c}").withColumn("chunk", F.lit(c)) for c in range(1, plan["chunks"] + 1)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    _write(spark, done, {"chunks": plan["chunks"], "database": database, "queries": plan["queries"], "results": fingerprint(whole), "schema_version": 1})
    return whole


def searched(queries: DataFrame, folder: str, search: Search, database: Callable[[], str], chunks: int = 1, key: str = "id") -> DataFrame:
    """Prepare, run what is missing and gather: a search that goes on where it was interrupted, and is not run again where it is complete."""
    spark = queries.sparkSession
    prepare(queries, folder, chunks, key)
    for chunk in range(1, chunks + 1):
        run(spark, folder, chunk, search, database)
    return gather(spark, folder, database())


def portable(value: object, roles: dict[str, str]) -> object:
    """A receipt without paths: every text that begins with a path of ``roles`` (path to role) names the role instead; a path that is left is an error."""
    if isinstance(value, dict):
        return {k: portable(v, roles) for k, v in value.items()}
    if isinstance(value, list):
        return [portable(v, roles) for v in value]
    if isinstance(value, str):
        for path, role in sorted(roles.items(), key=lambda r: -len(r[0])):
            if value == path or value.startswith(path.rstrip("/") + "/"):
                return f"<{role}>" + value[len(path.rstrip("/")):]
        if value.startswith("/") or "://" in value:
            raise IntegrityError(f"no role for path {value!r}")
    return value


def reused(spark: SparkSession, folder: str, key: dict, make: Callable[[], DataFrame]) -> DataFrame:
    """The table made before under the same ``key`` (say, the fingerprints of its inputs), or ``make``'s, written below ``folder``."""
    receipt = _read(spark, f"{folder}/receipt.json")
    if receipt is not None and receipt.get("key") == key and storage.exists(spark, f"{folder}/table") and fingerprint(spark.read.parquet(f"{folder}/table")) == receipt.get("result"):
        return spark.read.parquet(f"{folder}/table")
    storage.remove(spark, f"{folder}/receipt.json")
    make().write.mode("overwrite").parquet(f"{folder}/table")
    made = spark.read.parquet(f"{folder}/table")
    _write(spark, f"{folder}/receipt.json", {"key": key, "result": fingerprint(made), "schema_version": 1})
    return made
