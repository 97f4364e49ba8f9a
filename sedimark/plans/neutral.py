"""The operators on tables without biology, each beside its SQL.

Every query of an operator runs the function that the marker-gene plans use, with
other columns.  A few shapes are what Spark has built in and are written out:
filter_aggs, median_summary, json_props, union_mix, member_propagation and marker_explode_distinct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions import sequences as S
from sedimark.operators import integrity as I
from sedimark.operators import intervals as V
from sedimark.operators import lineage as L
from sedimark.operators import ranking as R
from sedimark.operators import summaries as A
from sedimark.operators import trees as T
from sedimark.plans.annotate import work_items
from sedimark.sources.text import wanted
from sedimark.storage import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(lambda name: table(spark, folder, name))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return run

    return register


def _big(*columns: str):
    return [F.col(c).cast("bigint").alias(c) for c in columns]


# ---- ranks, ties, windows -------------------------------------------------------------------------------------------


@query("""SELECT o_orderstatus, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER
(PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 3""")
def stratified_sample(t):
    """The first three keys of each stratum."""
    rows = t("orders").select("o_orderstatus", "o_orderpriority", "o_orderkey")
    return R.first_rows(rows, ["o_orderstatus", "o_orderpriority"], [F.col("o_orderkey")], 3)


@query("""WITH b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_extendedprice DESC, l_quantity DESC, l_linenumber) AS n FROM lineitem)
SELECT l_orderkey, l_suppkey, l_extendedprice, l_quantity, CAST(l_linenumber AS BIGINT) AS l_linenumber,
row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC, l_linenumber, l_suppkey) AS rank FROM b WHERE n = 1""")
def rank_hits(t):
    """Best row per pair, then ranks within the query."""
    best = [F.desc("l_extendedprice"), F.desc("l_quantity"), F.col("l_linenumber")]
    rows = t("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_quantity", *_big("l_linenumber"))
    once = R.first_rows(rows, ["l_orderkey", "l_suppkey"], best)
    return R.first_rows(once, ["l_orderkey"], [*best, F.col("l_suppkey")], 2**31 - 1, rank="rank")


@query("""WITH m AS (SELECT l_partkey, max(l_quantity) AS best FROM lineitem GROUP BY 1)
SELECT l.l_partkey, best, count(*) AS ties, count(*) > 2 AS truncated FROM lineitem l JOIN m ON m.l_partkey = l.l_partkey AND l_quantity = best GROUP BY 1, 2""")
def equal_best(t):
    return R.equal_best(t("lineitem"), ["l_partkey"], "l_quantity", 2)


@query("""WITH r AS (SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, max(l_extendedprice) OVER (PARTITION BY l_partkey) AS best,
row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) AS rank FROM lineitem),
s AS (SELECT *, min(rank) OVER (PARTITION BY l_partkey, l_returnflag) AS f FROM r)
SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, rank, concat_ws('|', CASE WHEN rank <= 5 THEN 'overall_top_n' END, CASE WHEN l_extendedprice = best THEN 'equal_best_assignment' END, CASE WHEN rank = f THEN 'best_' || l_returnflag END) AS reasons
FROM s WHERE rank <= 5 OR rank = f OR l_extendedprice = best""")
def evidence_topn(t):
    order = [-F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    rows = t("lineitem").select("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return R.top_with_evidence(rows, ["l_partkey"], order, "l_extendedprice", F.array("l_returnflag"), ["A", "N", "R"], 5)


@query("""WITH e AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,6)) AS p FROM lineitem WHERE l_quantity >= 10),
w AS (SELECT *, max(p) OVER (PARTITION BY l_partkey) AS best FROM e)
SELECT l_partkey, l_orderkey, l_suppkey, l_extendedprice FROM w WHERE p >= best * CAST(0.98 AS DECIMAL(3,2))""")
def candidate_window(t):
    return _candidates(t).select("l_partkey", "l_orderkey", "l_suppkey", "l_extendedprice")


def _candidates(t) -> DataFrame:
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")]
    rows = t("lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return R.candidates(rows, ["l_partkey"], F.col("l_extendedprice"), order, "0.98", F.col("l_quantity") >= 10, 5)


@query("""WITH r AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,6)) AS p, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_quantity) AS n FROM lineitem)
SELECT l_partkey, coalesce(max(CASE WHEN n = 6 THEN p END) >= max(CASE WHEN l_quantity >= 10 THEN p END) * CAST(0.98 AS DECIMAL(3,2)), false) AS truncated FROM r GROUP BY 1 HAVING count(*) FILTER (WHERE l_quantity >= 10) > 0""")
def truncation_sentinel(t):
    return _candidates(t).groupBy("l_partkey").agg(F.bool_or("truncated").alias("truncated"))


@query("""SELECT i AS chunk, count(*) AS size, min(doc_id) AS first, max(doc_id) AS last FROM (SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) AS i FROM documents) GROUP BY 1""")
def chunk_plan(t):
    return R.chunk_plan(t("documents"), "doc_id", 7)


@query("""WITH d AS (SELECT q.vec_id AS query_id, v.vec_id, round(sqrt(list_sum(list_transform(list_zip(v.embedding, q.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE))))), 6) AS distance
FROM embeddings v JOIN embeddings q ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS n FROM d),
b AS (SELECT query_id, max(distance) AS far FROM r WHERE n <= 10 GROUP BY 1)
SELECT d.query_id, vec_id, distance FROM d JOIN b ON b.query_id = d.query_id WHERE distance <= far""")
def boundary_knn(t):
    """The ten vectors nearest to each query and all as near as the tenth; the queries are all rows whose id is divisible by 20."""
    rows = t("embeddings").select("vec_id", "embedding")
    return R.nearest_vectors(rows, rows.where("vec_id % 20 = 0"), "vec_id", "embedding", 10).select(F.col("query").alias("query_id"), F.col("item").alias("vec_id"), "distance")


@query("""WITH o AS (SELECT user_id, event_type, value, CAST(floor(value / 10) AS BIGINT) AS item FROM events WHERE event_type IN ('view', 'click')),
a AS (SELECT *, row_number() OVER (PARTITION BY user_id, item ORDER BY value DESC, event_type) AS n FROM o),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_type, item) AS rank FROM a WHERE n = 1),
g AS (SELECT user_id, max(value) FILTER (WHERE event_type = 'view') AS best_view, max(value) FILTER (WHERE event_type = 'click') AS best_click FROM o GROUP BY 1),
v AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS votes_view, count(*) FILTER (WHERE event_type = 'click') AS votes_click FROM r WHERE rank <= 5 GROUP BY 1)
SELECT v.*, best_view, best_click, CASE WHEN votes_view > votes_click THEN 'view' WHEN votes_click > votes_view THEN 'click' WHEN best_click > best_view THEN 'click' ELSE 'view' END AS chosen,
CASE WHEN votes_view <> votes_click THEN 'majority_global_top_hits' WHEN best_view <> best_click THEN 'best_bitscore_tiebreak' ELSE 'detected_model_tiebreak' END AS decision FROM v JOIN g ON g.user_id = v.user_id""")
def global_merge_vote(t):
    """Two ranked lists merged per user; the majority of the five best decides, then the better score, then the first list."""
    rows = t("events").where(F.col("event_type").isin("view", "click")).select("user_id", "event_type", "value", F.floor(F.col("value") / 10).alias("item"))
    return R.vote(rows, ["user_id"], "item", "event_type", ["view", "click"], [F.desc("value"), F.col("event_type"), F.col("item")], "value", 5)


# ---- lineages -------------------------------------------------------------------------------------------------------

_PATHS = """p AS (SELECT s_suppkey, r_name AS domain, r_name || ';' || n_name || ';' || CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE 'G' || (s_suppkey % 5) END || ';' || s_name AS path
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_LCA = """n AS (SELECT k, count(*) AS n FROM b GROUP BY k), e AS (SELECT k, string_split(tax, ';') AS p FROM b),
x AS (SELECT k, i, array_to_string(p[1:i], ';') AS pre, len(list_filter(p[1:i], lambda z: z = '')) = 0 AS ok FROM e, (SELECT unnest(range(1, 5)) AS i) AS q WHERE i <= len(p)),
c AS (SELECT k, i, count(DISTINCT pre) AS cd, count(*) AS c, bool_and(ok) AS ok, min(pre) AS pre FROM x GROUP BY k, i),
lca AS (SELECT n.k, coalesce(max_by(pre, i) FILTER (WHERE cd = 1 AND ok AND c = n.n), '') AS lca FROM n LEFT JOIN c ON c.k = n.k GROUP BY n.k)"""


def _paths(t) -> DataFrame:
    place = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    group = F.when(F.col("s_suppkey") % 7 == 0, "").otherwise(F.concat(F.lit("G"), (F.col("s_suppkey") % 5).cast("string")))
    return t("supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("r_name").alias("domain"), F.concat_ws(";", "r_name", "n_name", group, "s_name").alias("path"))


@query(f"WITH {_PATHS}, b AS (SELECT DISTINCT l_partkey AS k, path AS tax FROM lineitem JOIN p ON l_suppkey = s_suppkey), {_LCA} SELECT k AS l_partkey, lca FROM lca")
def lca_per_part(t):
    rows = t("lineitem").select("l_partkey", "l_suppkey").distinct()
    return L.common_ancestors(rows, "l_suppkey", _paths(t).withColumnRenamed("s_suppkey", "l_suppkey"), ["l_partkey"], "path")


@query("""SELECT c_nationkey, CAST(floor(c_acctbal / 100) AS BIGINT) AS band, CASE WHEN count(DISTINCT nullif(c_mktsegment, '')) = 1 THEN max(nullif(c_mktsegment, ''))
WHEN count(DISTINCT nullif(c_mktsegment, '')) > 1 THEN 'mixed' ELSE '' END AS segment FROM customer GROUP BY 1, 2""")
def common_value(t):
    return t("customer").groupBy("c_nationkey", F.floor(F.col("c_acctbal") / 100).alias("band")).agg(L.common_value(F.col("c_mktsegment")).alias("segment"))


@query(f"""WITH {_PATHS}, m AS (SELECT *, max(l_quantity) OVER (PARTITION BY l_partkey) AS best FROM lineitem),
h AS (SELECT l_partkey, domain, path FROM m JOIN p ON l_suppkey = s_suppkey WHERE l_quantity = best), b AS (SELECT l_partkey AS k, path AS tax FROM h), {_LCA},
g AS (SELECT l_partkey, count(DISTINCT domain) AS d, min(domain) AS domain, count(*) AS ties FROM h GROUP BY 1)
SELECT l_partkey, CASE WHEN d > 1 THEN 'ambiguous' ELSE domain END AS domain, CASE WHEN d > 1 THEN '' WHEN ties > 2 THEN domain ELSE lca END AS taxonomy, ties, ties > 2 AS truncated,
CASE WHEN d > 1 THEN 'cross_domain_ambiguous_equal_best' WHEN ties > 2 THEN 'truncated_equal_best_lca' ELSE '' END AS assignment_method FROM g JOIN lca ON k = l_partkey""")
def assign_taxonomy(t):
    """Equally best rows, ambiguity across domains, back-off to the domain when cut off, else the common ancestor."""
    best = R.best_score_rows(t("lineitem").select("l_partkey", "l_suppkey", "l_quantity"), ["l_partkey"], "l_quantity")
    rows = best.join(_paths(t).withColumnRenamed("path", "taxonomy"), F.col("l_suppkey") == F.col("s_suppkey"))
    return L.assign_taxonomy(rows, ["l_partkey"], 2).select("l_partkey", "domain", "taxonomy", "ties", "truncated", "assignment_method")


@query("""WITH q AS (SELECT o_custkey, o_orderstatus, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 10 ELSE 20 END AS priority FROM orders),
b AS (SELECT *, min(priority) OVER (PARTITION BY o_custkey) AS least FROM q)
SELECT o_custkey, CAST(min(priority) AS BIGINT) AS priority, CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'ambiguous' ELSE min(o_orderstatus) END AS domain,
CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN '' ELSE min(o_orderstatus) END AS taxonomy, count(*) AS best_rows, count(DISTINCT o_orderstatus) > 1 AS conflict
FROM b WHERE priority = least GROUP BY 1""")
def preferred_priority(t):
    p = F.col("o_orderpriority")
    priority = F.when(p == "1-URGENT", 0).when(p == "2-HIGH", 10).otherwise(20)
    return L.preferred(t("orders").select("o_custkey", "o_orderstatus", "o_orderpriority"), ["o_custkey"], priority, "o_orderstatus", "o_orderstatus").drop("paths")


@query("""SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT p_brand || ':' || p_partkey)), '|') AS identifiers FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def identifiers_agg(t):
    pairs = t("lineitem").select("l_suppkey", "l_partkey").distinct().join(t("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return pairs.groupBy("l_suppkey").agg(A.sorted_distinct(F.concat_ws(":", "p_brand", F.col("p_partkey").cast("string"))).alias("identifiers"))


# ---- contents and keys ----------------------------------------------------------------------------------------------

_NORMAL = "translate(regexp_replace(text, '[ \\t\\r\\n\\f]+', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


@query(f"""SELECT sha256({_NORMAL}) AS content, count(*) AS members, min(doc_id) AS first, coalesce(array_to_string(list_sort(list(DISTINCT lang) FILTER (WHERE lang <> '')), '|'), '') AS langs
FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def exact_dedup(t):
    """Documents equal but for ASCII case and white space: members, least id, languages."""
    rows = t("documents").where("text is not null").select(F.sha2(S.ascii_upper(S.without_space(F.col("text"))), 256).alias("content"), "doc_id", "lang")
    return rows.groupBy("content").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("first"), A.sorted_distinct(F.col("lang")).alias("langs"))


@query("""SELECT doc_id, 'SSU_' || rtrim(translate(base64(unhex(sha256(text))), '+/', '-_'), '=') AS id FROM documents WHERE text IS NOT NULL""")
def content_id(t):
    return t("documents").where("text is not null").select("doc_id", S.content_id(F.col("text")).alias("id"))


@query("""SELECT o_orderkey, 'SRC_' || sha256(o_orderstatus || chr(31) || o_orderpriority || chr(31) || CAST(o_custkey AS VARCHAR)) AS id FROM orders""")
def stable_id(t):
    parts = [F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_custkey").cast("string")]
    return t("orders").select("o_orderkey", S.stable_id("SRC_", parts, "\x1f").alias("id"))


@query("SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part")
def marker_explode_distinct(t):
    return t("part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("token")).distinct()


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("SELECT n_nationkey, " + ", ".join(f"count(DISTINCT CASE WHEN c_mktsegment = '{s}' THEN c_custkey END) AS {s}" for s in SEGMENTS) + " FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def category_matrix(t):
    samples = t("nation").select("n_nationkey")
    return A.category_matrix(t("customer").withColumnRenamed("c_nationkey", "n_nationkey"), "n_nationkey", "c_mktsegment", ["c_custkey"], samples, SEGMENTS)


# ---- joins and sets -------------------------------------------------------------------------------------------------


@query("SELECT l_suppkey, count(*) AS rows, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5) GROUP BY 1")
def semi_lookup(t):
    keys = t("supplier").where("s_nationkey < 5").select(F.col("s_suppkey").alias("l_suppkey"))
    summed = t("lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    return wanted(summed, keys, "l_suppkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 150000)")
def anti_missing(t):
    """Customers without a large order."""
    large = t("orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    return I.missing_parents(t("customer").select("c_custkey"), large, ["c_custkey"])


@query("""SELECT doc_id, coalesce(latitude, 0.0) AS latitude, CASE WHEN i.taxon_oid IS NULL THEN 'unknown' ELSE 'located' END AS site FROM documents d
LEFT JOIN (SELECT taxon_oid, min(latitude) AS latitude FROM img_location GROUP BY 1) i ON d.taxon_oid = i.taxon_oid""")
def left_default(t):
    sites = t("img_location").groupBy("taxon_oid").agg(F.min("latitude").alias("latitude"), F.lit("located").alias("site"))
    return I.with_defaults(t("documents").select("doc_id", "taxon_oid"), sites, ["taxon_oid"], {"latitude": 0.0, "site": "unknown"}).drop("taxon_oid")


@query("""WITH s AS (SELECT n_regionkey AS r, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey IN (0, 1) GROUP BY 1, 2)
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, CASE WHEN b.q IS NULL THEN 'missing' WHEN a.q IS NULL THEN 'extra' WHEN a.q = b.q THEN 'same' ELSE 'changed' END AS status
FROM (SELECT * FROM s WHERE r = 0) a FULL JOIN (SELECT * FROM s WHERE r = 1) b ON a.l_partkey = b.l_partkey""")
def full_outer_diff(t):
    suppliers = t("supplier").join(t("nation").where("n_regionkey in (0, 1)"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    sums = t("lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("n_regionkey", "l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("q"))
    return I.full_difference(sums.where("n_regionkey = 0"), sums.where("n_regionkey = 1"), ["l_partkey"], ["q"])


@query("SELECT n_nationkey, r_regionkey, n_name || '/' || r_name AS item FROM nation, region")
def cross_work_items(t):
    """Every sample with every model; the models are a configuration of a few rows."""
    return work_items(t("nation"), t("region")).select("n_nationkey", "r_regionkey", F.concat_ws("/", "n_name", "r_name").alias("item"))


@query("""WITH o AS (SELECT o_custkey, o_orderkey, date_diff('day', TIMESTAMP '1970-01-01', o_orderdate) AS s FROM orders)
SELECT a.o_custkey, a.o_orderkey AS "left", b.o_orderkey AS "right" FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.s <= b.s + 30 AND b.s <= a.s + 30""")
def interval_overlap(t):
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    rows = t("orders").select("o_custkey", "o_orderkey", day.alias("s"), (day + 30).alias("e"))
    return V.overlapping_pairs(rows, ["o_custkey"], "o_orderkey", "s", "e", width=60)


@query("""SELECT 'status' AS dimension, o_orderstatus AS category, count(*) AS rows FROM orders GROUP BY 2 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM customer GROUP BY 2 UNION ALL SELECT 'flag', l_returnflag, count(*) FROM lineitem GROUP BY 2""")
def composition_long(t):
    orders = t("orders")
    return A.composition({"status": (orders, F.col("o_orderstatus")), "priority": (orders, F.col("o_orderpriority")), "segment": (t("customer"), F.col("c_mktsegment")), "flag": (t("lineitem"), F.col("l_returnflag"))})


@query("SELECT n_name, 'nation' AS source FROM nation UNION ALL SELECT r_name, '' FROM region")
def union_mix(t):
    """Two record streams of which one lacks a column."""
    a = t("nation").select("n_name", F.lit("nation").alias("source"))
    return a.unionByName(t("region").select(F.col("r_name").alias("n_name")), allowMissingColumns=True).na.fill("", ["source"])


@query("""WITH g AS (SELECT o_custkey, max(o_totalprice) AS best, count(*) AS members FROM orders GROUP BY 1) SELECT o_orderkey, o.o_custkey, best, members FROM orders o JOIN g ON o.o_custkey = g.o_custkey""")
def member_propagation(t):
    """Every member gets the outcome of its group, joined back to it."""
    outcomes = t("orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"), F.count(F.lit(1)).alias("members"))
    return t("orders").select("o_orderkey", "o_custkey").join(outcomes, "o_custkey").select("o_orderkey", "o_custkey", "best", "members")


# ---- aggregates -----------------------------------------------------------------------------------------------------


@query("""SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE value > 100) AS high, count(DISTINCT user_id) FILTER (WHERE value > 100) AS high_users,
count(DISTINCT (user_id, CAST(floor(value) AS BIGINT))) AS pairs, count(props) AS with_props FROM events GROUP BY 1""")
def filter_aggs(t):
    high = F.col("value") > 100
    whole = F.floor("value")
    return t("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(high).alias("high"), F.count_distinct(F.when(high, F.col("user_id"))).alias("high_users"),
        F.count_distinct(F.struct("user_id", whole)).alias("pairs"), F.count("props").alias("with_props"))


@query("""WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS customers, count(*) FILTER (WHERE c_acctbal < 0) AS negative FROM customer GROUP BY 1, 2)
SELECT c_nationkey, count(*) AS segments, CAST(sum(customers) AS BIGINT) AS customers, CAST(sum(negative) AS BIGINT) AS negative, array_to_string(list_slice(list(c_mktsegment ORDER BY c_mktsegment), 1, 5), ', ') AS preview FROM c GROUP BY 1""")
def site_rollup(t):
    first = t("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("negative"))
    return first.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("segments"), F.sum("customers").alias("customers"), F.sum("negative").alias("negative"), A.preview(F.col("c_mktsegment")).alias("preview"))


@query("""WITH c AS (SELECT n_regionkey AS r_regionkey, count(*) AS total, count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_acctbal > 0 AND lower(c_mktsegment) NOT IN ('unclassified', 'incertae sedis')) AS resolved
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT r.r_regionkey, coalesce(resolved, 0) AS resolved, coalesce(total - resolved, 0) AS unresolved,
CASE WHEN coalesce(total, 0) = 0 THEN '0.000' ELSE CAST(h // 1000 AS VARCHAR) || '.' || lpad(CAST(h % 1000 AS VARCHAR), 3, '0') END AS percent
FROM region r LEFT JOIN (SELECT *, (resolved * 200000 // total + 1) // 2 AS h FROM c) c ON c.r_regionkey = r.r_regionkey""")
def resolution_report(t):
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("r_regionkey"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("value"))
    return A.resolution(rows, "r_regionkey", F.col("value"), t("region"))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS rows, CAST(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS INTEGER) AS place FROM orders GROUP BY 1, 2""")
def lineage_counts(t):
    place = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    return A.ordered_counts(t("orders"), ["o_orderstatus", "o_orderpriority"], place, F.col("o_orderpriority"))


@query("""WITH c AS (SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 100) AS k FROM events GROUP BY 1), p AS (SELECT *, k::DOUBLE / n AS p, 1.959963984540054::DOUBLE AS z FROM c)
SELECT event_type, round((p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4::DOUBLE * n * n))) / (1 + z * z / n), 9) AS bound FROM p""")
def wilson_bound(t):
    counted = t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 100).alias("k"))
    return counted.select("event_type", F.round(A.wilson_lower_bound(F.col("k"), F.col("n")), 9).alias("bound"))


@query("""WITH c AS (SELECT l_returnflag, l_linenumber - 1 AS i, avg(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END) > 0.49 AS ok FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, CAST(coalesce(min(i) FILTER (WHERE NOT ok) - 1, max(i)) AS BIGINT) AS cap FROM c GROUP BY 1""")
def rank_caps(t):
    """The deepest rank up to which every one is good enough."""
    share = t("lineitem").groupBy("l_returnflag", (F.col("l_linenumber") - 1).alias("i")).agg((F.count_if(F.col("l_quantity") > 25) / F.count(F.lit(1)) > 0.49).alias("ok"))
    return A.contiguous_cap(share, ["l_returnflag"], "i", F.col("ok"))


@query("SELECT o_orderstatus, count(*) AS rows, round(median(o_totalprice), 6) AS middle, min(o_orderkey) AS first FROM orders GROUP BY 1")
def median_summary(t):
    return t("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.round(F.median("o_totalprice"), 6).alias("middle"), F.min("o_orderkey").alias("first"))


# ---- text -----------------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, translate(array_to_string(list_reverse(regexp_extract_all(text, '(?s).')), ''), 'ACGTUacgtu', 'TGCAAtgcaa') AS piece FROM documents WHERE text IS NOT NULL""")
def substr_revcomp(t):
    """Every text from its first to its last position, reverse complemented."""
    whole = S.interval(F.col("text"), F.lit(1), F.length("text"))
    return t("documents").where("text is not null").select("doc_id", S.reverse_complement(whole, "ACGTUacgtu", "TGCAAtgcaa").alias("piece"))


@query("""SELECT token, count(*) AS rows FROM (SELECT unnest(string_split_regex(centroid_name, '[-_;]')) AS token FROM taxonomy_assignments WHERE centroid_name IS NOT NULL) WHERE token <> '' GROUP BY 1""")
def tokenise_regex(t):
    tokens = t("taxonomy_assignments").select(F.explode(S.tokens(F.col("centroid_name"))).alias("token"))
    return tokens.where("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) AS rows FROM events GROUP BY 1")
def json_props(t):
    return t("events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k")).groupBy("event_type").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("rows"))


@query("""WITH c AS (SELECT i AS pos, substring(line, i, 1) AS c FROM raw_headers, (SELECT unnest(range(1, (SELECT max(length(line)) FROM raw_headers) + 1)) AS i) q WHERE length(line) >= i)
SELECT CAST(pos AS BIGINT) AS pos, count(*) AS rows, count(*) FILTER (WHERE c IN ('.', '-', '_', '~')) AS gaps, bool_or(c = '.' OR (c >= 'a' AND c <= 'z')) AS inserted FROM c GROUP BY 1""")
def gap_columns(t):
    """Per column of the lines, each to its end: how many reach it, have a gap there, and whether any marks an insertion."""
    return S.alignment_columns(t("raw_headers"), "line")


@query("SELECT text, count(*) AS rows FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def integrity_dups(t):
    return I.duplicate_texts(t("documents").where("text is not null"), "text")


@query("SELECT DISTINCT sequence_id FROM taxonomy_assignments WHERE sequence_id IS NOT NULL AND sequence_id NOT IN (SELECT sequence_id FROM sequences WHERE sequence_id IS NOT NULL)")
def integrity_orphans(t):
    """Sequences named by assignments, spelled as they are, that the table of sequences lacks."""
    return I.missing_parents(t("taxonomy_assignments").where("sequence_id is not null"), t("sequences"), ["sequence_id"])


# ---- order-dependent ------------------------------------------------------------------------------------------------


@query()
def greedy_overlap(t):
    """Events of a user as intervals of minutes that contest each other by value; not SQL."""
    start = F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ '2024-01-01', ts)")
    rows = t("events").select("user_id", "event_id", "event_type", start.alias("s"), (start + F.floor("value")).alias("e"), "value")
    return V.greedy_overlap(rows, ["user_id"], "event_id", "event_type", "s", "e", -F.col("value"), F.col("value"))


@query("""WITH f AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand FROM lineitem),
e AS (SELECT l_orderkey, CAST(l_partkey AS BIGINT) AS m, CAST(l_suppkey AS BIGINT) * CASE WHEN strand = '-' THEN -1 ELSE 1 END AS s, strand FROM f),
g AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT m) AS dm, count(DISTINCT s) AS ds, count(DISTINCT strand) AS strands, list(m ORDER BY m, s) AS by_m, list(m ORDER BY s, m) AS by_s FROM e GROUP BY 1)
SELECT l_orderkey, strands = 1 AND dm = n AND ds = n AND by_m = by_s AS collinear FROM g""")
def region_collinear(t):
    """Whether the rows of an order come in the same order by part and by supplier; each is two places long on either axis."""
    return _collinear(t, F.col("l_partkey") * 2, F.lit(1), F.col("l_suppkey") * 2, F.lit(1))


@query("""WITH f AS (SELECT l_orderkey, CAST(l_partkey AS BIGINT) AS m, CAST(l_quantity AS BIGINT) AS dm, CAST(l_suppkey AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS s, CAST(l_linenumber AS BIGINT) AS ds, l_returnflag = 'R' AS minus FROM lineitem),
e AS (SELECT l_orderkey, m, CASE WHEN minus THEN s - ds ELSE s END AS s, minus FROM f UNION ALL SELECT l_orderkey, m + dm, CASE WHEN minus THEN s ELSE s + ds END, minus FROM f),
g AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT m) AS dm, count(DISTINCT s) AS ds, count(DISTINCT minus) AS strands, list(m ORDER BY m, s) AS by_m, list(m ORDER BY s, m) AS by_s FROM e GROUP BY 1)
SELECT l_orderkey, strands = 1 AND dm = n AND ds = n AND by_m = by_s AS collinear FROM g""")
def region_collinear_ends(t):
    """region_collinear of rows as long as their quantity by part and as their line number by supplier, so that rows may overlap or enclose each other."""
    return _collinear(t, F.col("l_partkey"), F.col("l_quantity").cast("bigint"), F.col("l_suppkey"), F.col("l_linenumber"))


def _collinear(t, model, model_length, seq, seq_length) -> DataFrame:
    """Whether the rows of an order, as fragments with two ends, are collinear; on the minus strand the sequence runs from the greater end."""
    minus = F.col("l_returnflag") == "R"
    f = F.struct(model.alias("model_from"), (model + model_length).alias("model_to"), F.when(minus, seq + seq_length).otherwise(seq).alias("seq_from"),
                 F.when(minus, seq).otherwise(seq + seq_length).alias("seq_to"), F.when(minus, "-").otherwise("+").alias("strand"))
    return t("lineitem").groupBy("l_orderkey").agg(F.collect_list(f).alias("f")).select("l_orderkey", V.collinear(F.col("f")).alias("collinear"))


@query()
def newick_distance(t):
    """Trees made of each nation's suppliers: the distance of every leaf from the first; not SQL."""
    leaves = t("supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_suppkey")).alias("k"))
    first = F.concat(F.lit("n"), F.get("k", 0).cast("string"))
    others = F.transform(F.slice("k", F.lit(2), F.size("k")), lambda x: F.concat(F.lit(",n"), x.cast("string"), F.lit(":0.25)90:0.5")))
    # one leaf deeper each time; written in one go, as nesting text in text would copy it for every leaf
    newick = F.concat(F.repeat(F.lit("("), F.size("k") - 1), first, F.lit(":1.5"), F.array_join(others, ""), F.lit(";"))
    return T.leaf_distances(leaves.select(F.col("s_nationkey").alias("tree"), newick.alias("newick"), first.alias("query")), "tree", "newick", "query")
