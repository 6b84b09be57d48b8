"""Queries over frames, chart marks and layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import iou
from ..operators import charts, joins, keyframes
from ..operators.islands import clusters
from ..operators.ordering import first_rows, pick_evenly
from .adapters import micros, read

TICKS = [(0.0, 900.0), (10.0, 1100.0), (25.0, 1500.0), (50.0, 2100.0)]


def _frames(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("user_id", "event_id", "event_type", "value", micros("ts").alias("at"))


def nearest_frame(spark: SparkSession, d: str) -> DataFrame:
    rows = _frames(spark, d)
    left = rows.where("event_type = 'click'").select("user_id", "event_id", "at")
    right = rows.where("event_type = 'view'").select("user_id", F.col("event_id").alias("frame"), "at", "value").withColumnRenamed("frame", "event_id")
    return joins.nearest(left, right, ["user_id"], "at", "event_id", ["value"]).select("event_id", F.col("near_event_id").alias("frame_id"), "distance")


def sample_grid(spark: SparkSession, d: str) -> DataFrame:
    return keyframes.on_grid(_frames(spark, d), ["user_id"], "at", "event_id", 12 * 3_600_000_000).select("user_id", "grid", "event_id")


def even_pick(spark: SparkSession, d: str) -> DataFrame:
    return pick_evenly(_frames(spark, d), ["user_id"], [F.col("at"), F.col("event_id")], 8).select("user_id", "event_id")


def state_sampling(spark: SparkSession, d: str) -> DataFrame:
    return keyframes.change_windows(_frames(spark, d).groupBy("user_id", "at").agg(F.max("value").alias("value")), ["user_id"], "at", "value", 300.0)


def motion_scores(spark: SparkSession, d: str) -> DataFrame:
    return keyframes.motion(read(spark, d, "embeddings"), ["label"], "vec_id", "embedding", 1000).select("vec_id", F.round("motion", 6).alias("motion"))


def keyframe_top1(spark: SparkSession, d: str) -> DataFrame:
    order = [(F.col("p_size") > 25).desc(), (F.col("p_retailprice") > 1200).desc(), F.col("p_size").desc(), F.col("p_partkey")]
    return first_rows(read(spark, d, "part"), ["p_brand"], order).select("p_brand", "p_partkey", "p_size")


def combined_score(spark: SparkSession, d: str) -> DataFrame:
    signals = {"completeness": F.col("l_quantity") / 50, "finality": F.col("l_discount") * 10, "integrity": F.col("l_tax") * 12, "visibility": F.col("l_extendedprice") / 100000, "motion": F.col("l_linenumber") / 7}
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(keyframes.combined_score(signals), 4).alias("score"))


def quality_fallback(spark: SparkSession, d: str) -> DataFrame:
    good = (F.col("c_acctbal") > 9500) & (F.col("c_mktsegment") == "BUILDING")
    return keyframes.or_all(read(spark, d, "customer"), ["c_nationkey"], good).select("c_custkey", "c_nationkey")


def regression_fill(spark: SparkSession, d: str) -> DataFrame:
    y = F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice"))
    rows = read(spark, d, "part").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("x"), y.alias("y"))
    return charts.filled_by_line(rows, ["p_brand"], "x", "y").select("p_partkey", "estimated", F.round("filled", 3).alias("filled"))


def tick_interpolate(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("p_size").cast("double")
    return read(spark, d, "part").select("p_partkey", F.round(joins.interpolated(x * 1.5 - 5, TICKS), 4).alias("value"))


def plausibility(spark: SparkSession, d: str) -> DataFrame:
    return charts.plausible(read(spark, d, "part").withColumn("p_size", F.col("p_size").cast("double")), ["p_brand"], "p_retailprice", "p_size").select("p_partkey", "plausible")


def bar_regularity(spark: SparkSession, d: str) -> DataFrame:
    return charts.regularity(_frames(spark, d).withColumn("at", F.col("at") / 1e6), ["user_id"], "at").select("user_id", "marks", F.round("regularity", 4).alias("regularity"))


def gap_cluster(spark: SparkSession, d: str) -> DataFrame:
    rows = clusters(read(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", 400)
    return rows.groupBy("o_custkey", "cluster").agg(F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"), F.count("*").alias("n"))


def bbox_iou(spark: SparkSession, d: str) -> DataFrame:
    q, n, s = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long"), F.col("l_suppkey") % 20
    a, b = [n, n, n + q, n + 10], [s, s - 3, s + 15, s + 9]
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(iou(a, b), 6).alias("iou"))


def nice_ticks(spark: SparkSession, d: str) -> DataFrame:
    tops = read(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
    return tops.select("o_custkey", charts.tick_step(F.col("top")).alias("step"))


def bar_layout(spark: SparkSession, d: str) -> DataFrame:
    counts = read(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return charts.bar_layout(counts, ["c_nationkey"], [F.col("c_mktsegment")], "n", 400, 640)


def chart_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Totals by priority and status, by priority, and of all."""
    rows = read(spark, d, "orders").rollup("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return rows.select(F.coalesce("o_orderpriority", F.lit("all")).alias("priority"), F.coalesce("o_orderstatus", F.lit("all")).alias("status"), "n", F.round("total", 0).alias("total"))


QUERIES = {f.__name__: f for f in (nearest_frame, sample_grid, even_pick, state_sampling, motion_scores, keyframe_top1, combined_score, quality_fallback, regression_fill, tick_interpolate, plausibility, bar_regularity, gap_cluster, bbox_iou, nice_ticks, bar_layout, chart_rollup)}

_E = "WITH e AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) AS tm FROM events)"
_ABS = "list_sum(list_transform(list_zip({0}, {1}), lambda p: abs(p[1]::DOUBLE - p[2]::DOUBLE))) / len({0})"
_D, _U = _ABS.format("embedding", "b"), _ABS.format("embedding", "a")

ORACLES = {
    "nearest_frame": f"{_E}, p AS (SELECT c.event_id, v.event_id AS frame_id, abs(v.tm - c.tm) AS distance, row_number() OVER (PARTITION BY c.event_id ORDER BY abs(v.tm - c.tm), v.tm, CASE WHEN v.tm <= c.tm THEN -v.event_id ELSE v.event_id END) AS k FROM e c LEFT JOIN e v ON c.user_id = v.user_id AND v.event_type = 'view' WHERE c.event_type = 'click') SELECT event_id, frame_id, distance FROM p WHERE k = 1",
    "sample_grid": f"{_E}, o AS (SELECT *, tm - min(tm) OVER (PARTITION BY user_id) AS r FROM e), g AS (SELECT *, (r + 21600000000) // 43200000000 AS grid FROM o) SELECT user_id, grid, event_id FROM g QUALIFY row_number() OVER (PARTITION BY user_id, grid ORDER BY abs(r - grid * 43200000000), tm, event_id) = 1",
    "even_pick": f"{_E}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tm, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e) SELECT user_id, event_id FROM p WHERE n <= 8 OR list_contains(list_transform(range(8), lambda k: round_even(k * (n - 1) / 7.0::DOUBLE, 0)::BIGINT), i)",
    "state_sampling": f"{_E}, m AS (SELECT user_id, tm, max(value) AS v FROM e GROUP BY 1, 2), l AS (SELECT *, lag(tm) OVER w AS b, lag(v) OVER w AS bv FROM m WINDOW w AS (PARTITION BY user_id ORDER BY tm)) SELECT user_id, b AS window_start, tm AS window_end FROM l WHERE b IS NOT NULL AND greatest(v, bv) >= 300",
    "motion_scores": f"WITH n AS (SELECT *, lag(embedding) OVER w AS b, lead(embedding) OVER w AS a FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)) SELECT vec_id, round(CASE WHEN b IS NULL AND a IS NULL THEN 0 WHEN b IS NULL THEN {_U} WHEN a IS NULL THEN {_D} ELSE (({_D}) + ({_U})) / 2 END, 6) AS motion FROM n",
    "keyframe_top1": "SELECT p_brand, p_partkey, p_size FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size > 25 DESC, p_retailprice > 1200 DESC, p_size DESC, p_partkey) = 1",
    "combined_score": "SELECT l_orderkey, l_linenumber, round(0.0::DOUBLE + 0.35::DOUBLE * least(greatest(l_quantity / 50, 0), 1) + 0.25::DOUBLE * least(greatest(l_discount * 10, 0), 1) + 0.2::DOUBLE * least(greatest(l_tax * 12, 0), 1) + 0.15::DOUBLE * least(greatest(l_extendedprice / 100000, 0), 1) + (-0.05::DOUBLE) * least(greatest(l_linenumber / 7, 0), 1), 4) AS score FROM lineitem",
    "quality_fallback": "WITH g AS (SELECT *, c_acctbal > 9500 AND c_mktsegment = 'BUILDING' AS ok FROM customer) SELECT c_custkey, c_nationkey FROM g QUALIFY ok OR NOT bool_or(ok) OVER (PARTITION BY c_nationkey)",
    "regression_fill": "WITH r AS (SELECT p_partkey, p_brand, p_size::DOUBLE AS x, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS y FROM part), l AS (SELECT p_brand, regr_slope(y, x) AS s, regr_intercept(y, x) AS i, count(y) AS n FROM r GROUP BY 1) SELECT p_partkey, y IS NULL AND n >= 2 AS estimated, round(coalesce(y, CASE WHEN n >= 2 THEN greatest(s * x + i, 0) END), 3) AS filled FROM r JOIN l USING (p_brand)",
    "tick_interpolate": "SELECT p_partkey, round(greatest(CASE WHEN c <= 10 THEN 900 + c * 20 WHEN c <= 25 THEN 1100 + (c - 10) * (400.0::DOUBLE / 15) ELSE 1500 + (c - 25) * 24 END, 0)::DOUBLE, 4) AS value FROM (SELECT p_partkey, p_size::DOUBLE * 1.5::DOUBLE - 5 AS c FROM part)",
    "plausibility": "SELECT p_partkey, CASE WHEN p_retailprice < 0 THEN false ELSE abs(p_retailprice / max(p_retailprice) OVER w - p_size::DOUBLE / max(p_size) OVER w) <= CASE WHEN p_retailprice < 5 THEN 0.15::DOUBLE ELSE 0.12::DOUBLE END END AS plausible FROM part WINDOW w AS (PARTITION BY p_brand)",
    "bar_regularity": f"{_E}, g AS (SELECT user_id, tm / 1e6 - lag(tm / 1e6) OVER (PARTITION BY user_id ORDER BY tm) AS gap FROM e), s AS (SELECT user_id, count(*) AS marks, avg(gap) AS m, stddev_pop(gap) AS d FROM g GROUP BY 1) SELECT user_id, marks, round(CASE WHEN marks < 3 OR m = 0 THEN 1 ELSE greatest(0, 1 - 3 * d / m) END, 4) AS regularity FROM s",
    "gap_cluster": "WITH g AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey - lag(o_orderkey) OVER w <= 400 THEN 0 ELSE 1 END AS o FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)), i AS (SELECT *, (sum(o) OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::BIGINT AS cluster FROM g) SELECT o_custkey, cluster, min(o_orderkey) AS first, max(o_orderkey) AS last, count(*) AS n FROM i GROUP BY 1, 2",
    "bbox_iou": "WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity::BIGINT AS q, l_linenumber AS n, l_suppkey % 20 AS s FROM lineitem), i AS (SELECT *, greatest(least(n + q, s + 15) - greatest(n, s), 0) * greatest(least(n + 10, s + 9) - greatest(n, s - 3), 0) AS x FROM b) SELECT l_orderkey, l_linenumber, round(x / (q * 10 + 180 - x), 6) AS iou FROM i",
    "nice_ticks": "WITH t AS (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1), p AS (SELECT *, pow(10.0::DOUBLE, floor(log10(top / 9))) AS p FROM t) SELECT o_custkey, list_filter([p, p * 2, p * 5, p * 10, p * 20], lambda s: top / s <= 9)[1] AS step FROM p",
    "bar_layout": "WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) - 1 AS slot, round((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) - 1) * 640 / count(*) OVER (PARTITION BY c_nationkey), 3) AS bar_x, round(n / max(n) OVER (PARTITION BY c_nationkey) * 400, 3) AS bar_height FROM c",
    "chart_rollup": "SELECT coalesce(o_orderpriority, 'all') AS priority, coalesce(o_orderstatus, 'all') AS status, count(*) AS n, round(round(sum(o_totalprice), 2), 0) AS total FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)",
}
