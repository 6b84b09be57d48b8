"""Queries over series of marks, boxes, sentences with words, and states at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import series
from .adapters import FACTS_SQL, facts, micros, read

_DAY = 86_400_000_000


def rolling_median(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("user_id", "event_id", micros("ts").alias("at"), F.floor("value").cast("long").alias("v"))
    return series.rolling_median(rows, ["user_id"], [F.col("at"), F.col("event_id")], "v").select("event_id", "smooth")


def binned_peak(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("long").alias("v"))
    return series.binned_peak(rows, ["l_returnflag", "l_linestatus"], "v", 10)


def coord_spread(spark: SparkSession, d: str) -> DataFrame:
    rows = series.spread(read(spark, d, "part").withColumn("v", F.col("p_size").cast("double")), ["p_brand"], "v")
    return rows.select("p_brand", *[F.round(c, 4).alias(c) for c in ("median", "mean", "deviation", "reach")])


def bbox_union(spark: SparkSession, d: str) -> DataFrame:
    q, n, s = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long"), (F.col("l_suppkey") % 20).alias("s")
    boxes = read(spark, d, "lineitem").select("l_orderkey", n.alias("a"), s.alias("b"), (n + q).alias("c"), (s + n + 9).alias("d"))
    return series.box_union(boxes, ["l_orderkey"], ("a", "b", "c", "d"))


def positional_match(spark: SparkSession, d: str) -> DataFrame:
    boxes = read(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), "c_custkey")
    labels = read(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("nation"), "s_suppkey", "s_name")
    return series.matched_by_place(boxes, labels, ["nation"], [F.col("c_custkey")], [F.col("s_suppkey")], apart=True)


def sentence_semi(spark: SparkSession, d: str) -> DataFrame:
    """Orders as sentences of a year, their lines as words; returned lines are left out, so some sentences have no words."""
    days = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    told = read(spark, d, "orders").select("o_orderkey", days("o_orderdate").alias("day"))
    words = read(spark, d, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("o_orderkey"), days("l_shipdate").alias("w_start"), (days("l_shipdate") + F.col("l_quantity").cast("long")).alias("w_end"))
    return series.sentences_with_words(told, words, ["o_orderkey"], F.col("day"), F.col("day") + 365)


def covering_state(spark: SparkSession, d: str) -> DataFrame:
    day = F.floor(F.col("start") / _DAY).cast("long")
    states = facts(spark, d).withColumn("state_key", day).groupBy("clip_id", "state_key").agg(F.min("start").alias("state_start"), F.max("start").alias("state_end"))
    buys = read(spark, d, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("clip_id"), "event_id", (micros("ts") + 43_200_000_000).alias("at"))
    return series.state_at(states, buys, ["clip_id"], "at", 10_000, _DAY).select("event_id", "state_key", "gap")


def changed_years(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    out = series.changed_sets(rows, ["o_custkey"], F.col("o_orderstatus") == "O", "y")
    joined = lambda c: F.array_join(F.transform(c, lambda y: y.cast("string")), ",").alias(c)
    return out.select("o_custkey", joined("removed"), joined("added"))


def tail_frames(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("user_id", micros("ts").alias("at"))
    return series.tail_frames(rows, ["user_id"], "at", 7 * _DAY, _DAY, 4)


QUERIES = {f.__name__: f for f in (rolling_median, binned_peak, coord_spread, bbox_union, positional_match, sentence_semi, covering_state, changed_years, tail_frames)}

_DAYS = "date_diff('day', DATE '1970-01-01', {}::DATE)"

ORACLES = {
    "rolling_median": "SELECT event_id, median(floor(value)::BIGINT) OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS smooth FROM events",
    "binned_peak": "WITH b AS (SELECT l_returnflag, l_linestatus, round(trunc(l_extendedprice)::BIGINT / 10)::BIGINT AS bin, count(*) AS hits FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY ALL) SELECT l_returnflag, l_linestatus, bin * 10 AS peak, hits FROM b QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY hits DESC, bin) = 1",
    "coord_spread": "SELECT p_brand, round(median(p_size::DOUBLE), 4) AS median, round(avg(p_size::DOUBLE), 4) AS mean, round(stddev_pop(p_size::DOUBLE), 4) AS deviation, round((max(p_size) - min(p_size))::DOUBLE, 4) AS reach FROM part GROUP BY 1",
    "bbox_union": "SELECT l_orderkey, min(l_linenumber)::BIGINT AS x1, min(l_suppkey % 20) AS y1, max(l_linenumber + l_quantity::BIGINT)::BIGINT AS x2, max(l_suppkey % 20 + l_linenumber + 9)::BIGINT AS y2, count(*) AS n_boxes FROM lineitem GROUP BY 1",
    "positional_match": "WITH b AS (SELECT c_nationkey::BIGINT AS nation, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS place FROM customer), l AS (SELECT s_nationkey::BIGINT AS nation, s_suppkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS place FROM supplier) SELECT nation, place, c_custkey, s_suppkey, s_name FROM b LEFT JOIN l USING (nation, place)",
    "sentence_semi": f"WITH o AS (SELECT o_orderkey, {_DAYS.format('o_orderdate')} AS day FROM orders), w AS (SELECT l_orderkey, {_DAYS.format('l_shipdate')} AS a, {_DAYS.format('l_shipdate')} + l_quantity::BIGINT AS z FROM lineitem WHERE l_returnflag <> 'R') SELECT o_orderkey, day FROM o WHERE NOT EXISTS (SELECT 1 FROM w WHERE l_orderkey = o_orderkey) OR EXISTS (SELECT 1 FROM w WHERE l_orderkey = o_orderkey AND a < day + 365 AND z > day)",
    "covering_state": f"WITH f AS ({FACTS_SQL}), s AS (SELECT clip_id, start // {_DAY} AS state_key, min(start) AS a, max(start) AS z FROM f GROUP BY 1, 2), t AS (SELECT user_id AS clip_id, event_id, epoch_us(ts) + 43200000000 AS tm FROM events WHERE event_type = 'purchase'), m AS (SELECT event_id, state_key, a, z, greatest(a - 10000 - tm, tm - z - 10000, 0) AS gap FROM t JOIN s USING (clip_id)) SELECT event_id, state_key, gap FROM m QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY gap, a, z) = 1",
    "changed_years": "WITH g AS (SELECT o_custkey, coalesce(list(DISTINCT year(o_orderdate)) FILTER (WHERE o_orderstatus <> 'O'), []) AS a, coalesce(list(DISTINCT year(o_orderdate)) FILTER (WHERE o_orderstatus = 'O'), []) AS z FROM orders GROUP BY 1) SELECT o_custkey, coalesce(list_aggregate(list_sort(list_filter(a, lambda y: NOT list_contains(z, y))), 'string_agg', ','), '') AS removed, coalesce(list_aggregate(list_sort(list_filter(z, lambda y: NOT list_contains(a, y))), 'string_agg', ','), '') AS added FROM g",
    "tail_frames": f"WITH e AS (SELECT user_id, epoch_us(ts) AS tm, max(epoch_us(ts)) OVER (PARTITION BY user_id) AS z FROM events), s AS (SELECT user_id, (z - tm) // {_DAY} AS slot, tm FROM e WHERE z - tm <= 7 * {_DAY}) SELECT user_id, slot, max(tm) AS at FROM s WHERE slot < 4 GROUP BY 1, 2",
}
