"""Queries over facts, states and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts as op
from ..operators import quality
from ..operators.ordering import first_rows, majority
from .adapters import FACTS_SQL, facts, micros, read

_HOUR = 3_600_000_000
_F = f"WITH f AS ({FACTS_SQL})"


def _ticks(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", (F.col("l_quantity").cast("long") % 5).alias("v"))


def axis_ticks(spark: SparkSession, d: str) -> DataFrame:
    return op.axis_tick_keys(_ticks(spark, d), "l_orderkey", "l_returnflag", "v")


def axis_tick_filter(spark: SparkSession, d: str) -> DataFrame:
    return op.without_axis_ticks(_ticks(spark, d), "l_orderkey", "l_returnflag", "v").select("l_orderkey", "l_linenumber", "v")


def primary_state(spark: SparkSession, d: str) -> DataFrame:
    clips = read(spark, d, "events").groupBy(F.col("user_id").alias("clip_id")).agg(F.max(micros("ts")).alias("end"), F.min(micros("ts")).alias("begin"))
    target = clips.select("clip_id", ((F.col("begin") + F.col("end")) / 2).cast("long").alias("target"))
    rows = facts(spark, d).join(target, "clip_id")
    return first_rows(rows, ["clip_id"], [F.abs(F.col("start") - F.col("target")), F.col("ord")]).select("clip_id", "entity_id", "value", "start")


def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    rows = facts(spark, d).withColumn("day", F.floor(F.col("start") / (24 * _HOUR)).cast("long"))
    return majority(rows, ["clip_id", "entity_id"], "value")


def line_series(spark: SparkSession, d: str) -> DataFrame:
    points = F.array_sort(F.collect_list(F.struct("start", "ord", "value")))
    return facts(spark, d).groupBy("clip_id", "entity_id").agg(F.array_join(F.transform(points, lambda p: p["value"].cast("string")), ",").alias("series"), F.count("*").alias("n_points"))


def merge_rows(spark: SparkSession, d: str) -> DataFrame:
    own = read(spark, d, "customer").select(F.lit(0).alias("src"), F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("nation"), F.floor(F.col("c_acctbal") / 100).cast("long").alias("band"))
    more = read(spark, d, "supplier").select(F.lit(1).alias("src"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("long").alias("nation"), F.floor(F.col("s_acctbal") / 100).cast("long").alias("band"))
    return first_rows(own.unionByName(more), ["nation", "band"], [F.col("src"), F.col("id")])


def missing_entities(spark: SparkSession, d: str) -> DataFrame:
    customers, orders = read(spark, d, "customer").select("c_custkey", "c_mktsegment"), read(spark, d, "orders").where("o_orderstatus = 'P' AND o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return customers.join(orders, "c_custkey", "left_anti")


def _rules() -> list:
    return [
        ("hard_fail", "missing_order", F.col("o_orderkey").isNull()),
        ("hard_fail", "no_price", F.coalesce(F.col("o_totalprice"), F.lit(0.0)) <= 0),
        ("needs_review", "ships_before_order", F.col("first_ship") < F.col("o_orderdate")),
        ("needs_review", "many_lines", F.col("n_lines") >= 7),
        ("needs_review", "late_ship", F.datediff("last_ship", "o_orderdate") > 2000),
    ]


def _checked(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.count("*").alias("n_lines"))
    orders = read(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")


def quality_issues(spark: SparkSession, d: str) -> DataFrame:
    return quality.check(_checked(spark, d), "l_orderkey", _rules())


def quality_status(spark: SparkSession, d: str) -> DataFrame:
    keys = read(spark, d, "lineitem").select("l_orderkey").distinct()
    return quality.status(keys, quality_issues(spark, d), "l_orderkey")


def quality_queue(spark: SparkSession, d: str) -> DataFrame:
    return quality_status(spark, d).groupBy("status", "issue_codes").agg(F.count("*").alias("clips"), F.min("l_orderkey").alias("first_clip"))


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    """The events of a user as reviews of a document."""
    decision = F.when(F.col("event_type") == "purchase", "approved").when(F.col("event_type") == "click", "edited").when(F.col("event_type") == "view", "rejected").otherwise("skipped")
    return read(spark, d, "events").select(F.col("user_id").alias("doc_id"), micros("ts").alias("reviewed_at"), F.col("event_id").alias("id"), decision.alias("decision"))


def latest_review(spark: SparkSession, d: str) -> DataFrame:
    return quality.latest(_reviews(spark, d), "doc_id", ["reviewed_at", "id"])


def review_routing(spark: SparkSession, d: str) -> DataFrame:
    return quality.route(read(spark, d, "documents").select("doc_id"), latest_review(spark, d), "doc_id", "decision")


def clip_index(spark: SparkSession, d: str) -> DataFrame:
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    kept = first_rows(orders, ["o_custkey", "o_orderstatus", "o_orderpriority"], [F.col("o_orderkey")])
    from ..functions.scalars import slug
    from ..operators.ordering import numbered

    indexed = numbered(kept, ["o_custkey", "o_orderstatus"], [F.col("o_orderkey")], "chart_index")
    return indexed.select("o_orderkey", "chart_index", F.concat_ws("_", slug(F.col("o_orderpriority")), "chart_index").alias("output_stem"))


def clips_per_chart(spark: SparkSession, d: str) -> DataFrame:
    return first_rows(read(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderpriority"], [F.col("o_orderkey")], 50)


QUERIES = {f.__name__: f for f in (axis_ticks, axis_tick_filter, primary_state, majority_vote, line_series, merge_rows, missing_entities, quality_issues, quality_status, quality_queue, latest_review, review_routing, clip_index, clips_per_chart)}

_TICKS = """WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity::BIGINT % 5 AS v FROM lineitem),
s AS (SELECT l_orderkey, l_returnflag, list_sort(list(DISTINCT v)) AS vs FROM t GROUP BY ALL),
k AS (SELECT l_orderkey, l_returnflag FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, vs) AS n FROM s WHERE len(vs) >= 2) WHERE n > 1)"""
_DAY = f"start // {24 * _HOUR}"
_ISSUES = """WITH l AS (SELECT l_orderkey, min(l_shipdate) AS a, max(l_shipdate) AS z, count(*) AS n FROM lineitem GROUP BY 1),
j AS (SELECT * FROM l LEFT JOIN orders ON l_orderkey = o_orderkey),
i AS (SELECT l_orderkey, 'hard_fail' AS severity, 'missing_order' AS issue_code FROM j WHERE o_orderkey IS NULL
  UNION ALL SELECT l_orderkey, 'hard_fail', 'no_price' FROM j WHERE coalesce(o_totalprice, 0) <= 0
  UNION ALL SELECT l_orderkey, 'needs_review', 'ships_before_order' FROM j WHERE a < o_orderdate
  UNION ALL SELECT l_orderkey, 'needs_review', 'many_lines' FROM j WHERE n >= 7
  UNION ALL SELECT l_orderkey, 'needs_review', 'late_ship' FROM j WHERE date_diff('day', o_orderdate::DATE, z::DATE) > 2000)"""
_STATUS = _ISSUES + """, r AS (SELECT l_orderkey, count(*) AS n, bool_or(severity = 'hard_fail') AS hard, string_agg(DISTINCT issue_code, '|' ORDER BY issue_code) AS codes FROM i GROUP BY 1),
st AS (SELECT l_orderkey, CASE WHEN r.n IS NULL THEN 'pass' WHEN hard THEN 'hard_fail' ELSE 'needs_review' END AS status, coalesce(r.n, 0)::BIGINT AS n_issues, coalesce(codes, '') AS issue_codes
  FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN r USING (l_orderkey))"""
_LATEST = """WITH v AS (SELECT user_id AS doc_id, epoch_us(ts) AS reviewed_at, event_id AS id,
  CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'click' THEN 'edited' WHEN 'view' THEN 'rejected' ELSE 'skipped' END AS decision FROM events),
n AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY reviewed_at DESC, id DESC) = 1)"""

ORACLES = {
    "axis_ticks": f"{_TICKS} SELECT * FROM k",
    "axis_tick_filter": f"{_TICKS} SELECT l_orderkey, l_linenumber, v FROM t WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.l_orderkey = t.l_orderkey AND k.l_returnflag = t.l_returnflag)",
    "primary_state": f"{_F}, t AS (SELECT clip_id, ((min(start) + max(start)) // 2) AS target FROM f GROUP BY 1) SELECT clip_id, entity_id, value, start FROM f JOIN t USING (clip_id) QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY abs(start - target), ord) = 1",
    "majority_vote": f"{_F}, v AS (SELECT clip_id, entity_id, value, count(*) AS votes FROM f WHERE value IS NOT NULL GROUP BY ALL), r AS (SELECT *, (sum(votes) OVER (PARTITION BY clip_id, entity_id))::BIGINT AS rows FROM v QUALIFY row_number() OVER (PARTITION BY clip_id, entity_id ORDER BY votes DESC, value) = 1) SELECT * FROM r WHERE votes >= 2",
    "line_series": f"{_F} SELECT clip_id, entity_id, string_agg(value::VARCHAR, ',' ORDER BY start, ord) AS series, count(*) AS n_points FROM f GROUP BY 1, 2",
    "merge_rows": "WITH u AS (SELECT 0 AS src, c_custkey AS id, c_nationkey::BIGINT AS nation, floor(c_acctbal / 100)::BIGINT AS band FROM customer UNION ALL SELECT 1, s_suppkey, s_nationkey::BIGINT, floor(s_acctbal / 100)::BIGINT FROM supplier) SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY nation, band ORDER BY src, id) = 1",
    "missing_entities": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 100000)",
    "quality_issues": f"{_ISSUES} SELECT * FROM i",
    "quality_status": f"{_STATUS} SELECT * FROM st",
    "quality_queue": f"{_STATUS} SELECT status, issue_codes, count(*) AS clips, min(l_orderkey) AS first_clip FROM st GROUP BY 1, 2",
    "latest_review": f"{_LATEST} SELECT * FROM n",
    "review_routing": f"{_LATEST} SELECT d.doc_id, decision, CASE decision WHEN 'approved' THEN 'accepted' WHEN 'edited' THEN 'accepted' WHEN 'rejected' THEN 'excluded' ELSE 'unreviewed' END AS route FROM documents d LEFT JOIN n USING (doc_id)",
    "clip_index": "WITH k AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderkey) = 1), i AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS chart_index FROM k) SELECT o_orderkey, chart_index, trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '-', 'g'), '-') || '_' || chart_index AS output_stem FROM i",
    "clips_per_chart": "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= 50",
}
