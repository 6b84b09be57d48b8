"""Queries over what models read off frames, and over issues between artifacts and of a model's review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyframes, models, quality, visual
from ..operators.ordering import first_rows
from .adapters import read


def visual_records(spark: SparkSession, d: str) -> DataFrame:
    """Lines of orders as rows read off two frames each: captions, rows without a name or a number, percentages, years."""
    k, n, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity").cast("long")
    none = F.lit(None).cast("string")
    label = F.when(k % 11 == 0, none).when(k % 13 == 0, F.concat(q.cast("string"), F.lit(" M: total"))).otherwise(F.concat(F.lit("Supplier "), (F.col("l_suppkey") % 6).cast("string")))
    value = F.when(n == 6, "not shown").when(k % 2 == 0, F.concat((q % 4).cast("string"), F.lit("%"))).otherwise(F.concat(F.lit("$"), q.cast("string")))
    rows = read(spark, d, "lineitem").select(
        k.alias("clip_id"), n.cast("long").alias("ord"), F.when(k % 3 == 0, F.concat(F.lit("S"), n.cast("string"))).alias("state"), F.when(n == 1, F.year("l_shipdate")).alias("year"), label.alias("label"),
        F.when(n % 2 == 0, F.col("l_returnflag")).alias("series"), none.alias("x"), none.alias("y"), F.when(k % 5 == 0, "12").when(k % 5 == 1, "share").alias("metric"), value.alias("value"), F.when(n == 3, "km").alias("unit"),
        none.alias("raw_text"), none.alias("evidence_text"), none.alias("source_frame"), (n % 2).cast("double").alias("time_seconds"), (n % 4 / 10).alias("confidence"),
    )
    charts = read(spark, d, "orders").select(F.col("o_orderkey").alias("clip_id"), F.lit("Orders").alias("title"), F.when(F.col("o_orderkey") % 7 == 0, "Cost").alias("y_axis"), none.alias("unit"))
    return visual.visual_facts(rows, charts).select("clip_id", "ord", "state_key", "entity_id", "entity", "metric", "value", "unit", "state_start", "confidence", "evidence_text")


def _drawings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """States of orders by their lines, and drawings of orders and states, some missing, unreadable or incomplete."""
    lines = read(spark, d, "lineitem")
    states = lines.select(F.col("l_orderkey").alias("clip_id"), F.concat(F.lit("s"), (F.col("l_linenumber") % 3).cast("string")).alias("state_id"), F.col("l_returnflag").alias("entity_id"), F.when(F.col("l_orderkey") % 4 == 0, "share").otherwise("value").alias("metric"))
    k = F.col("clip_id")
    of_state = states.select("clip_id", "state_id").distinct()
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("clip_id"), F.lit(None).cast("string").alias("state_id")).unionByName(of_state)
    m = k + F.coalesce(F.length("state_id"), F.lit(0)) + F.coalesce(F.ascii(F.substring("state_id", 2, 1)), F.lit(0))
    svgs = rows.select(
        "clip_id", "state_id", F.concat_ws("-", k.cast("string"), "state_id").alias("path"), (m % 7 != 0).alias("found"), F.when(m % 5 != 0, F.array(F.lit("entity-N"), F.lit("axis"))).alias("ids"),
        F.when(m % 3 == 0, F.array(F.lit("A"), F.lit("R"))).alias("entities"), F.when(m % 2 == 0, F.array(F.lit("bar"))).alias("roles"),
    )
    return states, svgs


def _answers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.when(k % 9 == 0, "failed").when(k % 9 == 1, "unavailable").when(k % 9 == 2, "interface_missing").otherwise("ok")
    result = F.when(k % 4 != 0, F.struct((k % 3 == 0).alias("needs_review"), F.when(k % 5 == 0, "hard_fail").when(k % 5 == 1, "").alias("severity"), F.when(k % 2 == 0, F.array(F.lit("blurred"), F.lit("cropped"))).alias("issue_codes")))
    return read(spark, d, "orders").select(k.alias("clip_id"), status.alias("model_status"), result.alias("result"))


def cross_issues(spark: SparkSession, d: str) -> DataFrame:
    return quality.cross_issues(*_drawings(spark, d)).drop("layer")


def model_issues(spark: SparkSession, d: str) -> DataFrame:
    return quality.model_issues(_answers(spark, d)).drop("artifact", "layer")


def layered_status(spark: SparkSession, d: str) -> DataFrame:
    """The status of each order over both layers."""
    issues = quality.all_issues(quality.cross_issues(*_drawings(spark, d)), quality.model_issues(_answers(spark, d)))
    return quality.status(read(spark, d, "orders").select(F.col("o_orderkey").alias("clip_id")), issues, "clip_id")


def merged_charts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as charts that each line is a reading of, with a row of its own."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    none = F.lit(None).cast("string")
    lines = read(spark, d, "lineitem").select("*", k.alias("clip_id"), (n - 1 + F.when(k % 10 == 0, 1).otherwise(0)).alias("source"))
    part = lambda m, name: F.when((F.col("l_suppkey") + n) % m == 0, F.concat(F.lit(name), n.cast("string"))).when(n % 2 == 0, "")
    readings = lines.select("clip_id", "source", part(2, "T").alias("title"), part(3, "U").alias("unit"), part(5, "X").alias("x_axis"), part(7, "Y").alias("y_axis"), (k % 6 == 0).alias("temporal_change"), F.lit(None).cast("boolean").alias("needs_manual_data"), F.when(n == 4, 2).otherwise(0).alias("n_manual"))
    rows = lines.where("l_linenumber % 4 <> 1 OR l_orderkey % 3 = 0").select(
        "clip_id", "source", F.lit(0).alias("ord"), F.when(n % 3 == 0, F.year("l_shipdate").cast("string")).alias("year"), F.when(F.col("l_linestatus") == "F", "").otherwise(none).alias("state"), F.col("l_returnflag").alias("label"),
        *[none.alias(c) for c in ("series", "x", "y", "value", "unit", "raw_text", "source_frame", "time_seconds")],
    )
    return models.merged_charts(readings, rows, "clip_id")


def keyframe_rank(spark: SparkSession, d: str) -> DataFrame:
    """The best line of each order as a scored frame."""
    n, q, p = F.col("l_linenumber"), F.col("l_quantity").cast("long"), F.col("l_suppkey")
    frames = read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (q % 3 > 0).alias("target"), F.when(q % 5 > 0, q % 5 == 1).alias("scene_change"), (p % 2 == 0).alias("complete"), (p % 3 == 0).alias("cropped"), (q % 2 == 0).alias("final"), (q % 4 / 2).alias("completeness"), F.when(p % 4 > 0, p % 4 / 4).alias("finality"),
        (n % 2 == 0).alias("readable"), n.cast("double").alias("timestamp"), F.when(F.col("l_orderkey") % 9 > 0, 8.0).otherwise(0.0).alias("duration"), F.col("l_discount").alias("combined"), F.when(F.col("l_orderkey") % 2 == 0, "Bar").otherwise("map").alias("chart_type"),
    )
    return first_rows(frames, ["l_orderkey"], [*keyframes.best_first(F.col("chart_type")), F.col("l_linenumber")]).select("l_orderkey", "l_linenumber")


QUERIES = {f.__name__: f for f in (visual_records, cross_issues, model_issues, layered_status, merged_charts, keyframe_rank)}

_CROSS = """WITH s AS (SELECT l_orderkey AS clip_id, 's' || (l_linenumber % 3) AS state_id, l_returnflag AS entity_id, CASE WHEN l_orderkey % 4 = 0 THEN 'share' ELSE 'value' END AS metric FROM lineitem),
v AS (SELECT *, CASE WHEN state_id IS NULL THEN clip_id::VARCHAR ELSE clip_id || '-' || state_id END AS path, clip_id + coalesce(length(state_id) + ascii(state_id[2]), 0) AS m FROM (SELECT o_orderkey AS clip_id, NULL::VARCHAR AS state_id FROM orders UNION ALL SELECT DISTINCT clip_id, state_id FROM s)),
d AS (SELECT *, m % 7 <> 0 AS found, m % 5 = 0 AS unread, list_concat(CASE WHEN m % 3 = 0 THEN ['A', 'R'] ELSE [] END, CASE WHEN m % 5 <> 0 THEN ['N'] ELSE [] END) AS drawn FROM v),
c AS (SELECT clip_id, list(DISTINCT entity_id) AS held, bool_or(metric <> 'value') AS measured FROM s GROUP BY 1), t AS (SELECT clip_id, state_id, list(DISTINCT entity_id) AS held FROM s GROUP BY 1, 2),
a AS (SELECT d.*, c.held, c.measured FROM d JOIN c USING (clip_id) WHERE state_id IS NULL AND found), b AS (SELECT d.*, t.held FROM d JOIN t USING (clip_id, state_id)),
i AS (SELECT clip_id, 'hard_fail' AS severity, 'invalid_semantic_svg' AS issue_code, path AS artifact FROM a WHERE unread
  UNION ALL SELECT clip_id, 'needs_review', 'semantic_missing_bar_role', path FROM a WHERE NOT unread AND measured AND m % 2 <> 0
  UNION ALL SELECT clip_id, 'needs_review', 'data_entity_missing_in_semantic', path FROM a WHERE NOT unread AND NOT list_has_all(drawn, held)
  UNION ALL SELECT clip_id, 'needs_review', 'missing_state_semantic_svg', path FROM b WHERE NOT found
  UNION ALL SELECT clip_id, 'hard_fail', 'invalid_state_semantic_svg', path FROM b WHERE found AND unread
  UNION ALL SELECT clip_id, 'needs_review', 'state_data_entity_missing_in_semantic', path FROM b WHERE found AND NOT unread AND NOT list_has_all(drawn, held))"""
_MODEL = """SELECT o_orderkey AS clip_id, CASE WHEN k < 3 THEN 'needs_review' WHEN o_orderkey % 4 <> 0 AND o_orderkey % 5 = 0 THEN 'hard_fail' ELSE 'needs_review' END AS severity,
  unnest(CASE WHEN k < 3 THEN [['qc_vlm_failed', 'qc_vlm_unavailable', 'qc_vlm_interface_missing'][k + 1]] WHEN o_orderkey % 4 = 0 THEN ['qc_vlm_bad_response'] WHEN o_orderkey % 3 <> 0 THEN [] WHEN o_orderkey % 2 = 0 THEN ['blurred', 'cropped'] ELSE ['qc_vlm_flagged'] END) AS issue_code FROM (SELECT *, o_orderkey % 9 AS k FROM orders)"""

ORACLES = {
    "visual_records": """WITH r AS (SELECT l_orderkey AS clip_id, l_linenumber::BIGINT AS ord, CASE WHEN l_orderkey % 3 = 0 THEN 'S' || l_linenumber END AS state, CASE WHEN l_linenumber = 1 THEN year(l_shipdate) END AS year,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN l_quantity::BIGINT || ' M: total' ELSE 'Supplier ' || (l_suppkey % 6) END AS label, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS series,
  CASE WHEN l_orderkey % 5 = 1 THEN 'share' END AS metric, CASE WHEN l_linenumber = 6 THEN NULL WHEN l_orderkey % 2 = 0 THEN l_quantity::BIGINT % 4 ELSE l_quantity::BIGINT END AS v, CASE WHEN l_orderkey % 2 = 0 THEN (l_quantity::BIGINT % 4) || '%' ELSE '$' || l_quantity::BIGINT END AS text,
  (l_linenumber % 2)::DOUBLE AS tm, l_linenumber % 4 / 10.0::DOUBLE AS sure, l_quantity::BIGINT AS q FROM lineitem),
m AS (SELECT clip_id, ord, coalesce(year::VARCHAR, state) AS state_key, coalesce(label, series, state) AS entity, CASE WHEN metric IS NOT NULL THEN metric WHEN clip_id % 7 = 0 THEN 'Cost' ELSE 'Orders' END AS metric, v::DOUBLE AS value,
  CASE WHEN ord = 3 THEN 'km' WHEN clip_id % 2 = 0 THEN '%' ELSE '$' END AS unit, tm AS state_start, CASE WHEN sure = 0 THEN 0.8 ELSE sure END::DOUBLE AS confidence, text AS evidence_text, label IS NOT NULL AND clip_id % 11 <> 0 AND clip_id % 13 = 0 AND q = v AS caption FROM r WHERE v IS NOT NULL),
k AS (SELECT *, trim(regexp_replace(lower(entity), '[^a-z0-9]+', '-', 'g'), '-') AS entity_id FROM m WHERE entity IS NOT NULL AND NOT caption),
s AS (SELECT clip_id, state_start, entity_id, list_sort(list(DISTINCT value)) AS vs FROM k GROUP BY ALL), x AS (SELECT *, count(*) OVER (PARTITION BY clip_id, state_start, vs) AS same FROM s WHERE len(vs) > 1)
SELECT clip_id, ord, state_key, entity_id, entity, metric, value, unit, state_start, confidence, evidence_text FROM k WHERE NOT EXISTS (SELECT 1 FROM x WHERE same > 1 AND x.clip_id = k.clip_id AND x.state_start = k.state_start AND x.entity_id = k.entity_id)""",
    "merged_charts": """WITH l AS (SELECT *, l_orderkey AS clip_id, l_linenumber - 1 + (l_orderkey % 10 = 0)::INTEGER AS source FROM lineitem),
g AS (SELECT *, CASE WHEN (l_suppkey + l_linenumber) % 2 = 0 THEN 'T' || l_linenumber END AS title, CASE WHEN (l_suppkey + l_linenumber) % 3 = 0 THEN 'U' || l_linenumber END AS u, CASE WHEN (l_suppkey + l_linenumber) % 5 = 0 THEN 'X' || l_linenumber END AS x, CASE WHEN (l_suppkey + l_linenumber) % 7 = 0 THEN 'Y' || l_linenumber END AS y FROM l),
t AS (SELECT clip_id, arg_min(title, source) FILTER (WHERE title IS NOT NULL) AS title, arg_min(u, source) FILTER (WHERE u IS NOT NULL) AS unit, arg_min(x, source) FILTER (WHERE x IS NOT NULL) AS x_axis, arg_min(y, source) FILTER (WHERE y IS NOT NULL) AS y_axis, max(l_linenumber) >= 4 AND bool_or(l_linenumber = 4) AS manual FROM g GROUP BY 1 HAVING bool_or(source = 0)),
r AS (SELECT clip_id, source, CASE WHEN l_linenumber % 3 = 0 THEN year(l_shipdate)::VARCHAR END AS year, CASE WHEN l_linestatus = 'F' THEN '' END AS state, l_returnflag AS label FROM l WHERE l_linenumber % 4 <> 1 OR l_orderkey % 3 = 0),
k AS (SELECT * FROM r QUALIFY source = 0 OR row_number() OVER (PARTITION BY clip_id, year, state, label ORDER BY source) = 1),
h AS (SELECT clip_id, count(*) AS n, count(DISTINCT CASE WHEN year <> '' OR state <> '' THEN coalesce(year, '~') || '|' || coalesce(state, '~') END) AS pairs FROM k GROUP BY 1)
SELECT clip_id, title, unit, x_axis, y_axis, coalesce(n, 0)::BIGINT AS n_rows, coalesce(n, 0) > 0 AS has_extractable_data, manual AS needs_manual_data, clip_id % 6 = 0 OR coalesce(pairs, 0) > 1 AS temporal_change FROM t LEFT JOIN h USING (clip_id)""",
    "keyframe_rank": """SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity::BIGINT % 3 > 0 DESC, l_quantity::BIGINT % 5 <> 1 DESC, l_suppkey % 2 = 0 DESC, l_suppkey % 3 <> 0 DESC, l_quantity::BIGINT % 2 = 0 DESC,
  least(l_quantity::BIGINT % 4 / 2, 1) DESC, l_suppkey % 4 / 4 DESC, l_linenumber % 2 = 0 DESC, CASE WHEN l_orderkey % 2 = 0 AND l_orderkey % 9 > 0 THEN l_linenumber / 8 ELSE 0 END DESC, l_discount DESC, l_linenumber) = 1""",
    "cross_issues": f"{_CROSS} SELECT * FROM i",
    "model_issues": _MODEL,
    "layered_status": f"""{_CROSS}, al AS (SELECT clip_id, severity, issue_code FROM i UNION ALL SELECT * FROM ({_MODEL})), r AS (SELECT clip_id, count(*) AS n, bool_or(severity = 'hard_fail') AS hard, string_agg(DISTINCT issue_code, '|' ORDER BY issue_code) AS codes FROM al GROUP BY 1)
SELECT o_orderkey AS clip_id, CASE WHEN n IS NULL THEN 'pass' WHEN hard THEN 'hard_fail' ELSE 'needs_review' END AS status, coalesce(n, 0)::BIGINT AS n_issues, coalesce(codes, '') AS issue_codes FROM orders LEFT JOIN r ON clip_id = o_orderkey""",
}
