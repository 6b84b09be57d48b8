"""Queries over charts told from states, and over clips as their reviews leave them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts, metadata, reviewed
from ..stages import kept
from .adapters import clip_records, micros, read
from .record_queries import STATES_SQL


def _charts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """States of users' events, days as years and every third one of another metric; and lines of text, an event each."""
    states = facts.with_state_ids(facts.merge_states(clip_records(spark, d)))
    p = F.col("place")
    metric = F.when(F.col("clip_id") % 5 == 0, F.when(p % 3 == 0, "Click").otherwise("")).when(p % 3 == 0, "price").otherwise("Share of visits")
    year = F.concat(F.lit("20"), F.substring("state_key", -2, 2))
    states = states.withColumns({"metric": metric, "state_key": F.when(F.col("clip_id") % 3 > 0, year), "unit": F.when(F.col("clip_id") % 4 == 0, F.col("unit"))})
    n = F.col("event_id")
    line = F.concat("event_type", F.lit(" in 20"), F.substring(F.concat(F.lit("0"), (micros("ts") / 86_400_000_000).cast("long").cast("string")), -2, 2), F.when(n % 50 == 0, " %").otherwise(""))
    return states, read(spark, d, "events").where("event_type <> 'view'").select(F.col("user_id").alias("clip_id"), n.alias("ord"), line.alias("line"))


def chart_metadata(spark: SparkSession, d: str) -> DataFrame:
    states, lines = _charts(spark, d)
    charts, _ = metadata.chart_metadata(kept(states), lines)
    return charts


def chart_marks(spark: SparkSession, d: str) -> DataFrame:
    states, _ = _charts(spark, d)
    return metadata.shown_marks(kept(states)).drop("clip_metric")


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Documents as clips, and labels as reviews of them, whose reviewed values are JSON; some aren't sound."""
    k, source = F.col("doc_id"), F.col("source")
    status = F.when(k % 3 > 0, "provisional")
    clips = read(spark, d, "documents").select(k.alias("clip_id"), F.create_map(F.lit("source"), source, F.lit("lang"), "lang").alias("fields"), status.alias("narration_status"))
    row = lambda label, value, note: F.struct(label.alias("label"), value.alias("value"), note.alias("_note"))
    none = F.lit(None).cast("string")
    value = F.struct(
        F.struct(F.when(k % 2 == 0, F.concat(F.lit("https://"), k.cast("string"))).alias("source"), (k * 2).alias("seconds"), F.lit("other").alias("clip_id")).alias("clip"),
        F.struct(F.when(k % 5 == 0, "").when(k % 5 == 1, "final").alias("status"), F.when(k % 4 > 0, F.concat(F.lit('said "'), k.cast("string"), F.lit('"'))).alias("full_text")).alias("narration"),
        F.when(k % 7 > 0, F.struct(F.concat(F.lit("moves "), k.cast("string")).alias("overall_description"), F.when(k % 3 > 0, F.transform(F.sequence(F.lit(1), k % 3), lambda i: F.struct(F.lit("bar_grow").alias("action"), i.alias("order")))).alias("major_actions"))).alias("animation"),
        F.when(k % 6 > 0, F.array(row(F.lit("a"), (k % 9).cast("string"), none), row(none, F.lit(""), F.lit("x")), row(F.concat(F.lit("b"), k.cast("string")), none, none))).alias("chart_data"),
    )
    text = F.when(k % 11 == 0, '{"clip": ').otherwise(F.to_json(value))
    decision = F.when(F.col("quality") == 1, F.when(k % 13 == 0, "saved").otherwise("approved")).when(F.col("toxic") == 1, "excluded").when(k % 2 == 0, "needs_revision").otherwise("skipped")
    reviews = read(spark, d, "labels").select(k.alias("clip_id"), (k + 1).alias("id"), decision.alias("decision"), text.alias("reviewed_value"), F.lit("r").alias("reviewer"), F.lit(None).cast("timestamp").alias("reviewed_at"), none.alias("notes"))
    return reviewed.judged(clips, reviews)


def judged_clips(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("clip_id", "route", "reason", "review_id")


def reviewed_clips(spark: SparkSession, d: str) -> DataFrame:
    found = reviewed.overlaid(_judged(spark, d))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("fields")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("~")))), ",")
    return found.select("clip_id", shown.alias("fields"), "review_decision", "review_id", F.col("animation_action_count").cast("long").alias("animation_action_count"), "animation_description", "narration_status", "narration_text")


def corrected_rows(spark: SparkSession, d: str) -> DataFrame:
    """A row of each document as its own values, and the reviewed ones in their place."""
    own = read(spark, d, "documents").select(F.col("doc_id").alias("clip_id"), F.lit(0).alias("ord"), F.create_map(F.lit("label"), F.lit("own"), F.lit("value"), F.col("n_chars").cast("string")).alias("row"))
    rows = reviewed.corrected(own, _judged(spark, d))
    return rows.select("clip_id", F.col("ord").cast("long").alias("ord"), F.col("row")["label"].alias("label"), F.col("row")["value"].alias("value"))


QUERIES = {f.__name__: f for f in (chart_metadata, chart_marks, judged_clips, reviewed_clips, corrected_rows)}

_SLUG = "coalesce(nullif(trim(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'item')"
_MARKS = f"""{STATES_SQL}, a0 AS (SELECT clip_id, place, entity_id, entity AS name, value, CASE WHEN clip_id % 4 = 0 THEN unit END AS unit, state_id, CASE WHEN clip_id % 3 > 0 THEN '20' || right(state_key, 2) END AS key, state_label, source_type = 'visual_frame_align' AS seen, coalesce(confidence, 0) AS sure,
  CASE WHEN clip_id % 5 = 0 THEN CASE WHEN place % 3 = 0 THEN 'Click' ELSE '' END WHEN place % 3 = 0 THEN 'price' ELSE 'Share of visits' END AS metric FROM st WHERE value IS NOT NULL),
a1 AS (SELECT *, CASE WHEN coalesce(bool_or(key IS NOT NULL) OVER (PARTITION BY clip_id ORDER BY place), false) THEN coalesce(key, state_label, state_id) ELSE 'state' END AS moment, {_SLUG.format('name')} AS mark, last_value(nullif(metric, '') IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS clip_metric FROM a0),
a2 AS (SELECT clip_id, moment FROM (SELECT clip_id, moment, bool_or(seen) AS s, count(*) AS c, min(place) AS f FROM a1 GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY s DESC, c DESC, f) = 1),
a3 AS (SELECT *, bool_or(seen) OVER (PARTITION BY clip_id) AS anyseen, bool_or(seen) OVER (PARTITION BY clip_id, mark) AS named FROM a1 JOIN a2 USING (clip_id, moment)),
a4 AS (SELECT *, min(place) OVER (PARTITION BY clip_id, mark, metric) AS head FROM a3 WHERE mark <> 'unknown' AND (named OR NOT anyseen) QUALIFY row_number() OVER (PARTITION BY clip_id, mark, metric ORDER BY seen DESC, sure DESC, place) = 1),
a5 AS (SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY head) AS n, name, entity_id, metric, value, unit, moment, clip_metric, mark FROM a4)"""
_JUDGED = """WITH j AS (SELECT d.doc_id AS clip_id, d.source, d.lang, d.n_chars, l.doc_id + 1 AS review_id, CASE WHEN l.doc_id IS NULL THEN NULL WHEN quality = 1 THEN CASE WHEN d.doc_id % 13 = 0 THEN 'saved' ELSE 'approved' END WHEN toxic = 1 THEN 'excluded' WHEN d.doc_id % 2 = 0 THEN 'needs_revision' ELSE 'skipped' END AS decision,
  d.doc_id % 11 > 0 AS sound FROM documents d LEFT JOIN labels l USING (doc_id)), ok AS (SELECT *, clip_id AS k FROM j WHERE decision = 'approved')"""

ORACLES = {
    "chart_marks": f"{_MARKS} SELECT * EXCLUDE (clip_metric, mark) FROM a5",
    "chart_metadata": f"""{_MARKS}, h AS (SELECT clip_id, min_by(unit, n) FILTER (WHERE unit <> '') AS unit, any_value(moment) AS moment, count(*) AS n_marks, CASE WHEN bool_or(mark = {_SLUG.format("coalesce(clip_metric, 'Value')")}) THEN 'Value' ELSE coalesce(any_value(clip_metric), 'Value') END AS y_axis FROM a5 GROUP BY 1),
li AS (SELECT user_id AS clip_id, event_id, event_type || ' in 20' || right('0' || (epoch_us(ts) // 86400000000), 2) || CASE WHEN event_id % 50 = 0 THEN ' %' ELSE '' END AS line FROM events WHERE event_type <> 'view'),
s AS (SELECT clip_id, arg_max(line, (length(line), -event_id)) FILTER (WHERE length(line) > 15) AS longest, bool_or(line LIKE '%\\%%' ESCAPE '\\') AS pct, bool_or(regexp_matches(moment, '^[0-9]{{2,4}}$') AND contains(regexp_replace(line, '[^a-z0-9]', '', 'g'), moment)) AS dated FROM h JOIN li USING (clip_id) GROUP BY 1)
SELECT clip_id, coalesce(CASE WHEN lower(y_axis) IN ('value', 'price') THEN longest END, y_axis) || CASE WHEN dated THEN ' (' || moment || ')' ELSE '' END AS title, coalesce(h.unit, CASE WHEN pct THEN '%' END, '') AS unit, y_axis, moment, n_marks FROM h LEFT JOIN s USING (clip_id)""",
    "judged_clips": f"""{_JUDGED} SELECT clip_id, CASE decision WHEN 'approved' THEN 'accepted' WHEN 'excluded' THEN 'excluded' ELSE 'unreviewed' END AS route,
  CASE WHEN decision IS NULL THEN 'no_asset_review' WHEN decision IN ('saved', 'needs_revision') THEN 'blocking_decision:' || decision WHEN decision = 'skipped' THEN 'unsupported_decision:skipped' END AS reason, review_id FROM j""",
    "reviewed_clips": f"""{_JUDGED} SELECT clip_id, 'lang=' || coalesce(lang, '~') || CASE WHEN sound THEN ',seconds=' || 2 * k ELSE '' END || ',source=' || CASE WHEN sound AND k % 2 = 0 THEN 'https://' || k ELSE coalesce(source, '~') END AS fields, decision AS review_decision, review_id,
  CASE WHEN sound AND k % 7 > 0 THEN k % 3 ELSE 0 END AS animation_action_count, CASE WHEN sound AND k % 7 > 0 THEN 'moves ' || k END AS animation_description,
  CASE WHEN sound AND k % 5 = 1 THEN 'final' WHEN k % 3 > 0 THEN 'provisional' END AS narration_status, CASE WHEN sound AND k % 4 > 0 THEN 'said "' || k || '"' ELSE '' END AS narration_text FROM ok""",
    "corrected_rows": f"""{_JUDGED} SELECT clip_id, 0::BIGINT AS ord, 'own' AS label, n_chars::VARCHAR AS value FROM ok WHERE NOT sound OR k % 6 = 0
  UNION ALL SELECT clip_id, 0, 'a', (k % 9)::VARCHAR FROM ok WHERE sound AND k % 6 > 0 UNION ALL SELECT clip_id, 2, 'b' || k, NULL FROM ok WHERE sound AND k % 6 > 0""",
}
