"""Facts from rows that a model read off frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import infer_unit, numeric_value, slug
from .facts import FRAME, axis_tick_keys


def embeds_own_value(label: Column, value: Column) -> Column:
    """Whether a label starts with a number and unit and a colon, and that number is its value: a caption, not an entity."""
    head = F.trim(F.regexp_extract(label, r"^([^:]*):", 1))
    digits = F.regexp_replace(head, "[^0-9.]", "").try_cast("double")
    return head.rlike(r"^[0-9,.\s]+[A-Za-z%$€£¥]+$") & (F.abs(digits - value) < 1e-6)


def with_frames(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Rows (clip_id, ord, source_frame, time_seconds) with `frame`: the first of the clip's frames (clip_id, idx, source_frame, time_seconds, path) of that name or within 0.05 s, else the clip's first.

    Times meet by tenths of a second, so a row is held against the frames near it only.
    """
    shown = F.struct(F.col("source_frame").alias("frame_id"), "time_seconds", "path")
    at = frames.select("clip_id", "idx", "source_frame", "time_seconds", shown.alias("frame"))
    first = at.groupBy("clip_id").agg(F.min_by("frame", "idx").alias("__first"))
    named = rows.select("clip_id", "ord", "source_frame").join(at.select("clip_id", "source_frame", "idx", "frame"), ["clip_id", "source_frame"])
    slot = lambda c: F.floor(c * 10).cast("long")
    near = rows.select("clip_id", "ord", F.col("time_seconds").alias("__t"), F.explode(F.array_distinct(F.array(slot(F.col("time_seconds") - 0.05 - 1e-9), slot(F.col("time_seconds") + 0.05 + 1e-9)))).alias("__slot"))
    timed = near.join(at.withColumn("__slot", slot(F.col("time_seconds"))), ["clip_id", "__slot"]).where(F.abs(F.col("time_seconds") - F.col("__t")) <= 0.05)
    chosen = named.select("clip_id", "ord", "idx", "frame").unionByName(timed.select("clip_id", "ord", "idx", "frame")).groupBy("clip_id", "ord").agg(F.min_by("frame", "idx").alias("__frame"))
    met = rows.join(chosen, ["clip_id", "ord"], "left").join(first, "clip_id", "left")
    return met.withColumn("frame", F.coalesce("__frame", "__first")).drop("__frame", "__first")


def visual_facts(rows: DataFrame, charts: DataFrame | None = None) -> DataFrame:
    """Records of model rows (clip_id, ord, state, year, label, series, x, y, metric, value, unit, raw_text, evidence_text, source_frame, time_seconds, confidence[, frame]).

    charts, if given, has title, y_axis and unit by clip_id, which stand in
    for a row's metric and unit. Rows without a number, without a nameable
    entity, or whose label is a caption of its own value go; so do axis
    labels, which repeat for several entities of a frame. A missing or zero
    confidence counts as 0.8.
    """
    if charts is not None:
        rows = rows.join(charts.select("clip_id", F.col("title").alias("__title"), F.col("y_axis").alias("__y"), F.col("unit").alias("__unit")), "clip_id", "left")
    else:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("__title", "__y", "__unit")})
    if "frame" not in rows.columns:
        rows = rows.withColumn("frame", F.lit(None).cast(FRAME))
    number = numeric_value(F.col("value"))
    worded = lambda c: F.when(numeric_value(c).isNull(), F.nullif(c, F.lit("")))
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    stated = F.when(~F.col("state").rlike(r"^\s*[0-9]{4}\s*$"), some("state"))
    beside = F.when(~F.coalesce(F.col("state").eqNullSafe(F.col("label")) | F.col("state").eqNullSafe(F.col("series")) | F.col("state").eqNullSafe(F.col("x")), F.lit(False)), some("state"))
    named = F.coalesce(some("label"), some("series"), some("x"), some("state"))
    proof = F.coalesce(some("evidence_text"), some("raw_text"), F.col("value"))
    time = F.coalesce(F.col("frame.time_seconds"), F.when(F.col("frame").isNull(), F.col("time_seconds")))
    made = rows.select(
        "clip_id", "ord", F.coalesce(F.col("year").cast("string"), beside).alias("state_key"), F.coalesce(F.col("year").cast("string"), beside).alias("state_label"),
        slug(F.coalesce(some("label"), some("series"), some("x"), stated)).alias("entity_id"), named.alias("entity"),
        F.coalesce(worded(F.col("metric")), worded(F.col("y")), worded(F.coalesce(some("__y"), some("__title"))), worded(F.col("series")), F.lit("value")).alias("metric"), number.alias("value"),
        F.coalesce(some("unit"), infer_unit(F.col("value"), proof, F.col("__unit"))).alias("unit"), time.alias("state_start"), time.alias("state_end"), F.lit("visual").alias("source_type"),
        F.array_compact(F.array("frame")).alias("evidence_frames"), F.lit(None).cast("string").alias("evidence_sentence_id"),
        F.coalesce(F.nullif("confidence", F.lit(0.0)), F.lit(0.8)).alias("confidence"), F.lit("machine").alias("review_status"), "raw_text", proof.alias("evidence_text"), F.lit("exact").alias("value_type"),
    ).where("value IS NOT NULL AND entity_id <> 'unknown'")
    kept = made.where(~F.coalesce(embeds_own_value(F.col("entity"), F.col("value")), F.lit(False)))
    at = kept.withColumn("__frame", F.struct("clip_id", "state_start"))
    return at.join(axis_tick_keys(at, "__frame", "entity_id", "value"), ["__frame", "entity_id"], "left_anti").select(*kept.columns)
