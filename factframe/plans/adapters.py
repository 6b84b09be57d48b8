"""The engine's tables from the test tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Records a task takes: they are wide, and a task sorts them several times.
RECORDS_A_TASK = 50_000


def parts(rows: DataFrame, per_task: int = RECORDS_A_TASK) -> int:
    """Partitions in which a task has so many rows, whatever their number; rows should be cheap to count."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / per_task))


def micros(column: str):  # noqa: ANN201
    return F.unix_micros(F.col(column).cast("timestamp"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as facts: a clip a user, an entity an event type, a tenth of the value, whole."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("clip_id"), F.col("event_id").alias("ord"), F.col("event_type").alias("entity_id"), F.lit("value").alias("metric"),
        F.floor(F.col("value") / 10).cast("long").alias("value"), micros("ts").alias("start"),
    )


FACTS_SQL = "SELECT user_id AS clip_id, event_id AS ord, event_type AS entity_id, 'value' AS metric, floor(value / 10)::BIGINT AS value, epoch_us(ts) AS start FROM events"


_HOUR, _DAY = 3600.0, 86_400_000_000


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as whole records, some without a value, start, end, unit or state key; every third one narrated, some from both sources or read off a frame."""
    n = F.col("event_id")
    start = F.when(n % 53 != 0, micros("ts").cast("double") / 1e6)
    none = F.lit(None).cast("string")
    frame = F.struct(F.concat(F.lit("f"), n.cast("string")).alias("frame_id"), start.alias("time_seconds"), none.alias("path"))
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("clip_id"), n.alias("ord"), F.when(n % 2 == 0, F.concat(F.lit("d"), F.floor(micros("ts") / _DAY).cast("string"))).alias("state_key"), none.alias("state_label"),
        F.col("event_type").alias("entity_id"), F.upper("event_type").alias("entity"), F.lit("value").alias("metric"), F.when(n % 11 != 0, F.floor(F.col("value") / 100).cast("double")).alias("value"),
        F.when(n % 5 == 0, "%").otherwise("").alias("unit"), start.alias("state_start"), F.when(n % 13 != 0, start + n % 4 * _HOUR).alias("state_end"),
        F.when(n % 17 == 0, "visual_frame_align").when(n % 19 == 0, "both").when(n % 3 == 0, "narration").otherwise("visual").alias("source_type"),
        F.when(n % 3 != 0, F.array(frame)).otherwise(F.slice(F.array(frame), 1, 0)).alias("evidence_frames"), F.when(n % 3 == 0, n.cast("string")).alias("evidence_sentence_id"), (n % 10 / 10).alias("confidence"),
        F.lit("machine").alias("review_status"), none.alias("raw_text"), none.alias("evidence_text"), F.when(n % 7 == 0, "estimated").otherwise("exact").alias("value_type"),
    )


def clip_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records() dealt out by clip, so that windows and groups of a clip, or of its entities, follow without another shuffle.

    Partitions are as many as the records need: left to itself, Spark makes
    them by compressed bytes, of which a task's memory is a multiple.
    """
    return records(spark, sf_dir).repartition(parts(read(spark, sf_dir, "events")), "clip_id")


RECORDS_SQL = f"""SELECT *, CASE WHEN ord % 13 <> 0 THEN state_start + ord % 4 * 3600 END AS state_end FROM (SELECT user_id AS clip_id, event_id AS ord, CASE WHEN event_id % 2 = 0 THEN 'd' || (epoch_us(ts) // {_DAY}) END AS state_key, event_type AS entity_id, upper(event_type) AS entity,
  CASE WHEN event_id % 11 <> 0 THEN floor(value / 100)::DOUBLE END AS value, CASE WHEN event_id % 5 = 0 THEN '%' ELSE '' END AS unit, CASE WHEN event_id % 53 <> 0 THEN epoch_us(ts)::DOUBLE / 1e6 END AS state_start,
  CASE WHEN event_id % 17 = 0 THEN 'visual_frame_align' WHEN event_id % 19 = 0 THEN 'both' WHEN event_id % 3 = 0 THEN 'narration' ELSE 'visual' END AS source_type, (event_id % 3 <> 0)::BIGINT AS n_frames, CASE WHEN event_id % 3 = 0 THEN event_id::VARCHAR END AS evidence_sentence_id,
  event_id % 10 / 10.0::DOUBLE AS confidence, 'machine' AS review_status, CASE WHEN event_id % 7 = 0 THEN 'estimated' ELSE 'exact' END AS value_type FROM events)"""
