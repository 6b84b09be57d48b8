"""The engine's commands over folders of tables: context, assets, quality, reviewed."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import facts as op
from .operators import narration, quality
from .operators import reviewed as overlay
from .operators.visual import visual_facts, with_frames
from .sources import config, tables


def _write(df: DataFrame, cfg: dict, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{cfg['out']}/{name}")


def _read(spark: SparkSession, cfg: dict, name: str) -> DataFrame:
    return spark.read.parquet(f"{cfg['out']}/{name}")


def context(spark: SparkSession, cfg: dict) -> None:
    """Clips from annotations, and the padded source interval of each."""
    clips = tables.clip_source(spark, cfg.get("clips"), cfg.get("clips_jsonl"), cfg.get("clip_id"), cfg.get("limit"))
    _write(clips, cfg, "clips")
    pad = cfg.get("padding", {})
    a, z = narration.padded(F.col("start_seconds"), F.col("end_seconds"), pad.get("before", 5.0), pad.get("after", 5.0))
    shown = F.struct(F.round(F.col("start_seconds") - a, 3).alias("start"), F.round(F.col("end_seconds") - a, 3).alias("end"))
    _write(clips.select("clip_id", F.struct("start_seconds", "end_seconds").alias("reference_source"), F.struct(a.alias("start"), z.alias("end")).alias("context_source"), shown.alias("visual_clip_context")), cfg, "intervals")


def assets(spark: SparkSession, cfg: dict) -> None:
    """Facts from frames and narration, fused; their states, changes, final values, flags and keyframe plan.

    Of the inputs only visual_rows has to be there.
    """
    given = lambda name, schema: tables.read_or_empty(spark, cfg[name], schema) if cfg.get(name) else spark.createDataFrame([], schema)
    charts, frames = given("charts", tables.CHARTS), given("frames", tables.FRAMES)
    rows = spark.read.schema(tables.VISUAL_ROWS).json(cfg["visual_rows"])
    seen = visual_facts(with_frames(rows, frames), charts)
    sentences = given("sentences", tables.SENTENCES)
    told = charts.join(rows.select("clip_id").union(sentences.select("clip_id")).distinct(), "clip_id", "right")
    aliases = narration.chart_aliases(given("labels", tables.LABELS), told.select("clip_id", F.concat_ws(" ", "title", "y_axis", "text").alias("text")))
    said = narration.narration_facts(sentences, aliases, given("windows", tables.WINDOWS), frames)
    fused = op.fuse(seen, said).withColumn("metric", op.sanitised_metric(F.col("metric")))
    _write(fused, cfg, "facts")
    _write(op.with_state_ids(op.merge_states(_read(spark, cfg, "facts").drop("conflict_with"))), cfg, "states")
    states = _read(spark, cfg, "states")
    _write(op.change_events(states), cfg, "change_events")
    _write(op.final_table(states), cfg, "final_table")
    _write(op.summary(states), cfg, "summary")
    clips = _read(spark, cfg, "summary").join(charts.select("clip_id", "chart_type"), "clip_id", "left")
    plans, planned = op.plan_states(states, clips, cfg.get("max_states", 8))
    _write(plans, cfg, "state_plan")
    _write(planned, cfg, "state_keyframes")
    _write(op.reconciled(clips.select("clip_id", "chart_type"), states), cfg, "intent")


def check(spark: SparkSession, cfg: dict) -> None:
    """Rule issues of each clip, those between its artifacts, those of a model's review, and its status.

    artifacts: (clip_id, files, bad_json, extractable, svgs, n_csv, n_final,
    n_event_csv); drawings and answers are as quality's layers take them.
    """
    clips = _read(spark, cfg, "clips").select("clip_id")
    states, facts = _read(spark, cfg, "states"), _read(spark, cfg, "summary")
    ids = states.groupBy("clip_id").agg(F.countDistinct("state_id").alias("n_state_ids"))
    own = facts.select("clip_id", F.col("include_in_dataset").alias("include"), F.col("numeric_fact_count").alias("numeric_count"), "exclude_reason", "n_states", F.col("data_change_count").alias("n_events"), F.col("dynamic_data").alias("dynamic"))
    artifacts = tables.read_or_empty(spark, cfg["artifacts"], tables.ARTIFACTS) if cfg.get("artifacts") else spark.createDataFrame([], tables.ARTIFACTS)
    met = clips.join(artifacts, "clip_id", "left").join(own, "clip_id", "left").join(ids, "clip_id", "left").join(_read(spark, cfg, "state_plan").select("clip_id", F.col("should_save").alias("planned")), "clip_id", "left")
    layers = [quality.rule_issues(met)]
    if cfg.get("drawings"):
        layers.append(quality.cross_issues(states, tables.read_or_empty(spark, cfg["drawings"], tables.DRAWINGS)))
    if cfg.get("answers"):
        layers.append(quality.model_issues(tables.read_or_empty(spark, cfg["answers"], tables.ANSWERS)))
    _write(quality.all_issues(*layers), cfg, "issues")
    _write(quality.status(clips, _read(spark, cfg, "issues"), "clip_id"), cfg, "quality")


def reviewed(spark: SparkSession, cfg: dict) -> None:
    """Where the latest review sends each clip, the final values of those accepted, and clips and chart rows with the review's own laid over."""
    log = tables.read_reviews(spark, cfg["reviews"], cfg["sample_id"]).withColumn("clip_id", F.get_json_object("original_value", "$.clip_id"))
    latest = quality.latest(log.drop("sample_id", "stage", "original_value", "model_version", "config_hash"), "clip_id", ["reviewed_at", "id"])
    clips = _read(spark, cfg, "clips")
    routed = quality.route(clips.select("clip_id"), latest.select("clip_id", "id", "decision", "reviewed_at"), "clip_id", "decision")
    _write(routed, cfg, "routes")
    _write(_read(spark, cfg, "final_table").join(routed.where("route = 'accepted'").select("clip_id"), "clip_id", "left_semi"), cfg, "accepted_values")
    fields = F.from_json(F.to_json(F.struct(*[c for c in clips.columns if c != "clip_id"])), "map<string, string>")
    _write(overlay.judged(clips.select("clip_id", fields.alias("fields"), F.lit(None).cast("string").alias("narration_status")), latest), cfg, "judged")
    found = _read(spark, cfg, "judged")
    _write(overlay.overlaid(found), cfg, "reviewed_clips")
    _write(overlay.reviewed_rows(found), cfg, "reviewed_rows")


COMMANDS = {"context": context, "assets": assets, "quality": check, "reviewed": reviewed}


def main(args: list[str] | None = None) -> None:
    from .session import session

    parser = argparse.ArgumentParser(prog="factframe")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--config", required=True)
    given = parser.parse_args(args)
    COMMANDS[given.command](session(), config.load(given.config))


if __name__ == "__main__":
    main()
