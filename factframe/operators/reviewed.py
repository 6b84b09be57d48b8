"""Clips as their reviewers left them: who is in, who is out, and the values that a review lays over a clip's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null

#: Decisions that let a clip in, hold it back, or keep it out: fixed values.
APPROVED = ["approved"]
BLOCKING = ["needs_revision", "saved", "需要修改", "保存", "通过"]
EXCLUDED = ["excluded", "排除"]


def _at(path: str) -> Column:
    return F.get_json_object("reviewed_value", f"$.{path}")


def judged(clips: DataFrame, reviews: DataFrame) -> DataFrame:
    """Each clip with its latest review, `route` (accepted, excluded, unreviewed) and the reason why it is unreviewed.

    reviews: (clip_id, id, decision, reviewed_value, reviewer, reviewed_at,
    notes), one a clip, as quality.latest() gives them. Clips without an id
    are left out; a clip without a review, or with a decision that doesn't
    settle it, stays unreviewed.
    """
    met = clips.where("clip_id IS NOT NULL").join(reviews.select("clip_id", F.col("id").alias("review_id"), "decision", "reviewed_value", "reviewer", "reviewed_at", "notes"), "clip_id", "left")
    decision = F.coalesce("decision", F.lit(""))
    route = F.when(decision.isin(EXCLUDED), "excluded").when(decision.isin(APPROVED), "accepted").otherwise("unreviewed")
    why = F.when(F.col("review_id").isNull(), "no_asset_review").otherwise(F.concat(F.when(decision.isin(BLOCKING), "blocking_decision:").otherwise("unsupported_decision:"), decision))
    return met.withColumn("route", route).withColumn("reason", F.when(F.col("route") == "unreviewed", why))


def overlaid(found: DataFrame) -> DataFrame:
    """The accepted clips of judged(), with what their review says laid over what they had.

    clips there: (clip_id, fields map<string, string>, narration_status).
    `clip` of the reviewed value replaces or adds fields, but never the id.
    Actions, description, narration and its status come from the review; a
    status that it leaves blank is the clip's own. A reviewed value that
    isn't sound JSON says nothing.
    """
    said = F.coalesce(F.from_json(_at("clip"), "map<string, string>"), F.create_map().cast("map<string, string>"))
    fields = F.map_zip_with(F.coalesce("fields", F.create_map().cast("map<string, string>")), said, lambda k, own, new: F.when(F.map_contains_key(said, k), new).otherwise(own))
    actions = F.from_json(_at("animation.major_actions"), "array<string>")
    return found.where("route = 'accepted'").select(
        "clip_id", F.map_filter(fields, lambda k, v: k != "clip_id").alias("fields"), F.col("decision").alias("review_decision"), "review_id", "reviewed_at", "reviewer", "notes",
        F.coalesce(F.size(actions), F.lit(0)).alias("animation_action_count"), _at("animation.overall_description").alias("animation_description"),
        F.coalesce(blank_to_null(_at("narration.status")), "narration_status").alias("narration_status"), F.coalesce(_at("narration.full_text"), F.lit("")).alias("narration_text"),
    )


def reviewed_rows(found: DataFrame) -> DataFrame:
    """The chart rows that accepted reviews give: (clip_id, ord, row), ord counting what the review lists from 0.

    Fields whose name begins with an underscore are the review form's own and
    go; a row without any other filled field goes too, as does what isn't an
    object.
    """
    listed = F.from_json(_at("chart_data"), "array<string>")
    rows = found.where("route = 'accepted'").select("clip_id", F.posexplode(listed).alias("ord", "text"))
    row = F.map_filter(F.from_json("text", "map<string, string>"), lambda k, v: ~F.startswith(k, F.lit("_")))
    filled = F.exists(F.map_values("row"), lambda v: F.coalesce(v != "", F.lit(False)))
    return rows.select("clip_id", "ord", row.alias("row")).where(filled)


def corrected(values: DataFrame, found: DataFrame) -> DataFrame:
    """Values of accepted clips, (clip_id, ord, row): a clip's reviewed rows where its review has any, else its own."""
    rows = reviewed_rows(found)
    own = values.select("clip_id", "ord", "row").join(found.where("route = 'accepted'").select("clip_id"), "clip_id", "left_semi").join(rows.select("clip_id"), "clip_id", "left_anti")
    return own.unionByName(rows)
