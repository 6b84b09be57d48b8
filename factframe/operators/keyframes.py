"""Frames: sampling grids, motion, scores and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import in_chunks

#: Weights of the signals of a keyframe's score: fixed values.
WEIGHTS = {"completeness": 0.35, "finality": 0.25, "integrity": 0.2, "visibility": 0.15, "motion": -0.05}


def combined_score(signals: dict[str, Column]) -> Column:
    """The weighted sum of signals in 0..1; missing ones count as 0."""
    out = F.lit(0.0)
    for name, weight in WEIGHTS.items():
        out = out + F.lit(weight) * F.least(F.greatest(F.coalesce(signals[name], F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return out


#: Chart types whose later frames are preferred: fixed values.
LATE = ["bar", "line", "pie", "donut", "combined"]


def best_first(chart_type: Column, late: list[str] = LATE) -> list[Column]:
    """Sort keys of scored frames, the best one first, for ordering.first_rows().

    Frames have flags target, scene_change, complete, cropped, final and
    readable, scores completeness, finality and combined, and timestamp and
    duration. In turn count: the chart that is looked for, no change of
    scene, a complete one, nothing cropped, the final state, completeness and
    finality, both within 0 and 1, readable marks, for some chart types how
    late the frame is, and the combined score. Missing flags are false,
    missing scores 0.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    share = lambda c: F.least(F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    position = F.when(F.col("duration") > 0, F.col("timestamp") / F.col("duration")).otherwise(0.0)
    lateness = F.when(F.lower(chart_type).isin(late), position).otherwise(0.0)
    keys = [yes("target"), ~yes("scene_change"), yes("complete"), ~yes("cropped"), yes("final"), share("completeness"), share("finality"), yes("readable"), lateness, F.coalesce("combined", F.lit(0.0))]
    return [key.desc() for key in keys]


def motion(frames: DataFrame, by: list[str], order: str, pixels: str, chunk: int | None = None) -> DataFrame:
    """Mean difference of each frame from its neighbours: the mean over one or two of the mean absolute difference.

    With `chunk`, groups are cut into pieces of so many frames, for groups that no task could hold.
    """
    if chunk:
        cut = in_chunks(frames, by, [F.col(order)], 1, chunk)
        return motion(cut, [*by, "__chunk"], "__place", pixels).where("__own").select(*frames.columns, "motion")
    over = Window.partitionBy(*by).orderBy(order)
    diff = lambda other: F.aggregate(F.zip_with(F.col(pixels), other, lambda a, b: F.abs(a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x) / F.size(pixels)
    beside = frames.withColumn("__b", F.lag(pixels).over(over)).withColumn("__a", F.lead(pixels).over(over))
    b, a = diff(F.col("__b")), diff(F.col("__a"))
    score = F.when(F.col("__b").isNull(), F.coalesce(a, F.lit(0.0))).when(F.col("__a").isNull(), b).otherwise((a + b) / 2)
    return beside.withColumn("motion", score).drop("__b", "__a")


def or_all(rows: DataFrame, by: list[str], good: Column) -> DataFrame:
    """The good rows of each group; all of them where none is good. One flag a group is joined back, so rows don't move to few tasks."""
    marked = rows.withColumn("__ok", good)
    some = marked.groupBy(*by).agg(F.bool_or("__ok").alias("__any"))
    return marked.join(some, by).where("__ok OR NOT coalesce(__any, false)").select(*rows.columns)


def with_bounds(frames: DataFrame, clips: DataFrame, by: list[str], at: str) -> DataFrame:
    """Frames of each clip (start, end) and rows for those of its bounds that no frame is at; `added` marks them."""
    bounds = clips.select(*by, F.explode(F.array_distinct(F.array("start", "end"))).alias(at)).where(F.col(at).isNotNull())
    new = bounds.join(frames.select(*by, at).distinct(), [*by, at], "left_anti").withColumn("added", F.lit(True))
    return frames.withColumn("added", F.lit(False)).unionByName(new, allowMissingColumns=True)


def change_windows(frames: DataFrame, by: list[str], at: str, score: str, threshold: float) -> DataFrame:
    """Neighbours between which enough moves: (by, window_start, window_end), bounds being frames."""
    over = Window.partitionBy(*by).orderBy(at)
    pair = frames.withColumn("window_start", F.lag(at).over(over)).withColumn("__m", F.greatest(F.lag(score).over(over), F.col(score)))
    return pair.where(F.col("window_start").isNotNull() & (F.col("__m") >= threshold)).select(*by, "window_start", F.col(at).alias("window_end"))


def on_grid(frames: DataFrame, by: list[str], at: str, ord_: str, step: int) -> DataFrame:
    """The frame nearest to each point of a grid from a group's first frame on, once each; ties go to the earlier.

    A frame only competes for the grid point it rounds to, so no grid is built or joined.
    """
    origin = frames.withColumn("__0", F.min(at).over(Window.partitionBy(*by)))
    near = origin.withColumn("__g", F.floor((F.col(at) - F.col("__0") + step / 2) / step)).withColumn("__d", F.abs(F.col(at) - F.col("__0") - F.col("__g") * step))
    rank = F.row_number().over(Window.partitionBy(*by, "__g").orderBy("__d", at, ord_))
    return near.withColumn("__r", rank).where("__r = 1").withColumn("grid", F.col("__g").cast("long")).drop("__0", "__g", "__d", "__r")
