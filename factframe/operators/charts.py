"""Values of chart marks: plausibility, gaps filled from a line, regularity, ticks, layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def plausible(rows: DataFrame, by: list[str], value: str, length: str, tolerance: float = 0.12, small: float = 0.15) -> DataFrame:
    """Whether a value is to its group's largest as its mark is to the longest; small values get more room, negative ones none."""
    most = rows.groupBy(*by).agg(F.max(value).alias("__v"), F.max(length).alias("__l"))
    gap = F.abs(F.col(value) / F.col("__v") - F.col(length) / F.col("__l"))
    ok = F.when(F.col(value) < 0, False).otherwise(gap <= F.when(F.col(value) < 5, small).otherwise(tolerance))
    return rows.join(most, by).withColumn("plausible", ok).drop("__v", "__l")


def filled_by_line(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Missing y from the least-squares line of a group's known ones, not below 0; two known ones at least."""
    line = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"), F.count("*").alias("known"))
    met = rows.join(line, by, "left")
    guess = F.when(F.col("known") >= 2, F.greatest(F.col("slope") * F.col(x) + F.col("intercept"), F.lit(0.0)))
    return met.withColumn("estimated", F.col(y).isNull() & guess.isNotNull()).withColumn("filled", F.coalesce(F.col(y), guess)).drop("slope", "intercept", "known")


def regularity(rows: DataFrame, by: list[str], at: str) -> DataFrame:
    """1 minus three times the variation of the gaps between marks, not below 0; under three marks count as regular."""
    gaps = rows.withColumn("__gap", F.col(at) - F.lag(at).over(Window.partitionBy(*by).orderBy(at)))
    out = gaps.groupBy(*by).agg(F.count("*").alias("marks"), F.avg("__gap").alias("mean"), F.stddev_pop("__gap").alias("spread"))
    score = F.when((F.col("marks") < 3) | (F.col("mean") == 0), 1.0).otherwise(F.greatest(F.lit(0.0), 1 - 3 * F.col("spread") / F.col("mean")))
    return out.select(*by, "marks", score.alias("regularity"))


def tick_step(top: Column) -> Column:
    """The smallest of 1, 2, 5 times a power of ten that makes at most nine steps up to a positive top."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(top / 9)))
    steps = F.array(*[power * m for m in (1, 2, 5, 10, 20)])
    return F.get(F.filter(steps, lambda s: top / s <= 9), F.lit(0))


def bar_layout(rows: DataFrame, by: list[str], order: list[Column], value: str, height: int, width: int) -> DataFrame:
    """Slot, x and height of each bar of a plot: heights are shares of the largest value, slots have equal widths."""
    over = Window.partitionBy(*by)
    slot = F.row_number().over(over.orderBy(*order)) - 1
    n = F.count("*").over(over)
    return rows.withColumn("slot", slot.cast("long")).withColumn("bar_x", F.round(F.col("slot") * width / n, 3)).withColumn("bar_height", F.round(F.col(value) / F.max(value).over(over) * height, 3))
