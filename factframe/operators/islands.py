"""Runs in ordered rows: islands, sentences, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def island_ids(df: DataFrame, by: list[str], order: list[Column], opens: Column, to: str = "island") -> DataFrame:
    """Number the runs of each group; `opens` is true where a run begins and may use lag() over the same order."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__open", F.coalesce(opens, F.lit(True)).cast("long")).withColumn(to, F.sum("__open").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("__open")


def sentences(words: DataFrame, by: list[str], at: Column, order: list[Column], ends: Column, pause: float) -> DataFrame:
    """Number the sentences of a word stream: one ends at a closing word or before a pause of at least `pause`."""
    window = Window.partitionBy(*by).orderBy(*order)
    marked = words.withColumn("__at", at).withColumn("__ends", ends)
    opens = F.lag("__ends").over(window) | (F.col("__at") - F.lag("__at").over(window) >= pause)
    return island_ids(marked, by, order, opens, "sentence").drop("__at", "__ends")


def clusters(df: DataFrame, by: list[str], value: str, gap: int) -> DataFrame:
    """Number the clusters of a value: neighbours at most `gap` apart share one."""
    order = [F.col(value)]
    return island_ids(df, by, order, F.col(value) - F.lag(value).over(Window.partitionBy(*by).orderBy(*order)) > gap, "cluster")
