"""Picks by order: first, last, best and evenly spaced rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, by: list[str], order: list[Column], to: str = "n") -> DataFrame:
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))


def numbered_apart(df: DataFrame, by: list[str], order: list[Column], to: str = "n") -> DataFrame:
    """numbered(), for groups that no task could hold: a group's rows are dealt out by ranges of its order.

    Rows are put into ranges of (by, order) and kept so; a range's rows are
    numbered by themselves, and the rows of a group in the ranges before are
    added, which is a table of a row for each group and range.
    """
    from ..stages import kept

    rows = kept(df.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*by, "__part").agg(F.count("*").alias("__size")).withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size")
    own = F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order))
    same = [F.col(f"__k{n}").eqNullSafe(F.col(c)) for n, c in enumerate(by)]
    sizes = sizes.select(*[F.col(c).alias(f"__k{n}") for n, c in enumerate(by)], F.col("__part").alias("__p"), "__before")
    met = rows.withColumn("__own", own).join(sizes, [*same, F.col("__p") == F.col("__part")])
    return met.withColumn(to, F.col("__own").cast("long") + F.col("__before")).select(*df.columns, to)


def in_chunks(df: DataFrame, by: list[str], order: list[Column], reach: int, rows: int = 100_000) -> DataFrame:
    """df in chunks of `rows` neighbours of a group, with `reach` more on either side: for windows that look no further.

    A window partitioned by (by, __chunk) and ordered by __place sees for each
    row with __own all that one over the group would; the others are borders
    and go afterwards.
    """
    placed = numbered_apart(df, by, order, "__place")
    chunk = lambda place: F.floor((place - 1) / rows).cast("long")
    own, place = chunk(F.col("__place")), F.col("__place")
    dealt = placed.withColumn("__chunk", F.explode(F.array_distinct(F.array(own, chunk(F.greatest(place - reach, F.lit(1))), chunk(place + reach)))))
    return dealt.withColumn("__own", F.col("__chunk") == own)


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group. Rows over n are dropped before the shuffle, so large groups stay cheap."""
    return numbered(df, by, order, "__n").where(F.col("__n") <= n).drop("__n")


def pick_evenly(df: DataFrame, by: list[str], order: list[Column], limit: int) -> DataFrame:
    """At most `limit` rows of each group, evenly spaced, the first and last among them; places are rounded half to even."""
    group = Window.partitionBy(*by)
    placed = df.withColumn("__i", F.row_number().over(group.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(group))
    steps = F.sequence(F.lit(0), F.lit(limit - 1))
    places = F.transform(steps, lambda i: F.rint(i * (F.col("__n") - 1) / F.lit(max(limit - 1, 1))).cast("int"))
    keep = (F.col("__n") <= limit) | F.array_contains(places, F.col("__i")) if limit > 1 else F.col("__i") == F.col("__n") - 1
    return placed.where(keep).drop("__i", "__n")


def majority(df: DataFrame, by: list[str], value: str, least: int = 2) -> DataFrame:
    """The value most rows of a group agree on, if `least` do; ties go to the smallest. (by, value, votes, rows)"""
    votes = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("votes"))
    best = F.max_by(F.struct(F.col(value), F.col("votes")), F.struct(F.col("votes"), (-F.col(value)).alias("small")))
    out = votes.groupBy(*by).agg(best.alias("__b"), F.sum("votes").alias("rows"))
    return out.where(F.col("__b.votes") >= least).select(*by, f"__b.{value}", "__b.votes", "rows")


def anchors(df: DataFrame, by: list[str], order: list[Column], most: int = 2) -> DataFrame:
    """The first and last row of each group of two or more, with the middle one in between if `most` is over 2; `anchor` numbers them."""
    group = Window.partitionBy(*by)
    placed = df.withColumn("__i", F.row_number().over(group.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(group))
    last = F.col("__n") - 1
    picks = F.array(F.lit(0).cast("long"), *([F.floor(F.col("__n") / 2)] if most > 2 else []), last)
    at = F.array_position(F.slice(F.array_distinct(picks), 1, most), F.col("__i").cast("long"))
    return placed.withColumn("anchor", at).where((F.col("__n") > 1) & (F.col("anchor") > 0)).drop("__i", "__n")


def densest(df: DataFrame, by: list[str], attempt: str) -> DataFrame:
    """(by, attempt, rows): of each group the attempt with the most rows, the smallest of equals."""
    counts = df.groupBy(*by, attempt).agg(F.count("*").alias("rows"))
    best = F.min_by(F.struct(attempt, "rows"), F.struct((-F.col("rows")).alias("n"), attempt))
    return counts.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def by_year(text: Column) -> list[Column]:
    """Sort keys: texts with a year first and by it, then by the text."""
    from ..functions.scalars import year_in

    year = year_in(text)
    return [year.isNull(), F.coalesce(year, F.lit(0)), text]
