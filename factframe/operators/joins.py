"""Joins over time and labels."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Time buckets that an interval is put into; one that touches more meets all rows of its key, as it overlaps a great part of them.
MOST_BUCKETS = 1024


def _split(rows: DataFrame, start: Column, end: Column, width: float, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows once for each `__bucket` of the width that they touch, rows of too many buckets, unless all are to be in the first); rows without bounds or that end before they start are in neither."""
    a, z = F.floor(start / width).cast("long"), F.floor(end / width).cast("long")
    known = rows.where(F.coalesce(end >= start, F.lit(False))).withColumn("__n", z - a)
    short = (known if every else known.where(F.col("__n") < MOST_BUCKETS)).withColumn("__bucket", F.explode(F.sequence(a, z))).drop("__n")
    return short, known.where(F.col("__n") >= MOST_BUCKETS).drop("__n")


def overlapping(left: DataFrame, right: DataFrame, on: list[str], start: tuple[str, str], end: tuple[str, str], closed: bool = False, keep_missing: bool = False, width: float | None = None, bounded: bool = False) -> DataFrame:
    """Rows of one key whose intervals overlap, with clip_start and clip_end of the overlap; touching counts only if `closed`.

    The key is an equality, so that Spark hashes or sorts by it, and the
    interval is a residual condition. With `width`, a few times a usual
    interval, rows meet by key and time bucket: each goes to the buckets that
    it touches, and a pair counts in the one where its overlap begins, so a
    key with any number of rows is spread out and its pairs are those of
    neighbours. Intervals of over MOST_BUCKETS buckets meet all rows of their
    key in joins of their own, for which both sides are shuffled again. Where
    lengths are known to be a few widths, `bounded` leaves those joins out:
    any interval then goes to all its buckets, however many, so nothing is
    lost. Rows with a missing bound overlap nothing, or, with keep_missing,
    everything of their key.
    """
    names = [*left.columns, *[c for c in right.columns if c not in on]]
    a, z = F.greatest(start[0], start[1]), F.least(end[0], end[1])
    missing = reduce(operator.or_, [F.col(c).isNull() for c in (*start, *end)])
    fits = ~missing & (F.col("clip_end") >= F.col("clip_start") if closed else F.col("clip_end") > F.col("clip_start"))
    clipped = lambda met: met.select(*names, a.alias("clip_start"), z.alias("clip_end"))
    if width is None:
        return clipped(left.join(right, on)).where(missing | fits if keep_missing else fits)
    (short, long), (short_r, long_r) = _split(left, F.col(start[0]), F.col(end[0]), width, bounded), _split(right, F.col(start[1]), F.col(end[1]), width, bounded)
    near = clipped(short.join(short_r, [*on, "__bucket"]).where(F.col("__bucket") == F.floor(a / width))).where(fits)
    once = short.where(F.col("__bucket") == F.floor(F.col(start[0]) / width)).drop("__bucket")
    out = near if bounded else near.unionByName(clipped(long.join(right, on)).where(fits)).unionByName(clipped(once.join(long_r, on)).where(fits))
    if keep_missing:
        no = lambda n: F.col(start[n]).isNull() | F.col(end[n]).isNull()
        out = out.unionByName(clipped(left.where(no(0)).join(right, on))).unionByName(clipped(left.where(~no(0)).join(right.where(no(1)), on)))
    return out


def contained(inner: DataFrame, outer: DataFrame, on: list[str], start: tuple[str, str], end: tuple[str, str], slack: float = 1e-3, width: float | None = None) -> DataFrame:
    """Rows of one key whose first interval lies within the second, give or take.

    With `width`, as in overlapping(), the second goes to the time buckets
    that it touches, and the first to that of its start.
    """
    names = [*inner.columns, *[c for c in outer.columns if c not in on]]
    within = (F.col(start[0]) >= F.col(start[1]) - slack) & (F.col(end[0]) <= F.col(end[1]) + slack)
    if width is None:
        return inner.join(outer, on).where(within)
    short, long = _split(outer, F.col(start[1]) - slack, F.col(end[1]) + slack, width)
    sound = F.col(end[0]) >= F.col(start[0])
    placed = inner.where(sound).withColumn("__bucket", F.floor(F.col(start[0]) / width).cast("long"))
    near = placed.join(short, [*on, "__bucket"]).where(within).select(*names)
    # Faulty rows that end before they start have no buckets of their own.
    turned = outer.where(F.col(end[1]) + slack < F.col(start[1]) - slack)
    rest = inner.where(sound).join(long.unionByName(turned), on).unionByName(inner.where(~sound).join(outer, on))
    return near.unionByName(rest.where(within).select(*names))


def covering(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, order: str | Column, width: float | None = None) -> DataFrame:
    """Points with `interval`, the first by `order` of their key's intervals that holds their time, bounds included; null where none does.

    Whether any holds it is whether interval is there. With `width`, as in
    overlapping(), intervals go to the time buckets that they touch and a
    point meets those of its own, so a key with many of both makes no pairs
    beyond that. A partial aggregate leaves one row a point and task before
    the shuffle.
    """
    key = [c for c in points.columns if c not in on]
    own = F.struct(*[c for c in intervals.columns if c not in on])
    order = F.col(order) if isinstance(order, str) else order
    ready = intervals.select(*on, own.alias("interval"), F.col(start).alias("__a"), F.col(end).alias("__z"), order.alias("__o"))
    held = F.col(at).between(F.col("__a"), F.col("__z"))
    if width is None:
        met = points.join(ready, on, "left")
        return met.groupBy(*on, *key).agg(F.min_by("interval", F.when(held, F.col("__o"))).alias("interval"))
    short, long = _split(ready, F.col("__a"), F.col("__z"), width)
    found = ["interval", "__o"]
    near = points.withColumn("__bucket", F.floor(F.col(at) / width).cast("long")).join(short, [*on, "__bucket"]).where(held).select(*points.columns, *found)
    far = points.join(long, on).where(held).select(*points.columns, *found)
    none = points.select("*", *[F.lit(None).cast(ready.schema[c].dataType).alias(c) for c in found])
    return near.unionByName(far).unionByName(none).groupBy(*on, *key).agg(F.min_by("interval", "__o").alias("interval"))


def on_axis(rows: DataFrame, ticks: DataFrame, by: list[str], coord: str, tick: str, value: str) -> DataFrame:
    """Rows with `read`, the value at their coordinate on their key's axis: linear between ticks, the end slopes beyond, never below 0.

    Ticks carry their neighbours, and rows and ticks are put on one line that
    is sorted once; an axis of under two ticks reads null.
    """
    line = Window.partitionBy(*by).orderBy(tick)
    ends = ticks.select(*by, tick, value).distinct().withColumns({"__x0": F.lag(tick).over(line), "__y0": F.lag(value).over(line), "__x1": F.lead(tick).over(line), "__y1": F.lead(value).over(line)})
    mark = F.struct(F.col(tick).alias("x"), F.col(value).alias("y"), "__x0", "__y0", "__x1", "__y1")
    marks = ends.select(*by, F.col(tick).cast("double").alias("__at"), mark.alias("__mark"))
    kind = marks.schema["__mark"].dataType
    both = marks.withColumn("__row", F.lit(None).cast(rows.select(F.struct(*rows.columns).alias("r")).schema["r"].dataType)).unionByName(rows.select(*by, F.col(coord).cast("double").alias("__at"), F.lit(None).cast(kind).alias("__mark"), F.struct(*rows.columns).alias("__row")))
    order = Window.partitionBy(*by).orderBy("__at", F.col("__row").isNotNull())
    back = F.last("__mark", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    down = Window.partitionBy(*by).orderBy(F.desc("__at"), F.col("__row").isNotNull())
    ahead = F.last("__mark", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0))
    met = both.withColumn("__m", F.coalesce(back, ahead)).where("__row IS NOT NULL")
    m = F.col("__m")
    up = m["__x1"].isNotNull()
    slope = F.when(up, (m["__y1"] - m["y"]) / (m["__x1"] - m["x"])).otherwise((m["y"] - m["__y0"]) / (m["x"] - m["__x0"]))
    return met.withColumn("read", F.greatest(m["y"] + (F.col("__at") - m["x"]) * slope, F.lit(0.0))).withColumn("read", F.when(slope.isNotNull(), F.col("read"))).select("__row.*", "read")


def nearest(left: DataFrame, right: DataFrame, by: list[str], at: str, ord_: str, carry: list[str], tolerance: int | None = None) -> DataFrame:
    """Each left row with the right row of its key that is nearest in `at`; the earlier of two as near, ties by ord.

    Both sides are put on one time line, so a key's rows are sorted once and
    never paired: the nearest is the last right row before or the first after.
    """
    side = lambda df, own: df.select(*by, at, F.col(ord_).alias("__ord"), F.lit(own).alias("__left"), *([F.struct(at, ord_, *carry).alias("__r")] if not own else [F.lit(None).cast(_struct(right, [at, ord_, *carry])).alias("__r")]), *([F.struct(*[c for c in left.columns]).alias("__l")] if own else [F.lit(None).cast(_struct(left, left.columns)).alias("__l")]))
    line = side(left, True).unionByName(side(right, False))
    back = Window.partitionBy(*by).orderBy(at, F.col("__left"), "__ord").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by).orderBy(F.desc(at), F.col("__left"), F.desc("__ord")).rowsBetween(Window.unboundedPreceding, 0)
    both = line.withColumn("__b", F.last("__r", ignorenulls=True).over(back)).withColumn("__a", F.last("__r", ignorenulls=True).over(ahead)).where("__left")
    gap = lambda c: F.abs(F.col(f"{c}.{at}") - F.col(at))
    use_back = F.col("__a").isNull() | (F.col("__b").isNotNull() & (gap("__b") <= gap("__a")))
    out = both.withColumn("__n", F.when(use_back, F.col("__b")).otherwise(F.col("__a"))).withColumn("distance", F.abs(F.col(f"__n.{at}") - F.col(at)))
    if tolerance is not None:
        out = out.withColumn("__n", F.when(F.col("distance") <= tolerance, F.col("__n")))
    return out.select("__l.*", *[F.col(f"__n.{c}").alias(f"near_{c}") for c in (at, ord_, *carry)], "distance")


def _struct(df: DataFrame, columns: list[str]) -> str:
    return "struct<" + ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns) + ">"


def interpolated(coord: Column, ticks: list[tuple[float, float]]) -> Column:
    """A coordinate's value on an axis with at least two ticks (coord, value): linear between, the end slopes beyond, never below 0."""
    points = sorted(ticks)
    out = None
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        line = F.lit(y0) + (coord - x0) * ((y1 - y0) / (x1 - x0))
        last = (x1, y1) == points[-1]
        out = line if len(points) == 2 else (F.when(coord <= x1, line) if out is None else out.otherwise(line) if last else out.when(coord <= x1, line))
    return F.greatest(out, F.lit(0.0))


def upsert(base: DataFrame, changes: DataFrame, on: list[str], value: str) -> DataFrame:
    """base with the values of changes: (on, value, action), action being kept, updated or inserted."""
    met = base.select(*on, F.col(value).alias("__old"), F.lit(True).alias("__b")).join(changes.select(*on, F.col(value).alias("__new"), F.lit(True).alias("__c")), on, "full_outer")
    action = F.when(F.col("__c").isNull(), "kept").when(F.col("__b").isNull(), "inserted").otherwise("updated")
    return met.select(*on, F.when(F.col("__c").isNull(), F.col("__old")).otherwise(F.col("__new")).alias(value), action.alias("action"))
