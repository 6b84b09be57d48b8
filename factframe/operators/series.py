"""Measures over ordered marks and boxes: smoothing, peaks, spread, positions, sentences kept by their words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import in_chunks, numbered, numbered_apart


def rolling_median(rows: DataFrame, by: list[str], order: list[Column], value: str, reach: int = 2, chunk: int | None = None) -> DataFrame:
    """The median of each row and of `reach` rows on either side, fewer at the ends; nulls don't count.

    With `chunk`, groups are cut into pieces of so many rows, for groups that no task could hold.
    """
    if chunk:
        cut = in_chunks(rows, by, order, reach, chunk)
        return rolling_median(cut, [*by, "__chunk"], [F.col("__place")], value, reach).where("__own").select(*rows.columns, "smooth")
    near = Window.partitionBy(*by).orderBy(*order).rowsBetween(-reach, reach)
    held = F.array_sort(F.collect_list(value).over(near))
    n = F.size("__near")
    middle = (F.get("__near", F.floor((n - 1) / 2).cast("int")) + F.get("__near", F.floor(n / 2).cast("int"))) / 2
    return rows.withColumn("__near", held).withColumn("smooth", F.when(n > 0, middle)).drop("__near")


def binned_peak(rows: DataFrame, by: list[str], value: str, width: int) -> DataFrame:
    """The bin of `width` that most values of a group fall in, the lowest of equals: (by, peak, hits)."""
    bins = rows.where(F.col(value).isNotNull()).groupBy(*by, F.round(F.col(value) / width).cast("long").alias("__bin")).agg(F.count("*").alias("__n"))
    best = F.max_by(F.struct((F.col("__bin") * width).alias("peak"), F.col("__n").alias("hits")), F.struct("__n", -F.col("__bin")))
    return bins.groupBy(*by).agg(best.alias("__b")).select(*by, "__b.peak", "__b.hits")


def spread(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Median, mean, population deviation and range of each group's values."""
    return rows.groupBy(*by).agg(
        F.median(value).alias("median"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation"), (F.max(value) - F.min(value)).alias("reach")
    )


def box_union(boxes: DataFrame, by: list[str], corners: tuple[str, str, str, str]) -> DataFrame:
    """The smallest box (x1, y1, x2, y2) round all boxes of a group, and how many there are."""
    x1, y1, x2, y2 = corners
    return boxes.groupBy(*by).agg(F.min(x1).alias("x1"), F.min(y1).alias("y1"), F.max(x2).alias("x2"), F.max(y2).alias("y2"), F.count("*").alias("n_boxes"))


def matched_by_place(left: DataFrame, right: DataFrame, by: list[str], left_order: list[Column], right_order: list[Column], apart: bool = False) -> DataFrame:
    """The n-th row of a group on the left with the n-th on the right; a left row beyond the last right one stays, with nulls.

    `apart` numbers groups that no task could hold, range by range.
    """
    placed = lambda rows, order: (numbered_apart if apart else numbered)(rows, by, order, "place")
    return placed(left, left_order).join(placed(right, right_order), [*by, "place"], "left")


def sentences_with_words(sentences: DataFrame, words: DataFrame, by: list[str], start: Column, end: Column) -> DataFrame:
    """Sentences that have a word overlapping (start, end), or no words at all.

    sentences are keyed by `by`; words carry the key, w_start and w_end.
    start and end may use columns of the sentences.
    """
    overlaps = (F.col("w_start") < F.col("__end")) & (F.col("w_end") > F.col("__start"))
    bounds = sentences.select(*by, start.alias("__start"), end.alias("__end"))
    heard = words.join(bounds, by).groupBy(*by).agg(F.bool_or(overlaps).alias("__heard"))
    return sentences.join(heard, by, "left").where(F.coalesce("__heard", F.lit(True))).drop("__heard")


def state_at(states: DataFrame, targets: DataFrame, by: list[str], at: str, slack: float = 0.0, width: float | None = None) -> DataFrame:
    """Of each target, the state (state_start, state_end) that covers its time within `slack`, else the nearest.

    Of several that cover it, and of two as near, the earlier state is taken.
    States that cover a target are met by time buckets of `width`, as in
    joins.covering(). For the others both sides are put on one time line, by
    the states' ends for the one before and by their starts for the one
    after, and sorted, so nothing is paired. A key without states, or with
    none that has both bounds, has no rows.
    """
    from .joins import covering

    own = [c for c in states.columns if c not in by]
    known = states.where(F.col("state_start").isNotNull() & F.col("state_end").isNotNull()).withColumns({"__from": F.col("state_start") - slack, "__to": F.col("state_end") + slack})
    asked = covering(targets, known, by, at, "__from", "__to", F.struct("state_start", "state_end"), width)
    state = F.struct(*own)
    row = F.struct(*asked.columns)
    kind = [asked.select(row.alias("r")).schema["r"].dataType, known.select(state.alias("s")).schema["s"].dataType]
    mark = lambda place, first: known.select(*by, F.col(place).alias("__at"), F.lit(first).alias("__rank"), F.lit(None).cast(kind[0]).alias("__row"), state.alias("__s"))
    point = lambda rows: rows.select(*by, F.col(at).alias("__at"), F.lit(1).alias("__rank"), row.alias("__row"), F.lit(None).cast(kind[1]).alias("__s"))
    # A state that ends just where the target is covers it, so on the first line states come after targets, on the second before.
    back = Window.partitionBy(*by).orderBy("__at", "__rank", F.col("__s.state_start").desc()).rowsBetween(Window.unboundedPreceding, 0)
    before = point(asked).unionByName(mark("__to", 2)).withColumn("__before", F.last("__s", ignorenulls=True).over(back)).where("__row IS NOT NULL").select("__row.*", "__before")
    row = F.struct(*before.columns)
    kind[0] = before.select(row.alias("r")).schema["r"].dataType
    # Downwards, as a window that looks ahead to its end is summed up anew for each row.
    ahead = Window.partitionBy(*by).orderBy(F.desc("__at"), "__rank", F.col("__s.state_end").desc()).rowsBetween(Window.unboundedPreceding, 0)
    both = point(before).unionByName(mark("__from", 0)).withColumn("__after", F.last("__s", ignorenulls=True).over(ahead)).where("__row IS NOT NULL").select("__row.*", "__after")
    past, next_ = F.col(at) - F.col("__before.state_end") - slack, F.col("__after.state_start") - slack - F.col(at)
    side = F.when(F.col("__after").isNull() | (past <= next_), F.struct(F.col("__before").alias("s"), past.alias("gap"))).otherwise(F.struct(F.col("__after").alias("s"), next_.alias("gap")))
    inside = F.struct(*[F.col(f"interval.{c}").alias(c) for c in own])
    gap = F.when(F.col("interval").isNotNull(), F.lit(0)).otherwise(side["gap"])
    out = both.withColumn("__s", F.when(F.col("interval").isNotNull(), inside).otherwise(side["s"])).withColumn("gap", gap)
    return out.where("__s IS NOT NULL").select(*targets.columns, "__s.*", "gap")


def changed_sets(rows: DataFrame, by: list[str], side: Column, value: str) -> DataFrame:
    """What a group's values have on one side only: (by, removed, added), `side` being true for the later ones."""
    held = lambda own: F.collect_set(F.when(own, F.col(value)))
    both = rows.groupBy(*by).agg(held(~side).alias("__old"), held(side).alias("__new"))
    return both.select(*by, F.array_sort(F.array_except("__old", "__new")).alias("removed"), F.array_sort(F.array_except("__new", "__old")).alias("added"))


def tail_frames(frames: DataFrame, by: list[str], at: str, span: float, spacing: float, most: int) -> DataFrame:
    """Of the frames in a group's last `span`, one a slot of `spacing` counted from its end, the latest of each, `most` at most."""
    until = F.max(at).over(Window.partitionBy(*by))
    late = frames.withColumn("__until", until).where(F.col(at) >= F.col("__until") - span)
    slot = F.floor((F.col("__until") - F.col(at)) / spacing).cast("long")
    last = late.withColumn("slot", slot).groupBy(*by, "slot").agg(F.max(at).alias(at))
    return last.where(F.col("slot") < most)


#: Seconds before a clip's end at which tail frames are tried, before the margin itself: fixed values.
TAIL = (0.75, 0.5)


def tail_candidates(frames: DataFrame, clips: DataFrame, by: list[str], at: str, duration: str, fps: float, margin: float = 0.25) -> DataFrame:
    """(by, n, at): times to add near the end of each clip (by, duration), from TAIL, the margin, and at most 0.05 before the end.

    A time that a frame, or an earlier one of these, is within half a frame
    of is left out. What a clip's frames are near to is one partial aggregate
    of four flags, so they are never gathered; the four are then settled in
    order by expressions. A clip without frames has all that are apart.
    """
    last = min(0.05, max(0.0, margin))
    times = [F.greatest(F.lit(0.0), F.least(F.col(duration) - last, F.col(duration) - offset)) for offset in (*TAIL, margin, last)]
    near = lambda a, b: F.abs(a - b) <= 0.5 / fps
    met = clips.select(*by, duration).join(frames.select(*by, F.col(at).alias("__at")), by, "left")
    seen = met.groupBy(*by, duration).agg(*[F.coalesce(F.bool_or(near(t, F.col("__at"))), F.lit(False)).alias(f"__seen{n}") for n, t in enumerate(times)])
    taken: list[Column] = []
    for n, time in enumerate(times):
        free = ~F.col(f"__seen{n}")
        for earlier, other in zip(taken, times):
            free = free & ~(earlier & near(time, other))
        taken.append(free)
    added = F.array_compact(F.array(*[F.when(free, F.struct(F.lit(n).alias("n"), time.alias("at"))) for n, (free, time) in enumerate(zip(taken, times), 1)]))
    return seen.where(F.col(duration).isNotNull()).select(*by, F.explode(added).alias("__t")).select(*by, F.col("__t.n").alias("n"), F.col("__t.at").alias(at))
