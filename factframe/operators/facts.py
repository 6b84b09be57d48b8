"""Facts over time: fusion of sources, states, changes, final values, keyframe plans.

A record has RECORD's columns: `ord` is its place in its source. Empty units
count as missing. Times are seconds; a missing start counts as 0 in orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null
from .ordering import first_rows

KEY = ["clip_id", "entity_id", "metric"]
FRAME = "struct<frame_id: string, time_seconds: double, path: string>"
RECORD = f"clip_id bigint, ord bigint, state_key string, state_label string, entity_id string, entity string, metric string, value double, unit string, state_start double, state_end double, source_type string, evidence_frames array<{FRAME}>, evidence_sentence_id string, confidence double, review_status string, raw_text string, evidence_text string, value_type string"
CONFLICT = "struct<source_type: string, value: double, unit: string, evidence_sentence_id: string>"


def _value_key() -> Column:
    return F.struct(F.col("value"), F.nullif("unit", F.lit("")).alias("unit"))


def _start(column: str = "state_start") -> Column:
    return F.coalesce(F.col(column), F.lit(0.0))


def sanitised_metric(metric: Column) -> Column:
    """A metric without a letter or digit is none."""
    text = F.trim(F.coalesce(metric, F.lit("")))
    return F.when(text.rlike("[A-Za-z0-9]"), text).otherwise("")


def fuse(visual: DataFrame, narration: DataFrame, parts: int | None = None) -> DataFrame:
    """Two sources of records as one, with conflict_with: every visual record, and narrated ones that aren't merged into others.

    Narrated records are taken in order against all before them of the same
    clip, entity and metric. One of equal value and unit confirms those it
    meets: they become `both`, take its sentence and the higher confidence.
    One that differs marks those it meets for review, and stays itself for
    review. One that only confirms goes. Whether a narrated record stays
    depends only on whether the values up to it are all the same, and what
    becomes of a record only on the last one after it and the last equal
    ones, so windows over the key say it all and nothing is collected. With
    `parts`, they are dealt out by key to so many tasks.
    """
    rows = visual.withColumn("__said", F.lit(0)).unionByName(narration.withColumn("__said", F.lit(1))).withColumn("__k", _value_key())
    rows = rows.repartition(parts, *KEY) if parts else rows
    order = [F.col("__said"), F.col("ord")]
    by = Window.partitionBy(*KEY).orderBy(*order)
    seen = by.rowsBetween(Window.unboundedPreceding, 0)
    # What comes later is asked for downwards, as a window that looks ahead to its end is summed up anew for each row.
    down = [F.desc("__said"), F.desc("ord")]
    later, later_alike = (Window.partitionBy(*key).orderBy(*down).rowsBetween(Window.unboundedPreceding, -1) for key in (KEY, [*KEY, "__k"]))
    said = F.when(F.col("__said") == 1, F.struct("value", "unit", "evidence_sentence_id", F.col("__k").alias("k")))
    sound = F.coalesce(F.col("confidence"), F.lit(0.0))
    rows = rows.withColumns(
        {
            "__mixed": F.min("__k").over(seen) != F.max("__k").over(seen),
            "__first": F.row_number().over(by) == 1,
            "__last": F.first(said, ignorenulls=True).over(later),
            "__same": F.first(said, ignorenulls=True).over(later_alike),
            "__sure": F.max(F.when(F.col("__said") == 1, sound)).over(later_alike),
        }
    )
    # Of those after a record that agrees with the last one, the last that doesn't.
    ends = F.last(said, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("__end", ends["k"]).withColumn("__other", F.first(F.when((F.col("__said") == 1) & (F.col("__k") != F.col("__end")), said), ignorenulls=True).over(later))
    kept = rows.where((F.col("__said") == 0) | F.col("__mixed") | F.col("__first"))
    clash, differs = (F.col("__said") == 1) & F.col("__mixed"), F.col("__last")["k"] != F.col("__k")
    told = lambda n: F.struct(F.lit("narration").alias("source_type"), n["value"].alias("value"), n["unit"].alias("unit"), n["evidence_sentence_id"].alias("evidence_sentence_id")).cast(CONFLICT)
    against = F.struct(F.lit("visual").alias("source_type"), F.lit(None).alias("value"), F.lit(None).alias("unit"), F.lit(None).alias("evidence_sentence_id")).cast(CONFLICT)
    same = F.col("__same").isNotNull()
    out = kept.withColumns(
        {
            "review_status": F.when(F.col("__last").isNull(), F.when(clash, "needs_review").otherwise(F.col("review_status"))).when(differs, "needs_review").otherwise("machine"),
            "source_type": F.when(same & (F.col("source_type") == "visual"), "both").otherwise(F.col("source_type")),
            "evidence_sentence_id": F.when(same, F.col("__same.evidence_sentence_id")).otherwise(F.col("evidence_sentence_id")),
            "confidence": F.when(same, F.greatest(sound, "__sure")).otherwise(F.col("confidence")),
            "conflict_with": F.when(differs, told(F.col("__last"))).when(F.col("__other").isNotNull(), told(F.col("__other"))).when(clash, against),
            "ord": F.col("ord") + F.col("__said") * F.lit(1 << 40),
        }
    )
    return out.drop("__said", "__k", "__mixed", "__first", "__last", "__same", "__sure", "__end", "__other")


#: Sources that become `both` where they meet: fixed values.
MIXED = ["visual", "narration", "both"]


def state_runs(records: DataFrame) -> DataFrame:
    """Records with __run, the number of the state they belong to in their clip, entity and metric.

    A record opens a run where it says something else than the one before, or
    starts before the run it would join ends. That end is the last known one
    of the run so far, and a run whose first record has none has none until
    another brings it. A record with an end sets the end to its own whether
    it opens a run or joins one. So up to the next such record the end is
    constant, and of those in between only the first that starts too early
    opens a run; from there on the end is unknown, and the others join. All
    of it is windows of one order: a group is sorted once.
    """
    order = [_start(), F.col("ord")]
    upto = Window.partitionBy(*KEY).orderBy(*order)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    says = F.struct(_value_key().alias("k"), "review_status", "state_key")
    rows = records.withColumn("__says", says).withColumn("__new", F.coalesce(F.lag("__says").over(upto) != F.col("__says"), F.lit(True)))
    rows = rows.withColumn("__data", F.sum(F.col("__new").cast("long")).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    ended = F.when(F.col("state_end").isNotNull(), F.struct("__data", F.col("state_end").alias("end")))
    rows = rows.withColumns({"__since": F.last(ended, ignorenulls=True).over(before), "__ends": F.count("state_end").over(before)})
    early = (F.col("__since.__data") == F.col("__data")) & (F.col("state_start") < F.col("__since.end"))
    rows = rows.withColumn("__early", F.when(F.coalesce(early, F.lit(False)), F.struct("__data", "__ends")))
    first = F.col("__early").isNotNull() & ~F.coalesce(F.last("__early", ignorenulls=True).over(before) == F.col("__early"), F.lit(False))
    rows = rows.withColumn("__open", (F.col("__new") | first).cast("long")).withColumn("__run", F.sum("__open").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.drop("__says", "__new", "__data", "__since", "__ends", "__early", "__open")


def merge_states(records: DataFrame) -> DataFrame:
    """Neighbouring records of a clip, entity and metric as one state where they say the same.

    They say the same if value, unit, review status and state key are equal
    and none starts before the state so far ends. A state has its first
    record's fields, the last known end, all evidence frames in order, the
    first sentence and the highest confidence. Its source is `both` if its
    first record's and another's are two of MIXED, else the first record's.
    n_facts counts its records.
    """
    rows = state_runs(records)
    at = F.struct(_start().alias("start"), "ord")
    own = [c for c in records.columns if c not in (*KEY, "state_end", "evidence_frames", "evidence_sentence_id", "confidence", "source_type")]
    known = F.when(F.col("source_type").isin(MIXED), F.col("source_type"))
    frames = F.array_sort(F.collect_list(F.struct(at.alias("at"), "evidence_frames")))
    merged = rows.groupBy(*KEY, "__run").agg(
        F.min_by(F.struct(*own), at).alias("__own"),
        F.max_by("state_end", F.when(F.col("state_end").isNotNull(), at)).alias("state_end"),
        F.flatten(F.transform(frames, lambda f: F.coalesce(f["evidence_frames"], F.array().cast(f"array<{FRAME}>")))).alias("evidence_frames"),
        F.min_by("evidence_sentence_id", F.when(blank_to_null(F.col("evidence_sentence_id")).isNotNull(), at)).alias("evidence_sentence_id"),
        F.when(F.count("*") > 1, F.max(F.coalesce("confidence", F.lit(0.0)))).otherwise(F.first("confidence")).alias("confidence"),
        F.min_by("source_type", at).alias("__source"),
        F.min(known).alias("__least"),
        F.max(known).alias("__most"),
        F.count("*").alias("n_facts"),
    )
    source = F.when(F.col("__source").isin(MIXED) & (F.col("__least") != F.col("__most")), "both").otherwise(F.col("__source")).alias("source_type")
    return merged.select(*KEY, "__own.*", "state_end", "evidence_frames", "evidence_sentence_id", "confidence", source, "n_facts")


def with_state_ids(states: DataFrame) -> DataFrame:
    """States with `place`, their order in a clip, and state_id.

    States of one state key share an id, bounds from the first start to the
    last end, and the key as a label where they have none; any other state
    has an id of its own. Ids count by start, then key; states without a key
    come as `__row_` and their number.
    """
    clip = Window.partitionBy("clip_id")
    states = states.withColumn("place", F.row_number().over(clip.orderBy(_start(), "entity_id", "metric", "ord")).cast("long")).withColumn("__key", F.nullif("state_key", F.lit("")))
    group = Window.partitionBy("clip_id", "__key")
    keyed = F.col("__key").isNotNull()
    start, end = F.min("state_start").over(group), F.max("state_end").over(group)
    states = states.withColumn("__a", F.when(keyed, start).otherwise(F.col("state_start"))).withColumn("__z", F.when(keyed, F.coalesce(end, start)).otherwise(F.col("state_end")))
    n_keys = F.size(F.collect_set("__key").over(clip))
    alone = F.row_number().over(Window.partitionBy("clip_id", keyed).orderBy("place")) - 1
    states = states.withColumn("__name", F.coalesce(F.col("__key"), F.format_string("__row_%06d", n_keys + alone)))
    number = F.dense_rank().over(clip.orderBy(_start("__a"), "__name"))
    label = F.when(keyed, F.coalesce(F.nullif("state_label", F.lit("")), F.col("__key"))).otherwise(F.col("state_label"))
    out = states.withColumns({"state_id": F.format_string("state_%03d", number), "state_start": F.col("__a"), "state_end": F.col("__z"), "state_label": label})
    return out.drop("__key", "__a", "__z", "__name")


def change_events(states: DataFrame) -> DataFrame:
    """An insert at an entity's first state and an update where value, unit or type differs from the one before; numbered within a clip."""
    order = [_start(), F.col("place")]
    over = Window.partitionBy(*KEY).orderBy(*order)
    signature = F.struct("value", "unit", "value_type")
    before = F.lag(signature).over(over)
    kind = F.when(before.isNull(), "insert").when(before != signature, "update")
    events = states.withColumn("event_type", kind).where(F.col("event_type").isNotNull())
    number = F.row_number().over(Window.partitionBy("clip_id").orderBy(*order))
    return events.withColumn("event_id", F.format_string("event_%03d", number)).select(
        "clip_id", "event_id", "event_type", "entity_id", F.coalesce("entity", "entity_id").alias("entity"), "metric", "value", "unit", "state_start", "state_end", "source_type", "evidence_frames", "evidence_sentence_id", "confidence", "review_status"
    )


def final_table(states: DataFrame) -> DataFrame:
    """The last state of each entity and metric; one partial row a key and task is shuffled."""
    kept = ["entity", "value", "unit", "value_type", "source_type", "evidence_frames", "evidence_sentence_id", "confidence", "review_status"]
    last = F.max_by(F.struct(*kept), F.struct(_start().alias("start"), "place"))
    out = states.groupBy(*KEY).agg(last.alias("r")).select(*KEY, "r.*")
    return out.withColumn("entity", F.coalesce("entity", "entity_id")).withColumn("type", F.coalesce("value_type", F.lit("exact"))).drop("value_type")


def summary(states: DataFrame) -> DataFrame:
    """What a clip's states amount to: counts, completeness, whether anything changes, whether it is of use and why not."""
    n, numeric = F.count("*"), F.count("value")
    kind = F.when(n == numeric, "complete").otherwise("partial")
    counts = states.groupBy("clip_id").agg(n.alias("n_states"), numeric.alias("numeric_fact_count"), F.countDistinct("entity_id").alias("n_entities"), kind.alias("data_completeness"))
    changes = change_events(states).groupBy("clip_id").agg(F.count("*").alias("data_change_count"))
    out = counts.join(changes, "clip_id", "left").withColumn("data_change_count", F.coalesce("data_change_count", F.lit(0).cast("long")))
    excluded = F.col("numeric_fact_count") == 0
    return out.withColumns({"dynamic_data": F.col("data_change_count") > 1, "include_in_dataset": ~excluded, "exclude_reason": F.when(excluded, NO_DATA)})


#: Why a clip without numbers is left out: a fixed value.
NO_DATA = "no_recoverable_quantitative_data"


#: The source of a value read off a drawn line, and its confidence: fixed values.
LINE, LINE_CONFIDENCE = "visual_line_estimate", 0.7


def curve_points(path: DataFrame, ticks: DataFrame, by: list[str], x: str = "x", y: str = "y", tick: str = "tick", most: int = 10) -> DataFrame:
    """(by, idx, x, y): points of a traced line at the ticks of its axis, the nearest to each and the left one of two as near.

    A line whose axis has under three ticks gives every n-th of its points,
    n being a `most`-th of them, from the first on. Line and ticks are put on
    one sorted line, so they aren't paired.
    """
    from .joins import nearest

    known = path.where(F.col(x).isNotNull()).select(*by, F.col(x).cast("double").alias("x"), F.col(y).alias("y")).withColumn("__i", F.row_number().over(Window.partitionBy(*by).orderBy("x")) - 1)
    marks = ticks.where(F.col(tick).isNotNull()).select(*by, F.col(tick).cast("double").alias("x")).withColumn("idx", F.row_number().over(Window.partitionBy(*by).orderBy("x")) - 1)
    many = marks.groupBy(*by).agg(F.count("*").alias("__ticks"))
    at_ticks = nearest(marks.join(many.where("__ticks > 2"), by, "left_semi"), known.withColumnRenamed("__i", "idx"), by, "x", "idx", ["y"])
    met = at_ticks.where("near_x IS NOT NULL").select(*by, F.col("idx").cast("long").alias("idx"), F.col("near_x").alias("x"), F.col("near_y").alias("y"))
    few = known.join(many.where("__ticks > 2"), by, "left_anti")
    sizes = few.groupBy(*by).agg(F.greatest(F.floor(F.count("*") / most), F.lit(1)).alias("__step"))
    even = few.join(sizes, by).where(F.col("__i") % F.col("__step") == 0).select(*by, F.floor(F.col("__i") / F.col("__step")).cast("long").alias("idx"), "x", "y")
    return met.unionByName(even)


def line_states(points: DataFrame, clips: DataFrame) -> DataFrame:
    """States of line charts: one a point with a value, in place of what their clips had, all of them in the final table.

    points: (clip_id, line, idx, series, x_label, value), in the order of
    lines and points; clips: (clip_id, at, frame_id, path, unit,
    series_label) of the frame. A point goes by its x label, else its number.
    """
    from ..functions.scalars import slug

    some = lambda c: F.nullif(F.col(c), F.lit(""))
    name = F.coalesce(some("series"), some("series_label"), F.lit("series"))
    place = F.row_number().over(Window.partitionBy("clip_id").orderBy("line", "idx")).cast("long")
    rows = points.where("value IS NOT NULL").join(clips, "clip_id", "left").withColumns({"place": place, "entity": name, "state_key": F.coalesce(some("x_label"), F.col("idx").cast("string"))})
    frame = F.array(F.struct("frame_id", F.col("at").alias("time_seconds"), "path")).cast(f"array<{FRAME}>")
    return rows.select(
        "clip_id", "place", F.format_string("state_%03d", "place").alias("state_id"), "state_key", F.col("state_key").alias("state_label"), F.when(F.col("entity").rlike("(?i)[a-z0-9]"), slug(F.col("entity"))).otherwise("series").alias("entity_id"), "entity",
        F.lit("").alias("metric"), "value", F.coalesce("unit", F.lit("")).alias("unit"), F.lit("estimated").alias("value_type"), F.lit(LINE).alias("source_type"), F.col("at").alias("state_start"), F.col("at").alias("state_end"),
        frame.alias("evidence_frames"), F.lit(None).cast("string").alias("evidence_sentence_id"), F.lit(LINE_CONFIDENCE).alias("confidence"), F.lit("machine").alias("review_status"), F.lit(True).alias("needs_review"),
    )


def line_summary(states: DataFrame, clips: DataFrame) -> DataFrame:
    """What line_states() amounts to for each clip: no changes, complete if there is a point, dynamic if there are two."""
    counts = clips.select("clip_id").distinct().join(states.groupBy("clip_id").agg(F.count("*").alias("n")), "clip_id", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    some = F.col("n") > 0
    return counts.select(
        "clip_id", F.col("n").alias("n_states"), F.col("n").alias("numeric_fact_count"), F.when(some, "complete").otherwise("none").alias("data_completeness"), F.lit(0).cast("long").alias("data_change_count"),
        (F.col("n") > 1).alias("dynamic_data"), some.alias("include_in_dataset"), F.when(~some, NO_DATA).alias("exclude_reason"),
    )


def replaced(states: DataFrame, others: DataFrame, clips: DataFrame) -> DataFrame:
    """states with those of the clips taken from others: a clip's facts are of one kind."""
    return states.join(clips.select("clip_id").distinct(), "clip_id", "left_anti").unionByName(others.join(clips.select("clip_id").distinct(), "clip_id", "left_semi"), allowMissingColumns=True)


def axis_tick_keys(rows: DataFrame, at: str, entity: str, value: str) -> DataFrame:
    """(at, entity) whose set of at least two values another entity shares at the time: axis labels, not data."""
    sets = rows.where(F.col(value).isNotNull()).groupBy(at, entity).agg(F.array_sort(F.collect_set(value)).alias("values")).where(F.size("values") >= 2)
    same = F.count("*").over(Window.partitionBy(at, "values"))
    return sets.withColumn("same", same).where("same > 1").select(at, entity)


def without_axis_ticks(rows: DataFrame, at: str, entity: str, value: str) -> DataFrame:
    return rows.join(axis_tick_keys(rows, at, entity, value), [at, entity], "left_anti")


def plan_states(states: DataFrame, clips: DataFrame, limit: int = 8) -> tuple[DataFrame, DataFrame]:
    """Which states to make keyframes for: (clip_id, should_save, reason), and (clip_id, state_id, ...) of those to make.

    states have ids; clips: (clip_id, chart_type, include_in_dataset,
    dynamic_data). A state is complete if all its facts have a number and
    evidence. A clip needs two such states, the first and last of which
    differ; at most `limit`, evenly spaced, are planned, each with the latest
    frame of its evidence. States that all show one frame are the marks of a
    static chart if that is a line, area or scatter chart or no state has a
    key.
    """
    from .ordering import pick_evenly

    shown = F.array_sort(F.filter(F.flatten(F.transform("__rows", lambda r: F.coalesce(r["evidence_frames"], F.array().cast(f"array<{FRAME}>")))), lambda f: f.isNotNull()), lambda a, b: F.when(_time(a) < _time(b), -1).when(_time(a) > _time(b), 1).otherwise(0))
    proven = F.coalesce(F.size("evidence_frames") > 0, F.lit(False)) | blank_to_null(F.col("evidence_sentence_id")).isNotNull()
    grouped = states.groupBy("clip_id", "state_id").agg(
        F.min(_start()).alias("state_start"),
        F.bool_and(F.col("value").isNotNull() & proven).alias("__complete"),
        F.array_sort(F.collect_list(F.struct("place", "state_key", "state_label", "evidence_frames"))).alias("__rows"),
        F.array_sort(F.collect_set("entity_id")).alias("entity_ids"),
        F.array_sort(F.collect_list(F.struct("entity_id", "metric", "value", "unit", "value_type"))).alias("signature"),
    )
    complete = grouped.where("__complete").withColumn("__shown", F.element_at(F.when(F.size(shown) > 0, shown), -1))
    first = F.get("__rows", F.lit(0))
    rows = complete.select(
        "clip_id", "state_id", "state_start", first["state_key"].alias("state_key"), F.coalesce(F.nullif(first["state_label"], F.lit("")), F.nullif(first["state_key"], F.lit("")), F.col("state_id")).alias("state_label"),
        F.col("__shown.time_seconds").alias("timestamp"), F.col("__shown.frame_id").alias("source_frame_id"), F.col("__shown.path").alias("source_frame_path"), "entity_ids", "signature",
    )
    at = F.struct("state_start", "state_id")
    ends = rows.groupBy("clip_id").agg(F.count("*").alias("__n"), F.min_by("signature", at).alias("__a"), F.max_by("signature", at).alias("__z"))
    planned = pick_evenly(rows, ["clip_id"], [F.col("state_start"), F.col("state_id")], max(2, limit))
    frame = F.struct(F.coalesce(F.nullif("source_frame_id", F.lit("")), F.col("source_frame_path")).alias("f"), "timestamp")
    evidence = planned.groupBy("clip_id").agg(F.countDistinct(frame).alias("__frames"), F.bool_or(F.coalesce(F.col("state_key") != "", F.lit(False))).alias("__keyed"), F.bool_or(F.col("timestamp").isNull() & F.nullif("source_frame_path", F.lit("")).isNull()).alias("__unseen"))
    met = clips.join(ends, "clip_id", "left").join(evidence, "clip_id", "left")
    reason = (
        F.when(~F.coalesce(F.col("include_in_dataset") & F.col("dynamic_data"), F.lit(False)), "not_dynamic_recovered_data")
        .when(F.coalesce("__n", F.lit(0)) < 2, "fewer_than_two_complete_evidenced_data_states")
        .when(F.col("__a") == F.col("__z"), "no_entity_or_value_change")
        .when((F.col("__frames") <= 1) & (F.coalesce(F.lower("chart_type"), F.lit("")).isin("line", "area", "scatter") | ~F.col("__keyed")), "static_chart_points_from_single_visual_frame")
        .when(F.col("__unseen"), "missing_visual_frame_evidence")
        .otherwise(SELECTED)
    )
    plans = met.select("clip_id", reason.alias("reason")).withColumn("should_save", F.col("reason") == SELECTED)
    return plans, planned.join(plans.where("should_save").select("clip_id"), "clip_id", "left_semi")


#: The reason of a plan that is carried out: a fixed value.
SELECTED = "complete_evidenced_data_states_selected"


def _time(frame: Column) -> Column:
    return F.coalesce(frame["time_seconds"], F.lit(-1.0))


def _state_key() -> Column:
    """The name a state goes by: its key, label or id."""
    some = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(some("state_key"), some("state_label"), some("state_id"))


def intent(states: DataFrame) -> DataFrame:
    """Of each entity in both the first and the last state of its clip, which way it went: (clip_id, entity_id, ..., direction).

    States go by year where their name has one, else by start, then name; a
    clip needs two. Of an entity's values in a state the surest counts, then
    the first. Entities without a number or name don't count.
    """
    named = states.withColumn("state", _state_key()).where("state IS NOT NULL")
    year = F.nullif(F.regexp_extract("state", "(?:19|20)[0-9]{2}", 0), F.lit("")).cast("double")
    groups = named.groupBy("clip_id", "state").agg(F.min(_start()).alias("start"), F.min("state_start").alias("shown"))
    at = F.struct(year.isNull().alias("plain"), F.coalesce(year, F.lit(0.0)).alias("year"), "start", "state")
    which = F.struct("state", "shown")
    ends = groups.groupBy("clip_id").agg(F.min_by(which, at).alias("a"), F.max_by(which, at).alias("z"), F.count("*").alias("n")).where("n > 1")
    sure = F.struct(F.coalesce("confidence", F.lit(0.0)).alias("c"), (-F.col("place")).alias("p"))
    best = named.where("value IS NOT NULL AND entity_id <> '' AND entity_id <> 'unknown'").groupBy("clip_id", "state", "entity_id").agg(F.max_by(F.struct("value", "entity", "metric", "unit", "place"), sure).alias("r"))
    side = lambda e: best.join(ends.select("clip_id", F.col(f"{e}.state").alias("state"), F.col(f"{e}.shown").alias(f"{e}_shown")), ["clip_id", "state"]).withColumnsRenamed({"state": f"{e}_state", "r": e})
    delta = F.col("last_value") - F.col("first_value")
    direction = F.when(F.abs(delta) < 1e-9, "unchanged").when(delta > 0, "up").otherwise("down")
    return side("a").join(side("z"), ["clip_id", "entity_id"]).select(
        "clip_id", "entity_id", F.coalesce(F.nullif("a.entity", F.lit("")), F.col("entity_id")).alias("entity"), F.col("a.metric").alias("metric"), F.col("a.unit").alias("unit"), F.col("a.place").alias("place"),
        F.col("a.value").alias("first_value"), F.col("z.value").alias("last_value"), "a_state", "z_state", "a_shown", "z_shown",
    ).withColumn("direction", direction)


#: Metric names that say nothing: fixed values.
NO_METRIC = ["", "指标", "value", "Value", "metric", "Metric", "unknown"]


def reconciled(clips: DataFrame, states: DataFrame) -> DataFrame:
    """Clips (clip_id, chart_type) with what their data says of the animation: data_direction, actions, evidence, deltas.

    mixed where entities go both ways, else increase or decrease; clips
    without a change in a common entity keep nulls, as their report stands.
    The metric is the first common entity's, unless its name says nothing.
    """
    moved = intent(states)
    up, down = F.bool_or(F.col("direction") == "up"), F.bool_or(F.col("direction") == "down")
    told = moved.groupBy("clip_id").agg(
        up.alias("up"), down.alias("down"), F.count_if(F.col("direction") != "unchanged").alias("data_delta_count"), F.min_by("metric", "place").alias("metric"),
        F.first("a_state").alias("first_state"), F.first("z_state").alias("last_state"), F.first("a_shown").alias("a"), F.first("z_shown").alias("z"),
    ).where("up OR down")
    lined = F.lower("chart_type").isin("line", "area")
    action = lambda line, bar: F.when(lined, line).otherwise(bar)
    both = F.array_compact(F.array(F.when(F.col("up"), action("line_draw_upward", "bar_grow")), F.when(F.col("down"), action("line_draw_downward", "bar_shrink"))))
    met = clips.join(told, "clip_id", "left")
    return met.select(
        "clip_id",
        F.when(F.col("up") & F.col("down"), "mixed").when(F.col("up"), "increase").when(F.col("down"), "decrease").alias("data_direction"),
        F.when(F.col("up").isNotNull(), both).alias("actions"),
        F.when(F.col("up").isNotNull(), F.transform(F.array_compact(F.array("a", "z")), lambda t: F.round(t, 3))).alias("evidence_timestamps"),
        F.when(~F.trim("metric").isin(NO_METRIC), F.col("metric")).alias("metric"),
        "first_state", "last_state", "data_delta_count",
    )


def _label(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "")


#: The source of a value that was read off a frame's bars: a fixed value.
ALIGNED = "visual_frame_align"


def cleaned_states(states: DataFrame, bars: DataFrame, untimed: bool = True) -> DataFrame:
    """States without rows that bars (clip_id, entity_id) read off a frame, or the other rows, speak against.

    In this order: axis ticks; all but the best row of a label in a state,
    rows from bars before those of entities with bars, then the surest, then
    the first; captions of their own value; in a state with rows from bars,
    entities without a bar; rows whose metric is another entity's label,
    unless a bar has the entity; a single entity left alone that no bar has.
    Rows without a start are one moment, whose axis ticks go too, as in the
    reference; without `untimed` they are at no known one, and stay.
    """
    from .visual import embeds_own_value

    rows = states.withColumn("metric", sanitised_metric(F.col("metric"))).withColumn("entity_id", F.coalesce("entity_id", F.lit("")))
    seen = bars.where("entity_id <> ''").select("clip_id", "entity_id").distinct().withColumn("__bar", F.lit(True))
    barred = seen.select("clip_id").distinct().withColumn("__bars", F.lit(True))
    rows = rows.withColumn("__at", F.struct("clip_id", "state_start"))
    placed = rows.where("entity_id <> ''") if untimed else rows.where("entity_id <> '' AND state_start IS NOT NULL")
    rows = rows.join(axis_tick_keys(placed, "__at", "entity_id", "value"), ["__at", "entity_id"], "left_anti").drop("__at")
    rows = rows.join(seen, ["clip_id", "entity_id"], "left").join(barred, "clip_id", "left").withColumns({"__bar": F.coalesce("__bar", F.lit(False)), "__bars": F.coalesce("__bars", F.lit(False)), "__state": F.coalesce(_state_key(), F.lit("state"))})
    rows = rows.withColumns({"__label": _label(F.coalesce(F.nullif("entity", F.lit("")), F.col("entity_id"))), "__metric": _label(F.col("metric"))})
    labels = rows.select("clip_id", "__state", F.col("__label").alias("__metric")).distinct().withColumn("__taken", F.lit(True))
    rank = F.when(F.col("source_type") == ALIGNED, 2).otherwise(0) + F.col("__bar").cast("int")
    rows = first_rows(rows.where("__label NOT IN ('', 'unknown')"), ["clip_id", "__state", "__label"], [rank.desc(), F.coalesce("confidence", F.lit(0.0)).desc(), F.col("place")])
    rows = rows.where(~F.coalesce(embeds_own_value(F.col("entity"), F.col("value")), F.lit(False)))
    state = Window.partitionBy("clip_id", "__state")
    rows = rows.withColumn("__aligned", F.bool_or(F.col("source_type") == ALIGNED).over(state)).where("NOT (__aligned AND __bars) OR __bar")
    rows = rows.join(labels, ["clip_id", "__state", "__metric"], "left").where("__taken IS NULL OR __bar")
    rows = rows.withColumn("__n", F.size(F.collect_set("entity_id").over(state))).withColumn("__any", F.bool_or("__bar").over(state))
    return rows.where("__n > 1 OR __any OR entity_id = ''").select(*states.columns)


def covers(start: Column, end: Column, at: Column, slack: float = 0.01) -> Column:
    """Whether a state covers a time, give or take; one without an end is a moment, one without a start covers nothing."""
    return F.coalesce(at.between(start - slack, F.coalesce(end, start) + slack), F.lit(False))


def upsert_bars(states: DataFrame, bars: DataFrame, clips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """States with the values of bars, and the bars skipped: (states with `action`), (clip_id, entity_id, idx, reason).

    clips: (clip_id, at, tick_unit, frame_id, path) of the frame; bars:
    (clip_id, idx, entity_id, label, value, value_text, value_type,
    value_estimated, value_plausible, plausibility_message). A bar without a
    plausible number is skipped. Others set the first state of their entity
    that covers the frame's time, or make one after the clip's state there,
    the nearest one, or none at all. An empty unit becomes the ticks'.
    """
    named = bars.where(F.coalesce(F.col("entity_id"), F.lit("")) != "")
    bad = F.col("value").isNull() | ~F.coalesce("value_plausible", F.lit(True))
    skipped = named.where(bad).select("clip_id", "entity_id", "idx", F.coalesce(F.nullif("plausibility_message", F.lit("")), F.lit("no numeric value")).alias("reason"))
    estimated = F.coalesce("value_estimated", F.lit(False))
    last = F.struct("idx", "label", "value", "value_text", F.coalesce(F.nullif("value_type", F.lit("")), F.lit("exact")).alias("value_type"))
    good = named.where(~bad).groupBy("clip_id", "entity_id").agg(F.max_by(last, "idx").alias("bar"), F.max(F.when(estimated, 0.7).otherwise(0.85)).alias("sure"), F.min("idx").alias("first"))
    good = good.join(clips, "clip_id")
    met = states.join(good.select("clip_id", "entity_id", "at"), ["clip_id", "entity_id"])
    target = met.where(F.col("at").isNull() | covers(F.col("state_start"), F.col("state_end"), F.col("at"))).groupBy("clip_id", "entity_id").agg(F.min("place").alias("place"))
    good = good.join(target.withColumnRenamed("place", "target"), ["clip_id", "entity_id"], "left")

    def put(rows: DataFrame) -> DataFrame:
        unit = F.lower(F.trim(F.coalesce("unit", F.lit("")))).isin("", "none", "unknown", "unit") & (F.trim(F.coalesce("tick_unit", F.lit(""))) != "")
        frame = F.array(F.struct("frame_id", F.col("at").alias("time_seconds"), "path")).cast(f"array<{FRAME}>")
        return rows.withColumns(
            {
                "value": F.col("bar.value"), "value_type": F.col("bar.value_type"), "source_type": F.lit(ALIGNED), "confidence": F.greatest(F.coalesce("confidence", F.lit(0.0)), "sure"), "review_status": F.lit("machine"),
                "raw_text": F.col("bar.value_text"), "evidence_text": F.coalesce(F.nullif("bar.value_text", F.lit("")), F.col("bar.value").cast("string")), "unit": F.when(unit, F.trim("tick_unit")).otherwise(F.col("unit")),
                "evidence_frames": frame, "evidence_sentence_id": F.lit(None).cast("string"),
            }
        )

    found = good.where("target IS NOT NULL").select("clip_id", F.col("target").alias("place"), "bar", "sure", "at", "tick_unit", "frame_id", "path")
    hit = states.join(found.withColumn("__hit", F.lit(True)), ["clip_id", "place"], "left").withColumn("action", F.when(F.col("__hit"), "updated").otherwise("kept"))
    kept, updated = hit.where("action = 'kept'"), put(hit.where("action = 'updated'"))

    # A new row follows the clip's state at the time, or the nearest one.
    new = good.where("target IS NULL").drop("target")
    there = covers(F.col("state_start"), F.col("state_end"), F.col("at"))
    far = F.when(F.col("at").isNull() | there, 0.0).otherwise(F.abs(_start() - F.col("at")))
    own = [c for c in states.columns if c not in ("clip_id", "entity_id", "entity", "state_start", "state_end", "place")]
    place = F.struct((~there & F.col("at").isNotNull()).alias("beside"), far.alias("far"), "place")
    template = states.join(new.select("clip_id", "at").distinct(), "clip_id").groupBy("clip_id").agg(F.min_by(F.struct(*own, "state_start", "state_end"), place).alias("like"), F.max("place").alias("most"))
    made = new.join(template, "clip_id", "left")
    blank = {"state_id": F.lit("state_001"), "metric": F.lit(""), "unit": F.lit(""), "confidence": F.lit(0.7)}
    like = [F.when(F.col("like").isNull(), blank.get(c, F.lit(None))).otherwise(F.col(f"like.{c}")).cast(states.schema[c].dataType).alias(c) for c in own]
    at = lambda c: F.coalesce("at", f"like.{c}").alias(c)
    number = F.row_number().over(Window.partitionBy("clip_id").orderBy("first"))
    made = made.select(
        "clip_id", "entity_id", F.coalesce(F.nullif("bar.label", F.lit("")), F.col("entity_id")).alias("entity"), at("state_start"), at("state_end"),
        (F.coalesce("most", F.lit(0)) + number).cast("long").alias("place"), *like, "bar", "sure", "at", "tick_unit", "frame_id", "path", F.lit("created").alias("action"),
    )
    columns = [*states.columns, "action"]
    return kept.select(columns).unionByName(updated.select(columns)).unionByName(put(made).select(columns)), skipped
