"""What a chart shows, told from its states: the marks of one moment, unit, axis and title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import slug

#: The source of states that a frame has confirmed, units that say nothing, and metrics that a title can't be made of: fixed values.
ALIGNED = "visual_frame_align"
NO_UNIT = ["none", "unknown", "unit"]
PLACEHOLDERS = ["value", "price", "cost", "amount", "metric"]
#: A line of text that may be a title has more characters than this.
TITLE_CHARS = 15


def _filled(column: str) -> Column:
    return F.nullif(F.col(column).cast("string"), F.lit(""))


def shown_marks(states: DataFrame) -> DataFrame:
    """The marks of each clip's best moment: (clip_id, n, name, entity_id, metric, value, unit, moment, clip_metric), n from 1 in order.

    states: with_state_ids()'s rows. Those without an entity or a number are
    left out. A moment is a state key, else its label, else its id; up to the
    first state with a key, all states are of one moment, `state`. Moments
    that a frame has confirmed go first, then those of most states, then the
    earliest. Of a confirmed one, only names that the frame has are kept. Of
    a name and metric, the confirmed state counts, then the surest, then the
    first. clip_metric is the last metric of the clip, whatever the moment.
    """
    value = F.col("value").isNotNull() & ~F.isnan("value")
    rows = states.where(value & ~F.coalesce("entity_id", F.lit("")).isin("", "unknown"))
    by_place = lambda column: F.when(_filled(column).isNotNull(), F.col("place"))
    clips = rows.groupBy("clip_id").agg(F.min(by_place("state_key")).alias("__since"), F.max_by("metric", by_place("metric")).alias("clip_metric"))
    moment = F.when(F.col("place") >= F.col("__since"), F.coalesce(_filled("state_key"), _filled("state_label"), _filled("state_id")))
    name = F.coalesce(_filled("entity"), "entity_id")
    rows = rows.join(clips, "clip_id").select(
        "clip_id", "place", F.coalesce(moment, F.lit("state")).alias("moment"), name.alias("name"), slug(name, "item").alias("__mark"), slug(F.coalesce("metric", F.lit("")), "item").alias("__kind"),
        "entity_id", F.coalesce("metric", F.lit("")).alias("metric"), "value", "unit", F.coalesce(F.col("source_type") == ALIGNED, F.lit(False)).alias("__seen"), F.coalesce("confidence", F.lit(0.0)).alias("__sure"), "clip_metric",
    )
    moments = rows.groupBy("clip_id", "moment").agg(F.bool_or("__seen").alias("__any"), F.count("*").alias("n"), F.min("place").alias("first"))
    best = moments.groupBy("clip_id").agg(F.max_by(F.struct("moment", "__any"), F.struct("__any", "n", -F.col("first"))).alias("m")).select("clip_id", "m.*")
    own = F.struct("name", "entity_id", "metric", "value", "unit", "clip_metric")
    marks = rows.join(best, ["clip_id", "moment"]).groupBy("clip_id", "moment", "__any", "__mark", "__kind").agg(
        F.max_by(own, F.struct("__seen", "__sure", -F.col("place"))).alias("own"), F.bool_or("__seen").alias("__seen"), F.min("place").alias("__first")
    )
    named = F.max("__seen").over(Window.partitionBy("clip_id", "__mark"))
    marks = marks.withColumn("__named", named).where(F.col("__mark") != "unknown").where(~F.col("__any") | F.col("__named"))
    number = F.row_number().over(Window.partitionBy("clip_id").orderBy("__first")).cast("long")
    return marks.select("clip_id", number.alias("n"), "own.name", "own.entity_id", "own.metric", "own.value", "own.unit", "moment", "own.clip_metric")


def chart_metadata(states: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Charts, (clip_id, title, unit, y_axis, moment, n_marks), and their marks, of shown_marks().

    lines: (clip_id, ord, line), the text seen on the clip. The unit is the
    first that a mark has, else % where a line has it or the word. The axis
    is the clip's metric, or Value where a mark has that name. The title is
    the metric; of one that says nothing, the longest line of more than
    TITLE_CHARS characters with a letter, the first of equals. The moment is
    added in brackets if it is a number of two to four digits that a line
    has. Clips without a mark have no row.
    """
    marks = shown_marks(states)
    unit = F.trim(F.coalesce("unit", F.lit("")))
    told = F.when(~F.lower(unit).isin("", *NO_UNIT), F.col("n"))
    charts = marks.groupBy("clip_id").agg(
        F.min_by(unit, told).alias("unit"), F.first("moment").alias("moment"), F.count("*").alias("n_marks"),
        F.coalesce(F.first("clip_metric"), F.lit("Value")).alias("metric"), F.bool_or(slug(F.col("name"), "item") == slug(F.coalesce("clip_metric", F.lit("Value")), "item")).alias("named"),
    )
    charts = charts.withColumn("metric", F.when(F.col("named"), "Value").otherwise(F.col("metric"))).drop("named")
    long = F.when((F.length("line") > TITLE_CHARS) & F.col("line").rlike("[A-Za-z]"), F.struct(F.length("line"), -F.col("ord")))
    plain = F.regexp_replace(F.lower("line"), "[^a-z0-9]+", "")
    dated = F.col("moment").rlike(r"^[0-9]{2,4}$") & F.contains(plain, F.col("moment"))
    seen = lines.where("line IS NOT NULL").join(charts.select("clip_id", "moment"), "clip_id").groupBy("clip_id").agg(
        F.max_by("line", long).alias("longest"), F.bool_or(F.contains(F.col("line"), F.lit("%")) | F.contains(F.lower("line"), F.lit("percent"))).alias("percent"), F.bool_or(dated).alias("dated")
    )
    text = F.trim("metric")
    vague = ~text.rlike("[a-zA-Z]{3,}") | F.lower(text).isin(PLACEHOLDERS)
    title = F.coalesce(F.when(vague, F.col("longest")), text)
    out = charts.join(seen, "clip_id", "left").select(
        "clip_id", F.when(F.col("dated"), F.concat(title, F.lit(" ("), "moment", F.lit(")"))).otherwise(title).alias("title"),
        F.coalesce("unit", F.when(F.col("percent"), "%"), F.lit("")).alias("unit"), F.col("metric").alias("y_axis"), "moment", "n_marks",
    )
    return out, marks.drop("clip_metric")
