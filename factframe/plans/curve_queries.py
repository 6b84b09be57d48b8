"""Queries over marks on axes, points of curves and frames near a clip's end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curves, facts, series
from .adapters import micros, read

_DAY = 86_400_000_000
_BY = ["user_id", "event_type"]


def _marks(spark: SparkSession, d: str) -> DataFrame:
    """The values of a user's events of a type as marks on an axis."""
    return read(spark, d, "events").select(*_BY, F.floor("value").cast("double").alias("v"), (F.col("user_id") % 7 + 2).alias("labels"))


def _listed(column: str) -> Column:
    """Numbers as text, to a thousandth."""
    return F.array_join(F.transform(column, lambda x: F.round(x * 1000).cast("long").cast("string")), ",")


def even_series(spark: SparkSession, d: str) -> DataFrame:
    return curves.dominant_even(_marks(spark, d), _BY, "v").select(*_BY, _listed("series").alias("series"))


def even_grid(spark: SparkSession, d: str) -> DataFrame:
    return curves.rebuilt_grid(_marks(spark, d), _BY, "v", "labels").select(*_BY, _listed("grid").alias("grid"))


def mean_clusters(spark: SparkSession, d: str) -> DataFrame:
    return curves.merged_marks(_marks(spark, d), _BY, "v").select(*_BY, _listed("marks").alias("marks"))


def _curve(spark: SparkSession, d: str) -> DataFrame:
    """A user's values over the hours."""
    return read(spark, d, "events").select("user_id", "event_id", (micros("ts") / 3.6e9).alias("x"), F.floor("value").cast("double").alias("y"))


def simple_line(spark: SparkSession, d: str) -> DataFrame:
    found = curves.simplified(_curve(spark, d), ["user_id"], "x", "y", ["x", "event_id"], 40.0)
    return found.select("user_id", F.inline("line")).select("user_id", "x", "y")


def traced_path(spark: SparkSession, d: str) -> DataFrame:
    """A path through a user's values, a third of a day being a column."""
    cells = read(spark, d, "events").select("user_id", F.floor(micros("ts") * 3 / _DAY).cast("long").alias("x"), F.floor("value").cast("double").alias("y"))
    return curves.traced(cells, ["user_id"], "x", "y").select("user_id", F.inline("path")).select("user_id", F.col("x").cast("long").alias("x"), "y")


def tail_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Users as clips as long as their last frame and a little more."""
    frames = read(spark, d, "events").select("user_id", (F.col("event_id") % 97 / 10).alias("at"))
    clips = frames.groupBy("user_id").agg((F.max("at") + F.col("user_id") % 8 / 10).alias("duration"))
    return series.tail_candidates(frames.where("user_id % 5 <> 0"), clips, ["user_id"], "at", "duration", 4.0)


def _path(spark: SparkSession, d: str) -> DataFrame:
    """A user's largest value an hour as a traced line."""
    return read(spark, d, "events").groupBy("user_id", F.floor(micros("ts") / 3_600_000_000).cast("double").alias("x")).agg(F.floor(F.max("value")).cast("double").alias("y"))


def curve_points(spark: SparkSession, d: str) -> DataFrame:
    """Lines at the hours of purchases on some days, and every few points of those with fewer of them."""
    ticks = read(spark, d, "events").where("event_type = 'purchase' AND event_id % 4 = 0").select("user_id", (micros("ts") / 3.6e9).alias("tick")).distinct()
    return facts.curve_points(_path(spark, d), ticks, ["user_id"])


def _line(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Points of lines, a user being a clip and an event type a line, some without a value or label; the clips' frames."""
    rows = read(spark, d, "events")
    points = rows.select(
        F.col("user_id").alias("clip_id"), F.col("event_type").alias("line"), F.col("event_id").alias("idx"), F.when(F.col("user_id") % 3 != 0, F.initcap("event_type")).alias("series"),
        F.when(F.col("event_id") % 4 != 0, F.date_format("ts", "MM-dd")).alias("x_label"), F.when((F.col("event_id") % 5 != 0) & (F.col("user_id") % 10 != 0), F.floor("value").cast("double")).alias("value"),
    )
    clips = rows.groupBy(F.col("user_id").alias("clip_id")).agg((F.max(micros("ts")) / 1e6).alias("at")).select("clip_id", "at", F.lit("key").alias("frame_id"), F.lit(None).cast("string").alias("path"), F.when(F.col("clip_id") % 2 == 0, "%").alias("unit"), F.when(F.col("clip_id") % 6 == 0, "Net additions").alias("series_label"))
    return points, clips


def line_states(spark: SparkSession, d: str) -> DataFrame:
    return facts.line_states(*_line(spark, d)).select("clip_id", "state_id", "state_key", "entity_id", "entity", "value", "unit", "state_start", "confidence", "needs_review")


def line_summary(spark: SparkSession, d: str) -> DataFrame:
    points, clips = _line(spark, d)
    return facts.line_summary(facts.line_states(points, clips), clips)


QUERIES = {f.__name__: f for f in (even_series, even_grid, mean_clusters, simple_line, traced_path, tail_candidates, curve_points, line_states, line_summary)}

_MARKS = "SELECT user_id, event_type, list_sort(list(floor(value)::DOUBLE)) AS v, any_value(user_id % 7 + 2) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2"
_LIST = "coalesce(array_to_string(list_transform({}, lambda x: round(x * 1000)::BIGINT::VARCHAR), ','), '')"
_UP = "list_reduce(v, lambda s, x: CASE WHEN abs(x - s.e) <= 0.45::DOUBLE * step THEN {{'e': s.e + step, {}}} ELSE s END, {{'e': a, {}}})"
_FAR = """list_transform(range(a + 1, z), lambda i: CASE WHEN (p[z].x - p[a].x) ** 2 + (p[z].y - p[a].y) ** 2 = 0 THEN sqrt((p[i].x - p[a].x) ** 2 + (p[i].y - p[a].y) ** 2) ELSE
  sqrt((p[i].x - p[a].x - (p[z].x - p[a].x) * {0}) ** 2 + (p[i].y - p[a].y - (p[z].y - p[a].y) * {0}) ** 2) END)""".format(
    "greatest(0, least(1, ((p[i].x - p[a].x) * (p[z].x - p[a].x) + (p[i].y - p[a].y) * (p[z].y - p[a].y)) / ((p[z].x - p[a].x) ** 2 + (p[z].y - p[a].y) ** 2)))"
)
_TAIL_TIMES = "list_transform([0.75, 0.5, 0.25, 0.05]::DOUBLE[], lambda o: greatest(0, least(duration - 0.05::DOUBLE, duration - o)))"

_LINE = """WITH p AS (SELECT user_id AS clip_id, event_type AS line, event_id AS idx, CASE WHEN user_id % 3 <> 0 THEN upper(event_type[1]) || event_type[2:] WHEN user_id % 6 = 0 THEN 'Net additions' ELSE 'series' END AS entity,
  CASE WHEN event_id % 4 <> 0 THEN strftime(ts, '%m-%d') ELSE event_id::VARCHAR END AS state_key, CASE WHEN event_id % 5 <> 0 AND user_id % 10 <> 0 THEN floor(value)::DOUBLE END AS value FROM events),
c AS (SELECT user_id AS clip_id, max(epoch_us(ts)) / 1e6::DOUBLE AS tm FROM events GROUP BY 1), s AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY line, idx) AS place FROM p JOIN c USING (clip_id) WHERE value IS NOT NULL)"""

ORACLES = {
    "curve_points": """WITH p AS (SELECT user_id, (epoch_us(ts) // 3600000000)::DOUBLE AS x, floor(max(value))::DOUBLE AS y FROM events GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM p),
t AS (SELECT user_id, tick, row_number() OVER (PARTITION BY user_id ORDER BY tick) - 1 AS idx, count(*) OVER (PARTITION BY user_id) AS ticks FROM (SELECT DISTINCT user_id, epoch_us(ts) / 3.6e9::DOUBLE AS tick FROM events WHERE event_type = 'purchase' AND event_id % 4 = 0)),
k AS (SELECT user_id, idx, x, y FROM t JOIN p USING (user_id) WHERE ticks > 2 QUALIFY row_number() OVER (PARTITION BY user_id, idx ORDER BY abs(x - tick), x) = 1)
SELECT user_id, idx, x, y FROM k UNION ALL SELECT user_id, i // greatest(n // 10, 1), x, y FROM n WHERE i % greatest(n // 10, 1) = 0 AND NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = n.user_id AND ticks > 2)""",
    "line_states": _LINE + " SELECT clip_id, printf('state_%03d', place) AS state_id, state_key, replace(lower(entity), ' ', '-') AS entity_id, entity, value, CASE WHEN clip_id % 2 = 0 THEN '%' ELSE '' END AS unit, tm AS state_start, 0.7::DOUBLE AS confidence, true AS needs_review FROM s",
    "line_summary": _LINE + " SELECT clip_id, count(value) AS n_states, count(value) AS numeric_fact_count, CASE WHEN count(value) > 0 THEN 'complete' ELSE 'none' END AS data_completeness, 0::BIGINT AS data_change_count, count(value) > 1 AS dynamic_data, count(value) > 0 AS include_in_dataset, CASE WHEN count(value) = 0 THEN 'no_recoverable_quantitative_data' END AS exclude_reason FROM p GROUP BY 1",
    "even_series": f"""WITH g AS ({_MARKS}), i AS (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM g WHERE len(v) > 2), j AS (SELECT *, unnest(range(i + 2, len(v) + 1)) AS j FROM i),
s AS (SELECT user_id, event_type, v, i, j, v[i] AS a, (v[j] - v[i]) / (j - i)::DOUBLE AS step FROM j), c AS (SELECT *, ({_UP.format("'n': s.n + 1", "'n': 0::BIGINT")}).n AS hits FROM s WHERE step >= 8),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY hits DESC, i, j) = 1),
f AS (SELECT user_id, event_type, ({_UP.format("'l': list_append(s.l, x)", "'l': []::DOUBLE[]")}).l AS l FROM b)
SELECT user_id, event_type, {_LIST.format("CASE WHEN len(v) < 3 THEN v ELSE l END")} AS series FROM g LEFT JOIN f USING (user_id, event_type)""",
    "even_grid": f"""WITH g AS ({_MARKS}), d AS (SELECT *, list_filter(list_transform(range(1, len(v)), lambda i: v[i + 1] - v[i]), lambda x: x > 0) AS gaps FROM g),
s AS (SELECT user_id, event_type, unnest(list_distinct(list_prepend(list_min(gaps), list_filter(flatten(list_transform(gaps, lambda x: [x / 2, x / 3, x / 4])), lambda x: x >= 8)))) AS step FROM d WHERE len(gaps) > 0 AND n > 1),
c AS (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM s JOIN d USING (user_id, event_type)),
h AS (SELECT user_id, event_type, step, i, v[i] AS a, n, len(list_filter(v, lambda x: len(list_filter(range(n), lambda k: abs(x - (v[i] + k * step)) < 14)) > 0)) AS score FROM c),
b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY score DESC, step, i) = 1)
SELECT user_id, event_type, {_LIST.format("CASE WHEN score > 1 THEN list_transform(range(b.n), lambda k: a + k * step) ELSE v END")} AS grid FROM g LEFT JOIN b USING (user_id, event_type)""",
    "mean_clusters": f"""WITH g AS ({_MARKS}) SELECT user_id, event_type, {_LIST.format("list_reduce(v, lambda s, x: CASE WHEN len(s) > 0 AND x - s[-1] <= 10 THEN list_append(s[:-2], (s[-1] + x) / 2) ELSE list_append(s, x) END, []::DOUBLE[])")} AS marks FROM g""",
    "simple_line": f"""WITH RECURSIVE g AS (SELECT user_id, list({{'x': x, 'y': y}} ORDER BY x, event_id) AS p FROM (SELECT user_id, event_id, epoch_us(ts) / 3.6e9::DOUBLE AS x, floor(value)::DOUBLE AS y FROM events WHERE ts IS NOT NULL AND value IS NOT NULL) GROUP BY 1),
s AS (SELECT user_id, 1::BIGINT AS a, len(p)::BIGINT AS z FROM g WHERE len(p) > 1
  UNION ALL SELECT user_id, unnest([a, m]) AS a, unnest([m, z]) AS z FROM (SELECT user_id, a, z, a + list_position(far, list_max(far)) AS m, list_max(far) AS most FROM (SELECT s.*, {_FAR} AS far FROM s JOIN g USING (user_id) WHERE z - a > 1)) WHERE most > 40),
k AS (SELECT DISTINCT user_id, i FROM (SELECT user_id, unnest([a, z]) AS i FROM s UNION ALL SELECT user_id, 1 FROM g))
SELECT user_id, p[i].x AS x, p[i].y AS y FROM k JOIN g USING (user_id)""",
    "traced_path": f"""WITH RECURSIVE c AS (SELECT user_id, (epoch_us(ts) * 3) // {_DAY} AS x, list_sort(list(DISTINCT floor(value)::DOUBLE)) AS ys FROM events WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT floor(value)) <= 14),
l AS (SELECT *, row_number() OVER w AS k, lag(x) OVER w AS x0, lag(ys) OVER w AS y0 FROM c WINDOW w AS (PARTITION BY user_id ORDER BY x)),
e AS (SELECT *, coalesce(x - x0 <= 3, false) AS linked, list_transform(ys, lambda y: list_transform(y0, lambda o: least(abs(y - o), 75) + 80 * (x - x0 - 1))) AS each FROM l),
b AS (SELECT *, CASE WHEN linked THEN list_transform(each, lambda r: list_position(r, list_min(r))) END AS link, CASE WHEN linked THEN list_transform(each, lambda r: list_min(r)) ELSE list_transform(ys, lambda y: 0.0) END AS cost FROM e),
t AS (SELECT user_id, k, x, list_position(cost, list_min(cost)) AS pick FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY k DESC) = 1
  UNION ALL SELECT b.user_id, b.k, b.x, CASE WHEN a.linked THEN a.link[t.pick] ELSE list_position(b.cost, list_min(b.cost)) END FROM t JOIN b a ON a.user_id = t.user_id AND a.k = t.k JOIN b ON b.user_id = t.user_id AND b.k = t.k - 1)
SELECT t.user_id, t.x::BIGINT AS x, ys[pick] AS y FROM t JOIN b USING (user_id, k)""",
    "tail_candidates": f"""WITH RECURSIVE f AS (SELECT user_id, event_id % 97 / 10.0::DOUBLE AS tm FROM events), c AS (SELECT user_id, max(tm) + user_id % 8 / 10.0::DOUBLE AS duration FROM f GROUP BY 1),
o AS (SELECT user_id, {_TAIL_TIMES} AS ts, coalesce((SELECT list(tm) FROM f WHERE f.user_id = c.user_id AND user_id % 5 <> 0), []) AS seen FROM c),
r AS (SELECT user_id, ts, 1 AS n, seen, []::DOUBLE[] AS added, NULL::INTEGER AS made FROM o
  UNION ALL SELECT user_id, ts, n + 1, seen, CASE WHEN near THEN added ELSE list_append(added, ts[n]) END, CASE WHEN NOT near THEN n END FROM (SELECT *, len(list_filter(list_concat(seen, added), lambda x: abs(ts[n] - x) <= 0.125)) > 0 AS near FROM r WHERE n <= 4))
SELECT user_id, made AS n, ts[made] AS at FROM r WHERE made IS NOT NULL""",
}
