"""Queries over intervals, axes, anchors, years, dispatch and markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import joins, keyframes, ordering, quality
from .adapters import micros, read


def _days(c: str):  # noqa: ANN202
    return F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("double")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip_id"), "l_linenumber", _days("l_shipdate").alias("s_start"), F.when(F.col("l_linenumber") != 5, _days("l_shipdate") + F.col("l_quantity")).alias("s_end"))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("clip_id"), _days("o_orderdate").alias("r_start"), (_days("o_orderdate") + 365).alias("r_end"))


def closed_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Lines that touch a year from their order on; those without an end stay."""
    return joins.overlapping(_lines(spark, d), _orders(spark, d), ["clip_id"], ("s_start", "r_start"), ("s_end", "r_end"), closed=True, keep_missing=True, width=400.0, bounded=True).select("clip_id", "l_linenumber")


def contained_words(spark: SparkSession, d: str) -> DataFrame:
    return joins.contained(_lines(spark, d), _orders(spark, d), ["clip_id"], ("s_start", "r_start"), ("s_end", "r_end"), width=400.0).select("clip_id", "l_linenumber")


def sentence_at(spark: SparkSession, d: str) -> DataFrame:
    """The first line whose interval holds the 70th day of its order, and whether any does."""
    points = _orders(spark, d).select("clip_id", (F.col("r_start") + 70).alias("at"))
    found = joins.covering(points, _lines(spark, d), ["clip_id"], "at", "s_start", "s_end", "l_linenumber", 60.0)
    return found.select("clip_id", F.col("interval.l_linenumber").alias("l_linenumber"), F.col("interval").isNotNull().alias("in_any"))


def axis_values(spark: SparkSession, d: str) -> DataFrame:
    """Part sizes read on the axis of their brand, whose ticks are some of its parts."""
    parts = read(spark, d, "part").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("x"))
    ticks = read(spark, d, "part").where("p_partkey % 3 = 0").groupBy("p_brand", F.col("p_size").cast("double").alias("tick")).agg(F.max("p_retailprice").alias("v"))
    return joins.on_axis(parts, ticks, ["p_brand"], "x", "tick", "v").select("p_partkey", F.round("read", 4).alias("value"))


def anchor_frames(spark: SparkSession, d: str) -> DataFrame:
    frames = read(spark, d, "events").select("user_id", "event_id", micros("ts").alias("at"))
    return ordering.anchors(frames, ["user_id"], [F.col("at"), F.col("event_id")], 3).select("user_id", "event_id", "anchor")


def densest_attempt(spark: SparkSession, d: str) -> DataFrame:
    return ordering.densest(read(spark, d, "events"), ["user_id"], "event_type")


def year_ranks(spark: SparkSession, d: str) -> DataFrame:
    """A customer's orders by fiscal years and other labels."""
    year = F.year("o_orderdate")
    label = F.when(F.col("o_orderkey") % 3 == 0, fn.fiscal_label(year)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("in "), year.cast("string"))).otherwise(F.col("o_orderpriority"))
    rows = read(spark, d, "orders").select("o_custkey", "o_orderkey", label.alias("label"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*ordering.by_year(F.col("label")), "o_orderkey")).cast("long"))


_TYPES = ["bar", " Line", "DONUT", "sankey", "unheard of", None]


def chart_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """Processors of declared and recovered chart types, dealt out to orders."""
    kind = lambda n: F.element_at(F.array(*map(F.lit, _TYPES)), (n % len(_TYPES) + 1).cast("int"))
    found = fn.dispatch(kind(F.col("o_orderkey")), kind(F.floor(F.col("o_orderkey") / 6) + F.col("o_custkey")))
    return read(spark, d, "orders").select("o_orderkey", found.alias("f")).select("o_orderkey", "f.*")


def xml_texts(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as XML content, those with any text."""
    rows = read(spark, d, "conversations").where(fn.any_filled(F.col("role"), F.col("text")) & fn.kept(F.col("role") != "system"))
    return rows.select("conv_id", "turn", "role", F.sha2(fn.xml_escaped(F.col("text")), 256).alias("escaped"))


def bounded_frames(spark: SparkSession, d: str) -> DataFrame:
    """A user's clicks, with rows at the hours before and after all events where no click is."""
    frames = read(spark, d, "events").select("user_id", F.floor(micros("ts") / 3_600_000_000).alias("hour"), "event_type")
    clips = frames.groupBy("user_id").agg(F.min("hour").alias("start"), F.max("hour").alias("end"))
    return keyframes.with_bounds(frames.where("event_type = 'click'").select("user_id", "hour").distinct(), clips, ["user_id"], "hour")


def clip_issues(spark: SparkSession, d: str) -> DataFrame:
    """The rules over clips' files, orders standing for clips and their numbers for what the files say."""
    k, n = F.col("o_orderkey"), F.col("n_lines")
    none = F.lit(None).cast("string")
    lines = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    named = [*quality.REQUIRED, "semantic_state_input_manifest.json", "semantic_state_svg_manifest.json"]
    clips = read(spark, d, "orders").select("o_orderkey").join(lines, "o_orderkey", "left").select(
        k.alias("clip_id"), F.array_compact(F.array(*[F.when(k % (11 + i) != 0, f) for i, f in enumerate(named)])).alias("files"), F.array_compact(F.array(F.when(k % 29 == 0, "dynamic_data.json"), F.when(k % 31 == 0, "chart_data_validation.json"))).alias("bad_json"),
        (k % 5 != 0).alias("include"), (k % 4).alias("numeric_count"), F.when(k % 10 == 0, "no_recoverable_quantitative_data").otherwise(none).alias("exclude_reason"), n.alias("n_states"), (n % 3).alias("n_state_ids"),
        (k % 3).alias("n_events"), (k % 2 == 0).alias("dynamic"), F.when(k % 7 != 0, k % 35 != 0).alias("extractable"), (k % 6).alias("n_csv"), (k % 8).alias("n_final"), (k % 9 % 3).alias("n_event_csv"), (n > 3).alias("planned"),
        F.when(k % 13 == 0, F.array(F.struct((k % 2 == 0).alias("success"), none.alias("svg")))).alias("svgs"),
    )
    return quality.rule_issues(clips).select("clip_id", "severity", "issue_code", "artifact")


QUERIES = {f.__name__: f for f in (closed_overlap, contained_words, sentence_at, axis_values, anchor_frames, densest_attempt, year_ranks, chart_dispatch, xml_texts, bounded_frames, clip_issues)}

_L = """WITH s AS (SELECT l_orderkey AS clip_id, l_linenumber, date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::DOUBLE AS s_start, CASE WHEN l_linenumber <> 5 THEN date_diff('day', DATE '1970-01-01', l_shipdate::DATE) + l_quantity END AS s_end FROM lineitem),
r AS (SELECT o_orderkey AS clip_id, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE AS r_start FROM orders)"""
_KINDS = "list_extract(['bar', 'line', 'donut', 'sankey', 'unheard of', ''], ({}) % 6 + 1)"
_FAMILY = "CASE WHEN {0} IN ('bar', 'line', 'sankey') THEN {0} WHEN {0} = 'donut' THEN 'pie' ELSE 'unknown' END"


def _issue(severity: str, code: str, artifact: str, broken: str) -> str:
    return f"SELECT clip_id, '{severity}' AS severity, '{code}' AS issue_code, '{artifact}' AS artifact FROM k WHERE {broken}"


_FILES = [*quality.REQUIRED, "semantic_state_input_manifest.json", "semantic_state_svg_manifest.json"]
_READS = "k % 14 <> 0 AND k % 29 <> 0 AND "
_RULES = [
    *[_issue("hard_fail", "missing_required_file", f, f"k % {11 + i} = 0") for i, f in enumerate(quality.REQUIRED)],
    _issue("hard_fail", "missing_required_file", "dynamic_data.json", "k % 14 = 0"), _issue("hard_fail", "missing_required_file", "chart_data_validation.json", "k % 15 = 0"),
    _issue("hard_fail", "invalid_json", "dynamic_data.json", "k % 29 = 0"), _issue("hard_fail", "invalid_json", "chart_data_validation.json", "k % 31 = 0"),
    _issue("hard_fail", "included_without_numeric_facts", "dynamic_data.json", _READS + "k % 5 <> 0 AND k % 4 = 0"),
    _issue("needs_review", "excluded_without_standard_reason", "dynamic_data.json", _READS + "k % 5 = 0 AND k % 10 <> 0"),
    _issue("hard_fail", "included_without_states", "dynamic_data.json", _READS + "k % 5 <> 0 AND n = 0"),
    _issue("needs_review", "dynamic_flag_without_multiple_states_or_events", "dynamic_data.json", _READS + "k % 2 = 0 AND n % 3 < 2 AND k % 3 = 0"),
    _issue("needs_review", "validation_include_mismatch", "chart_data_validation.json", _READS + "k % 7 <> 0 AND (k % 35 <> 0) <> (k % 5 <> 0)"),
    _issue("hard_fail", "missing_dynamic_data_csv", "dynamic_data.csv", _READS + "k % 5 <> 0 AND k % 6 = 0"),
    _issue("hard_fail", "missing_final_data_table", "final_data_table.csv", _READS + "k % 5 <> 0 AND k % 8 = 0"),
    _issue("needs_review", "event_csv_json_count_mismatch", "data_change_events.csv", _READS + "k % 3 > 0 AND k % 9 % 3 <> k % 3"),
    _issue("needs_review", "missing_semantic_state_inputs", "semantic_state_input_manifest.json", _READS + "n > 3 AND k % 17 = 0"),
    _issue("needs_review", "missing_semantic_state_svgs", "semantic_state_svg_manifest.json", _READS + "n > 3 AND k % 18 = 0"),
    _issue("needs_review", "semantic_state_svg_failed", "semantic_state_svg_manifest.json", _READS + "k % 13 = 0 AND k % 2 = 1"),
]

ORACLES = {
    "closed_overlap": f"{_L} SELECT clip_id, l_linenumber FROM s JOIN r USING (clip_id) WHERE s_end IS NULL OR (s_end >= r_start AND s_start <= r_start + 365)",
    "contained_words": f"{_L} SELECT clip_id, l_linenumber FROM s JOIN r USING (clip_id) WHERE s_start >= r_start - 0.001 AND s_end <= r_start + 365.001",
    "sentence_at": f"{_L} SELECT clip_id, (SELECT min(l_linenumber) FROM s WHERE s.clip_id = r.clip_id AND r_start + 70 BETWEEN s_start AND s_end) AS l_linenumber, EXISTS (SELECT 1 FROM s WHERE s.clip_id = r.clip_id AND r_start + 70 BETWEEN s_start AND s_end) AS in_any FROM r",
    "axis_values": """WITH t AS (SELECT p_brand, p_size::DOUBLE AS x, max(p_retailprice) AS y FROM part WHERE p_partkey % 3 = 0 GROUP BY ALL), m AS (SELECT *, lag(x) OVER w AS x0, lag(y) OVER w AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1, row_number() OVER w AS k FROM t WINDOW w AS (PARTITION BY p_brand ORDER BY x)),
p AS (SELECT p_partkey, p_brand, p_size::DOUBLE AS c0 FROM part), c AS (SELECT p.*, m.* EXCLUDE (p_brand) FROM p LEFT JOIN m ON m.p_brand = p.p_brand AND (m.x <= c0 OR m.k = 1) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY x DESC) = 1)
SELECT p_partkey, round(greatest(y + (c0 - x) * CASE WHEN x1 IS NOT NULL THEN (y1 - y) / (x1 - x) ELSE (y - y0) / (x - x0) END, CASE WHEN x1 IS NULL AND x0 IS NULL THEN NULL ELSE 0 END) + CASE WHEN x1 IS NULL AND x0 IS NULL THEN NULL ELSE 0 END, 4) AS value FROM c""",
    "anchor_frames": "WITH p AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id, list_position(CASE WHEN n = 2 THEN [0, 1] ELSE [0, n // 2, n - 1] END, i)::BIGINT AS anchor FROM p WHERE n > 1 AND (i = 0 OR i = n // 2 OR i = n - 1)",
    "densest_attempt": "SELECT user_id, event_type, count(*) AS rows FROM events GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) = 1",
    "year_ranks": "WITH l AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS y, CASE o_orderkey % 3 WHEN 0 THEN printf('%d-%02d', year(o_orderdate), (year(o_orderdate) + 1) % 100) WHEN 1 THEN 'in ' || year(o_orderdate) ELSE o_orderpriority END AS label FROM orders) SELECT o_custkey, o_orderkey, label, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3 = 2, CASE WHEN o_orderkey % 3 = 2 THEN 0 ELSE y END, label, o_orderkey) AS rank FROM l",
    "chart_dispatch": f"WITH t AS (SELECT o_orderkey, {_KINDS.format('o_orderkey')} AS a, {_KINDS.format('o_orderkey // 6 + o_custkey')} AS b FROM orders), f AS (SELECT *, {_FAMILY.format('a')} AS fa, {_FAMILY.format('b')} AS fb FROM t) SELECT o_orderkey, CASE WHEN fb <> 'unknown' THEN fb ELSE fa END AS processor, a AS declared_type, (fa = 'unknown' AND fb = 'unknown') OR b = '' OR fb = 'unknown' OR fa = fb AS consistent FROM f",
    "xml_texts": "SELECT conv_id, turn, role, sha256(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), chr(39), '&apos;')) AS escaped FROM conversations WHERE (coalesce(role, '') <> '' OR coalesce(text, '') <> '') AND coalesce(role <> 'system', true)",
    "bounded_frames": "WITH e AS (SELECT user_id, epoch_us(ts) // 3600000000 AS hour, event_type FROM events), c AS (SELECT DISTINCT user_id, hour FROM e WHERE event_type = 'click'), b AS (SELECT user_id, min(hour) AS hour FROM e GROUP BY 1 UNION SELECT user_id, max(hour) FROM e GROUP BY 1) SELECT user_id, hour, false AS added FROM c UNION ALL SELECT user_id, hour, true FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = b.user_id AND c.hour = b.hour)",
    "clip_issues": "WITH k AS (SELECT o_orderkey AS clip_id, o_orderkey AS k, coalesce(n, 0) AS n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey) " + " UNION ALL ".join(_RULES),
}
