"""Queries over texts, numbers in them, times and narration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..functions import titles
from ..operators import labels, narration
from ..operators.islands import sentences
from .adapters import micros, read

ALIASES = [("car", "car"), ("the", "the"), ("license", "license"), ("un", " un ")]


def numeric_values(spark: SparkSession, d: str) -> DataFrame:
    """The first number of each whole document, and its unit."""
    return read(spark, d, "documents").select("doc_id", fn.numeric_value(F.col("text")).alias("number"), fn.infer_unit(F.regexp_extract("text", "^[^\n]*", 0), F.col("text")).alias("unit"))


def tick_labels(spark: SparkSession, d: str) -> DataFrame:
    """Quantities written as axis labels, read back."""
    n, q = F.col("l_linenumber") % 5, F.col("l_quantity").cast("long").cast("string")
    label = F.when(n == 0, F.concat(q, F.lit("k"))).when(n == 1, F.concat(F.lit("$"), q, F.lit(",000.5"))).when(n == 2, F.concat(q, F.lit("%"))).when(n == 3, F.concat(F.lit(" €"), q, F.lit(" b "))).otherwise(F.concat(q, F.lit(" parts")))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", fn.tick_value(label).alias("number"))


def parse_times(spark: SparkSession, d: str) -> DataFrame:
    """Times of day written in several ways, read back as seconds."""
    s = F.pmod(F.floor(micros("ts") / 1_000_000), F.lit(86_400))
    n = F.col("event_id") % 5
    clock = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    text = F.when(n == 0, s.cast("string")).when(n == 1, F.format_string(" %d:%02d ", F.floor(s / 60), s % 60)).when(n == 2, clock).when(n == 3, F.concat(F.floor(s / 60).cast("string"), F.lit(":07.5"))).otherwise(F.concat(s.cast("string"), F.lit(".5")))
    return read(spark, d, "events").select("event_id", fn.parse_time(text).alias("seconds"))


def video_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of pages' own links, and of short and long video links made of their numbers."""
    n, own = F.col("page_id") % 3, F.col("page_id").cast("string")
    url = F.when(n == 0, F.concat(F.lit("https://youtu.be/v"), own, F.lit("?t=1"))).when(n == 1, F.concat(F.lit("https://www.youtube.com/watch?a=1&v="), own, F.lit("#x"))).otherwise(F.col("url"))
    return read(spark, d, "pages").select("page_id", fn.video_id(url).alias("video"))


def format_times(spark: SparkSession, d: str) -> DataFrame:
    seconds = (F.pmod(F.floor(micros("ts") / 1000), F.lit(86_400_000)) / 1000).cast("double")
    return read(spark, d, "events").select("event_id", fn.format_time(F.floor(seconds)).alias("hms"), fn.stamp(seconds).alias("srt"))


def entity_slugs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", fn.slug(F.concat_ws(" / ", "p_name", "p_brand")).alias("entity_id"))


def document_units(spark: SparkSession, d: str) -> DataFrame:
    """The first unit of the list that each whole document shows."""
    return read(spark, d, "documents").select("doc_id", fn.infer_unit(F.col("text")).alias("unit"))


def context_intervals(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem")
    start, end = F.col("l_quantity"), F.col("l_quantity") + F.col("l_linenumber")
    a, z = narration.padded(start, end, duration=F.lit(50.0))
    return rows.select("l_orderkey", "l_linenumber", a.alias("context_start"), z.alias("context_end"), F.round(start - a, 3).alias("visual_start"))


def sentence_boundaries(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events").withColumn("at", micros("ts"))
    told = sentences(events, ["user_id"], F.col("at"), [F.col("at"), F.col("event_id")], F.col("event_type") == "purchase", 6 * 3_600_000_000)
    return told.groupBy("user_id", "sentence").agg(F.min("at").alias("start"), F.max("at").alias("end"), F.count("*").alias("n_words"), F.round(F.avg(F.coalesce("value", F.lit(0.0))), 4).alias("confidence"))


def _orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    days = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    told = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip_id"), "l_linenumber", days("l_shipdate").alias("s_start"), (days("l_shipdate") + F.col("l_quantity")).alias("s_end"))
    shown = read(spark, d, "orders").select(F.col("o_orderkey").alias("clip_id"), days("o_orderdate").alias("r_start"), (days("o_orderdate") + 365).alias("r_end"))
    return told, shown


#: Days of a time bucket: an order's interval is a year, a line's up to 50 days.
YEARS = 800.0


def sentence_select(spark: SparkSession, d: str) -> DataFrame:
    return narration.full_sentences(*_orders(spark, d), ["clip_id"], width=YEARS, bounded=True).select("clip_id", "l_linenumber", "starts_before", "ends_after")


def overlap_words(spark: SparkSession, d: str) -> DataFrame:
    met = narration.full_sentences(*_orders(spark, d), ["clip_id"], width=YEARS, bounded=True)
    return met.select("clip_id", "l_linenumber", (F.col("clip_start") - F.col("r_start")).alias("visual_start"), (F.col("clip_end") - F.col("r_start")).alias("visual_end"))


def subtitle_text(spark: SparkSession, d: str) -> DataFrame:
    return narration.joined_text(read(spark, d, "conversations"), ["conv_id"], ["turn", "role"], "text")


def alias_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Items by the first long word of their text, in documents."""
    aliases = read(spark, d, "benchmark").select(F.col("item_id").alias("entity"), F.regexp_extract(F.lower("text"), "[a-z]{6,}", 0).alias("alias"))
    return labels.mentioned(read(spark, d, "documents").select("doc_id", "text"), "text", aliases).select("doc_id", "entity", "alias", "at")


def label_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Full names of parts that match a shorter one."""
    parts = read(spark, d, "part")
    full = parts.select(F.concat_ws(" ", "p_type", "p_name", "p_brand").alias("label"))
    short = parts.select(F.concat_ws(", ", "p_name", F.initcap("p_type")).alias("name")).unionByName(parts.select(F.concat_ws("-", "p_brand", "p_name").alias("name")))
    return labels.matching(full, short, "label", "name")


def greedy_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of the entities that each whole document names, the document taken as one sentence."""
    names = F.array(*[F.struct(F.lit(e).alias("entity"), F.lit(a).alias("alias")) for e, a in ALIASES])
    told = read(spark, d, "documents").select("doc_id", "text").withColumn("names", names)
    return narration.narration_values(told, "doc_id", "text", "names").select("doc_id", F.col("n").cast("long").alias("n"), "entity", "value")


def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("long")
    return read(spark, d, "events").select("event_id", k.alias("k"), F.lag(k).over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("k_before"))


def title_words(spark: SparkSession, d: str) -> DataFrame:
    """Whether the names of neighbouring parts of a brand name the same thing."""
    over = Window.partitionBy("p_brand").orderBy("p_partkey")
    return read(spark, d, "part").withColumn("before", F.lag("p_name").over(over)).where(F.col("before").isNotNull()).select("p_partkey", fn.labels_match(F.col("p_name"), F.col("before")).alias("same"))


def title_status(spark: SparkSession, d: str) -> DataFrame:
    over = Window.partitionBy("p_brand").orderBy("p_partkey")
    seen = read(spark, d, "part").withColumn("lines", F.filter(F.array("p_type", F.lag("p_name").over(over)), lambda x: x.isNotNull()))
    return seen.select("p_partkey", titles.status(F.col("p_name"), F.col("lines")).alias("status"), titles.preferred(F.col("p_name"), F.col("lines")).alias("title"))


def render_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles with years against automatic ones, whose years may be others."""
    years = lambda n: F.element_at(F.array(*map(F.lit, (" 1990-2000", " of 2001", "", " 2000 to 1990"))), n + 1)
    own, auto = F.concat("p_name", years((F.col("p_size") % 4).cast("int"))), F.concat("p_type", years((F.col("p_partkey") % 4).cast("int")))
    return read(spark, d, "part").select("p_partkey", titles.resolved(own, auto).alias("title"))


def value_labels(spark: SparkSession, d: str) -> DataFrame:
    unit = F.when(F.col("l_linenumber") % 2 == 0, "$").otherwise("%")
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", titles.value_label(F.col("l_quantity"), unit).alias("label"))


def transcript_slice(spark: SparkSession, d: str) -> DataFrame:
    told, shown = _orders(spark, d)
    met = told.join(shown, "clip_id")
    return narration.sliced(met, "s_start", "s_end", F.col("r_start"), F.col("r_end")).select("clip_id", "l_linenumber", "s_start", "s_end")


def snapped_intervals(spark: SparkSession, d: str) -> DataFrame:
    told, shown = _orders(spark, d)
    return narration.snapped(shown, told, ["clip_id"], 0.25, 20.0)


QUERIES = {f.__name__: f for f in (numeric_values, tick_labels, parse_times, video_ids, format_times, entity_slugs, document_units, context_intervals, sentence_boundaries, sentence_select, overlap_words, subtitle_text, alias_mentions, label_pairs, greedy_numbers, json_flatten, title_words, title_status, render_titles, value_labels, transcript_slice, snapped_intervals)}

_ORDERS = """WITH s AS (SELECT l_orderkey AS clip_id, l_linenumber, date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::DOUBLE AS s_start, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) + l_quantity AS s_end FROM lineitem),
r AS (SELECT o_orderkey AS clip_id, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE AS r_start, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + 365.0::DOUBLE AS r_end FROM orders),
m AS (SELECT *, greatest(s_start, r_start) AS a, least(s_end, r_end) AS z FROM s JOIN r USING (clip_id) WHERE least(s_end, r_end) > greatest(s_start, r_start))"""


def _words(x: str) -> str:
    return f"list_distinct(list_filter(string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda y: y <> ''))"


def _unit_of(text: str) -> str:
    suffix = f"trim(regexp_extract(lower({text}), '{fn.NUMBER}', 2))"
    cases = " ".join(f"WHEN regexp_matches(lower({text}), '{pattern}'){f" OR {suffix} = '{end}'" if end else ''} THEN '{unit}'" for unit, pattern, end in fn.UNITS)
    return f"CASE {cases} END"


_WORD_VALUE = "CASE {} " + " ".join(f"WHEN '{w}' THEN {v}" for w, v in fn.NUMBER_WORDS.items()) + " END"
# Words and what lies between them, in turn, and the place of the first number among them.
_PIECES = r"regexp_extract_all(lower(text), '\w+|\W+')"
_AT = f"list_position(list_transform({_PIECES}, lambda p: ({_WORD_VALUE.format('p')}) IS NOT NULL), true)"
_FIRST_WORD = _WORD_VALUE.format(f"{_PIECES}[{_AT}]")
_NEXT_WORD = rf"CASE WHEN regexp_full_match({_PIECES}[{_AT} + 1], '[-\s]+') AND ({_WORD_VALUE.format(f'{_PIECES}[{_AT} + 2]')}) < 10 THEN {_WORD_VALUE.format(f'{_PIECES}[{_AT} + 2]')} END"
_FIGURE = f"TRY_CAST(replace(regexp_extract(text, '{fn.NUMBER}', 1), ',', '') AS DOUBLE)"
# Places of matches: each is set between two control characters, and what lies between those is measured.
_PLACED = """list_transform(range(2, len({0}) + 1, 2), lambda i: {{'a': coalesce(list_sum(list_transform({0}[1:i - 1], lambda x: length(x))), 0)::BIGINT, 't': {0}[i]}})"""
_FIGURES = rf"string_split(regexp_replace(text, '(?i)(?:(^)|([^\w.]))({fn.FIGURE})(\s*(?:{fn.one_of(f for forms in fn.UNIT_FORMS.values() for f in forms)}))?', '\1\2' || chr(1) || '\3\4' || chr(1), 'g'), chr(1))"
_ANY, _ONES = fn.one_of(fn.NUMBER_WORDS), fn.one_of(w for w, v in fn.NUMBER_WORDS.items() if v < 10)
_SAID = rf"string_split(regexp_replace(text, '(?i)(\b(?:{_ANY})(?:[\s-]+(?:{_ONES}))?\b)', chr(1) || '\1' || chr(1), 'g'), chr(1))"
_VAGUE = narration.VAGUE


def _greedy() -> str:
    steps, names = [], []
    for i, (entity, alias) in enumerate(ALIASES):
        taken = "".join(f" AND (p{j} IS NULL OR x.a <> p{j}.a OR x.z <> p{j}.z)" for j in range(i))
        steps.append(f"g{i} AS (SELECT *, strpos(low, '{alias}') AS s{i}, CASE WHEN strpos(low, '{alias}') > 0 THEN list_filter(m, lambda x: x.a >= strpos(low, '{alias}') - 1 + {len(alias)}{taken})[1] END AS p{i} FROM {'n' if i == 0 else f'g{i - 1}'})")
        names.append(f"SELECT doc_id, {i} AS i, '{entity}' AS entity, p{i}.v AS value FROM g{len(ALIASES) - 1} WHERE s{i} > 0 AND (p{i} IS NOT NULL OR vague)")
    return rf"""WITH t AS (SELECT doc_id, text, lower(text) AS low, regexp_matches(lower(text), '{_VAGUE}') AS vague, {_FIGURES} AS f, {_SAID} AS w FROM documents WHERE text IS NOT NULL),
u AS (SELECT *, list_transform({_PLACED.format('f')}, lambda x: {{'a': x.a, 'z': x.a + length(x.t), 'v': replace(regexp_extract(x.t, '-?[0-9,]+(?:\.[0-9]+)?'), ',', '')::DOUBLE}}) AS fs,
  list_transform({_PLACED.format('w')}, lambda x: {{'a': x.a, 'z': x.a + length(x.t), 'v': ({_WORD_VALUE.format(rf"regexp_extract(lower(x.t), '^({_ANY})', 1)")} + coalesce({_WORD_VALUE.format(rf"regexp_extract(lower(x.t), '^(?:{_ANY})[-\s]+({_ONES})', 1)")}, 0))::DOUBLE}}) AS ws FROM t),
n AS (SELECT *, list_sort(list_concat(fs, ws)) AS m FROM u), {', '.join(steps)}
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n, entity, value FROM ({' UNION ALL '.join(names)})"""


_YEARS = "CASE {} % 4 WHEN 0 THEN ' 1990-2000' WHEN 1 THEN ' of 2001' WHEN 2 THEN '' ELSE ' 2000 to 1990' END"

ORACLES = {
    "numeric_values": f"SELECT doc_id, coalesce({_FIGURE}, {_FIRST_WORD} + coalesce({_NEXT_WORD}, 0))::DOUBLE AS number, coalesce({_unit_of("regexp_extract(text, '^[^\n]*')")}, {_unit_of('text')}) AS unit FROM documents",
    "tick_labels": "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN q * 1000 WHEN 1 THEN q * 1000 + 0.5 WHEN 2 THEN q WHEN 3 THEN q * 1e9 END::DOUBLE AS number FROM (SELECT *, trunc(l_quantity)::DOUBLE AS q FROM lineitem)",
    "parse_times": "SELECT event_id, CASE event_id % 5 WHEN 3 THEN s // 60 * 60 + 7.5 WHEN 4 THEN NULL ELSE s END::DOUBLE AS seconds FROM (SELECT event_id, epoch_us(ts) // 1000000 % 86400 AS s FROM events)",
    "video_ids": r"SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'v' || page_id WHEN 1 THEN page_id::VARCHAR ELSE coalesce(nullif(regexp_extract(url, '[?&]v=([^&#]+)', 1), ''), regexp_extract(url, '([^/?#]+)/?(?:[?#].*)?$', 1)) END AS video FROM pages",
    "format_times": "WITH e AS (SELECT event_id, epoch_us(ts) // 1000 % 86400000 AS ms FROM events) SELECT event_id, printf('%02d:%02d:%02d', ms // 3600000, ms % 3600000 // 60000, ms % 60000 // 1000) AS hms, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms % 3600000 // 60000, ms % 60000 // 1000, ms % 1000) AS srt FROM e",
    "entity_slugs": "SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(p_name || ' / ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS entity_id FROM part",
    "document_units": f"SELECT doc_id, {_unit_of('text')} AS unit FROM documents",
    "context_intervals": "SELECT l_orderkey, l_linenumber, round(a, 3) AS context_start, round(greatest(least(z + 5, 50), a), 3) AS context_end, round(l_quantity - round(a, 3), 3) AS visual_start FROM (SELECT *, greatest(l_quantity - 5, 0) AS a, l_quantity + l_linenumber AS z FROM lineitem)",
    "sentence_boundaries": "WITH e AS (SELECT *, epoch_us(ts) AS t FROM events), g AS (SELECT *, CASE WHEN lag(event_type) OVER w = 'purchase' OR t - lag(t) OVER w >= 21600000000 OR lag(t) OVER w IS NULL THEN 1 ELSE 0 END AS o FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)), i AS (SELECT *, (sum(o) OVER (PARTITION BY user_id ORDER BY t, event_id))::BIGINT AS sentence FROM g) SELECT user_id, sentence, min(t) AS start, max(t) AS \"end\", count(*) AS n_words, round(avg(coalesce(value, 0)), 4) AS confidence FROM i GROUP BY 1, 2",
    "sentence_select": f"{_ORDERS} SELECT clip_id, l_linenumber, s_start < r_start AS starts_before, s_end > r_end AS ends_after FROM m",
    "overlap_words": f"{_ORDERS} SELECT clip_id, l_linenumber, a - r_start AS visual_start, z - r_start AS visual_end FROM m",
    "subtitle_text": r"SELECT conv_id, regexp_replace(coalesce(string_agg(trim(text), ' ' ORDER BY turn, role, trim(text)) FILTER (WHERE trim(text) <> ''), ''), '\s+', ' ', 'g') AS text, count(*) FILTER (WHERE trim(text) <> '') AS n_parts FROM conversations GROUP BY 1",
    "alias_mentions": "WITH a AS (SELECT DISTINCT item_id AS entity, regexp_extract(lower(text), '[a-z]{6,}') AS alias FROM benchmark) SELECT doc_id, entity, alias, strpos(lower(text), alias)::BIGINT AS at FROM documents, a WHERE alias <> '' AND strpos(lower(text), alias) > 0",
    "label_pairs": "WITH l AS (SELECT DISTINCT concat_ws(' ', p_type, p_name, p_brand) AS label FROM part), n AS (SELECT concat_ws(', ', p_name, p_type[1] || lower(p_type[2:])) AS name FROM part UNION SELECT concat_ws('-', p_brand, p_name) FROM part), a AS (SELECT label, list_filter(string_split_regex(lower(label), '[^a-z0-9]+'), lambda w: w <> '') AS x FROM l), b AS (SELECT name, list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda w: w <> '') AS y FROM n) SELECT label, name FROM a, b WHERE len(x) > 0 AND len(y) > 0 AND (list_has_all(x, y) OR list_has_all(y, x))",
    "greedy_numbers": _greedy(),
    "json_flatten": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, lag(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k_before FROM events",
    "title_words": "WITH w AS (SELECT p_partkey, list_filter(list_distinct(string_split_regex(lower(p_name), '[^a-z0-9]+')), lambda x: x <> '') AS a, lag(list_filter(list_distinct(string_split_regex(lower(p_name), '[^a-z0-9]+')), lambda x: x <> '')) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS b FROM part) SELECT p_partkey, list_has_all(a, b) OR list_has_all(b, a) AS same FROM w WHERE b IS NOT NULL",
    "title_status": f"""WITH p AS (SELECT p_partkey, p_name, list_filter([p_type, lag(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey)], lambda x: x IS NOT NULL) AS lines FROM part),
w AS (SELECT *, {_words("p_name")} AS own, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS t FROM p),
s AS (SELECT *, CASE WHEN len(own) = 0 THEN 'none' WHEN len(list_filter(lines, lambda x: contains(trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')), t))) > 0 THEN 'visible'
  WHEN len(list_filter(lines, lambda x: len({_words("x")}) >= 3 AND 2 * len(list_intersect(own, {_words("x")})) >= len(own))) > 0 THEN 'candidate' ELSE 'none' END AS status FROM w)
SELECT p_partkey, status, CASE WHEN status = 'candidate' THEN CASE WHEN len(lines) > 1 AND length(lines[2]) > length(lines[1]) THEN lines[2] ELSE lines[1] END ELSE p_name END AS title FROM s""",
    "render_titles": f"SELECT p_partkey, CASE WHEN p_size % 4 <> 2 AND p_partkey % 4 <> 2 AND (p_size % 4 = 1) <> (p_partkey % 4 = 1) THEN p_type || {_YEARS.format('p_partkey')} ELSE p_name || {_YEARS.format('p_size')} END AS title FROM part",
    "value_labels": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN '$' || l_quantity::BIGINT ELSE l_quantity::BIGINT || '%' END AS label FROM lineitem",
    "transcript_slice": f"{_ORDERS} SELECT clip_id, l_linenumber, round(greatest(s_start, r_start) - r_start, 3) AS s_start, round(least(s_end, r_end) - r_start, 3) AS s_end FROM s JOIN r USING (clip_id) WHERE s_end > r_start AND s_start < r_end",
    "snapped_intervals": f"{_ORDERS}, g AS (SELECT clip_id, r_start, r_end, greatest(min(s_start) FILTER (WHERE r_start BETWEEN s_start AND s_end) - 0.25, 0)::DOUBLE AS a, (max(s_end) FILTER (WHERE r_end BETWEEN s_start AND s_end) + 0.25)::DOUBLE AS z FROM r LEFT JOIN s USING (clip_id) GROUP BY 1, 2, 3) SELECT clip_id, r_start, r_end, round(CASE WHEN r_start - a <= 20 THEN a ELSE r_start END, 3) AS new_start, round(CASE WHEN z - r_end <= 20 THEN z ELSE r_end END, 3) AS new_end FROM g",
}
