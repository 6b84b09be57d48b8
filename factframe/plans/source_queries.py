"""Queries that write a table in one of the engine's formats and read it back, and over what models answer.

Files lie in the shared checkpoint folder; what is read back is kept before
they go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import models, narration
from ..sources import tables
from ..stages import folder, kept
from .adapters import read


def csv_clips(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a CSV of annotations, in order of their keys: some without a link, some that end where they begin, many repeated."""
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    rows = read(spark, d, "orders").orderBy("o_orderkey").select(
        F.when(k % 9 > 0, F.concat(F.lit(" https://youtu.be/v"), text(F.col("o_custkey") % 40))).alias("Link"), text(k % 6).alias("Start"), text(k % 6 + k % 4).alias("End"), F.when(k % 10 > 0, F.concat(F.lit(" "), "o_orderpriority")).alias("ChartType"),
        F.concat(F.lit('A "title", '), "o_orderstatus").alias("Title"), F.concat("o_orderstatus", F.lit(" ")).alias("Author"), F.when(k % 5 > 0, text(F.year("o_orderdate"))).otherwise("n/a").alias("Year"), F.lit("w").alias("SourceWebsite"), text(k).alias("ID"),
    )
    with folder(spark) as path:
        rows.write.option("header", True).option("escape", '"').csv(path)
        found = tables.clip_source(spark, csv=path)
        return kept(found.select("clip_id", "chart_type", "chart_index", "video_id", "start_seconds", "end_seconds", "duration_seconds", "channel", "year", "source_row_id"))


def jsonl_clips(spark: SparkSession, d: str) -> DataFrame:
    """Orders as JSON lines of clips, the first 500 by type and number."""
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders").select(F.col("o_orderpriority").alias("chart_type"), k.alias("chart_index"), F.concat(F.lit("té\n"), F.col("o_orderstatus")).alias("raw_video_title"), F.lit(None).cast("string").alias("video_id"), F.when(k % 3 == 0, F.concat(F.lit("stem_"), k.cast("string"))).alias("output_stem"))
    with folder(spark) as path:
        tables.write_jsonl(rows, path)
        return kept(tables.clip_source(spark, jsonl=path, limit=500).select("clip_id", "chart_type", "chart_index", "raw_video_title", "video_id"))


def supplier_documents(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as a document each, in a folder each, with the files' sizes and hashes."""
    rows = read(spark, d, "supplier").select("s_suppkey", "s_name", F.struct(F.col("s_nationkey").alias("nation"), F.lit(None).cast("string").alias("note")).alias("at"))
    own = lambda c: F.regexp_extract(c, "s_suppkey=([0-9]+)", 1).cast("long").alias("s_suppkey")
    with folder(spark) as path:
        tables.write_documents(rows.repartition(max(16, 2 * spark.sparkContext.defaultParallelism), "s_suppkey"), path, "s_suppkey")
        files = kept(tables.read_files(spark, path))
        found = tables.read_documents(files, "s_name string, at struct<nation: int, note: string>").select(own("path"), "s_name", F.col("at.nation").alias("nation"), F.col("at.note").alias("note"))
        folders = tables.clip_folders(files, path).select(own("clip_id"), "n_files")
        hashes = tables.file_hashes(files).select(own("path"), F.col("length").alias("n_bytes"), "sha256")
        return kept(found.join(folders, "s_suppkey").join(hashes, "s_suppkey"))


def csv_table(spark: SparkSession, d: str) -> DataFrame:
    """Parts as a CSV table with a nested column, read back as the text that it holds; columns is the header."""
    rows = read(spark, d, "part").select(F.col("p_partkey").alias("z_key"), F.concat("p_name", F.lit(', "b"')).alias("name"), F.struct(F.col("p_size").alias("size"), F.array("p_brand").alias("brands")).alias("more"))
    with folder(spark) as path:
        tables.write_csv(rows, path)
        found = spark.read.option("header", True).option("escape", "\\").csv(path)
        return kept(found.select("*", F.lit(",".join(found.columns)).alias("columns")))


def review_log(spark: SparkSession, d: str) -> DataFrame:
    """Labels as reviews appended in two goes, of which one sample and stage is read."""
    k = F.col("doc_id")
    text = lambda c: c.cast("string")
    log = read(spark, d, "labels").select(
        k.alias("id"), F.when(k % 4 > 0, "s").otherwise("t").alias("sample_id"), F.when(k % 3 > 0, "stage1_review").otherwise("other").alias("stage"), F.when(F.col("quality") == 1, "approved").alias("decision"), F.to_json(F.struct(k.alias("clip_id"))).alias("original_value"),
        F.lit("{}").alias("reviewed_value"), F.lit("r").alias("reviewer"), F.timestamp_seconds(k).alias("reviewed_at"), text(F.col("toxic")).alias("notes"), F.lit("m").alias("model_version"), F.lit("h").alias("config_hash"),
    )
    with folder(spark) as path:
        for half in (0, 1):
            tables.append_reviews(log.where(k % 2 == half), path)
        found = tables.read_reviews(spark, path, "s")
        return kept(found.select("id", "decision", F.get_json_object("original_value", "$.clip_id").cast("long").alias("clip_id"), "notes"))


def source_priority(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each order from its returned ones, else its accepted ones, else the others."""
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return tables.first_present([lines.where(F.col("l_returnflag") == f) for f in "RAN"], ["l_orderkey"])


def bundle_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of the lists that scripts hold, a script an order; some have none, or one that is cut off."""
    k = F.col("o_orderkey")
    item = lambda i: F.concat(F.lit('{"id": '), (k * 10 + i).cast("string"), F.lit(', "name": "'), "o_orderstatus", F.lit('"}'))
    held = F.concat(F.lit("const items = ["), item(0), F.lit(", "), item(1), F.when(k % 5 == 0, "").otherwise("]"), F.lit(";\nlet x = [];"))
    scripts = read(spark, d, "orders").select(F.concat(F.lit('!function(){"use strict"}();\n'), F.when(k % 4 == 0, "var others = [];").otherwise(held)).alias("text"))
    return tables.bundle_items(scripts, "text", "items", "struct<id: bigint, name: string>")


def svg_roles(spark: SparkSession, d: str) -> DataFrame:
    """What the drawings of customers hold; some aren't sound."""
    k = F.col("c_custkey")
    mark = lambda n, role: F.concat(F.lit(f'<rect id="{n}-'), k.cast("string"), F.lit('" data-entity-id="'), scalars.xml_escaped(F.concat("c_mktsegment", F.lit(" & co"))), F.lit(f'" data-role="{role}"/>'))
    svg = F.when(k % 7 == 0, "not a drawing").otherwise(F.concat(F.lit("<svg><g>"), mark("b", "bar"), mark("a", "label"), F.when(k % 2 == 0, mark("c", "bar")).otherwise(""), F.lit("</g></svg>")))
    found = tables.svg_roles(read(spark, d, "customer").select("c_custkey", svg.alias("svg")), "c_custkey", "svg")
    return found.select("c_custkey", *[F.array_join(c, ",").alias(c) for c in ("ids", "entities", "roles")])


def encoded_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts as data URIs, and the sizes that PNG heads made of them state; a path that passes the guard."""
    size = F.col("p_size")
    word = lambda c: F.lpad(F.hex(c.cast("long")), 8, "0")
    png = F.unhex(F.concat(F.when(size % 5 > 0, "89504E470D0A1A0A").otherwise("89504E470D0A1A0B"), F.lit("0000000D49484452"), word(size * 1000), word(F.col("p_partkey"))))
    path = scalars.guarded(F.concat(F.lit("generated/"), F.col("p_brand")), "reviewed")
    return read(spark, d, "part").select("p_partkey", scalars.data_uri(F.encode("p_name", "UTF-8"), "text/plain").alias("uri"), scalars.png_size(png).alias("s"), path.alias("path")).select("p_partkey", "uri", "s.*", "path")


class _Rule:
    """A client that answers by rule: every seventh key fails, every third answer is cut off."""

    def ask(self, call: str, key: str, prompt: str) -> str:
        if int(key) % 7 == 0:
            raise ValueError(f"{call} {key}")
        answer = f'```json\n{{"n": {len(prompt)}, "rows": [{{"v": "a]"}}, {{"v": "b"}}, {{"v": "c"'
        return answer if int(key) % 3 == 0 else "Sure: " + answer + "}]}\n```"


def model_calls(spark: SparkSession, d: str) -> DataFrame:
    """A call for each customer; what can be read of its answer."""
    rows = read(spark, d, "customer").select("c_custkey", "c_name")
    asked = models.ask(rows, "chart", "c_custkey", "c_name", _Rule)
    got = asked.withColumn("r", models.salvaged(F.col("response"), "struct<n: int, rows: array<struct<v: string>>>"))
    return got.select("c_custkey", "model_status", "failure_reason", F.col("r.n").alias("n"), F.array_join("r.rows.v", ",").alias("values"))


def chart_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders as chart readings whose lines are rows, those after the fourth inside a state."""
    k, n, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity").cast("long").cast("string")
    label = F.when(n == 2, "Total").otherwise(F.concat(F.lit("S"), (F.col("l_suppkey") % 6).cast("string")))
    row = F.create_map(F.lit("label"), label, F.lit("value"), q, F.lit("raw_text"), F.when(n % 3 > 0, F.concat(q, F.lit(" units"))))
    row = F.when(n == 6, F.map_concat(row, F.create_map(F.lit("year"), F.lit(None).cast("string")))).otherwise(row)
    listed = lambda late: F.transform(F.array_sort(F.collect_list(F.when((n > 4) == late, F.struct(n.alias("n"), "l_suppkey", "l_partkey", "l_quantity", F.map_entries(row).alias("r"))))), lambda x: F.map_from_entries(x["r"]))
    orders = read(spark, d, "lineitem").groupBy(k.alias("clip_id")).agg(listed(False).alias("direct"), listed(True).alias("late"))
    state = F.create_map(F.lit("state"), F.lit("late"), F.lit("year"), F.lit("1999"))
    text = F.to_json(
        F.struct(
            F.when(F.col("clip_id") % 2 == 0, "total").alias("title"), F.when(F.col("clip_id") % 5 == 0, F.array(F.lit("9 in all"))).alias("visible_text"), F.col("direct").alias("rows"),
            F.array(F.struct(state["state"].alias("state"), state["year"].alias("year"), F.col("late").alias("rows"))).alias("states"),
        ), {"ignoreNullFields": "false"},
    )
    results = orders.select("clip_id", F.from_json(text, models.CHART).alias("result"))
    return models.chart_rows(results, "clip_id").select("clip_id", "ord", "label", "value", "state", "year", "evidence_text")


def label_union(spark: SparkSession, d: str) -> DataFrame:
    """The words of parts' types and names of a brand, each where it comes first."""
    words = lambda c, source: F.posexplode(F.split(c, " ")).alias("i", "text")
    parts = read(spark, d, "part")
    rows = [parts.select(F.col("p_brand").alias("clip_id"), F.lit(s).alias("source"), "p_partkey", words(c, s)) for s, c in enumerate(("p_type", "p_name"))]
    texts = rows[0].unionByName(rows[1]).select("clip_id", "source", (F.col("p_partkey") * 100 + F.col("i")).alias("ord"), "text")
    return models.merged_texts(texts, "clip_id")


def evidence_frames(spark: SparkSession, d: str) -> DataFrame:
    """The first three lines of an order as frames within the time that each of its lines is spoken."""
    n, q, k = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_partkey").cast("string")
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip_id"), F.concat_ws("-", k, n.cast("string")).alias("sentence_id"), (F.col("l_partkey") * 10 + n).alias("idx"), F.when(n < 6, q).alias("start"), (q + 20).alias("end"), F.concat(F.lit("f"), k).alias("source_frame"), F.when(n != 3, q + n).alias("time_seconds"), F.lit(None).cast("string").alias("path"))
    found = narration.frames_during(lines, lines.select("clip_id", "idx", "source_frame", "time_seconds", "path"))
    return found.select("clip_id", "sentence_id", F.array_join("evidence_frames.frame_id", ",").alias("frames"))


QUERIES = {f.__name__: f for f in (csv_clips, jsonl_clips, supplier_documents, csv_table, review_log, source_priority, bundle_items, svg_roles, encoded_parts, model_calls, chart_rows, label_union, evidence_frames)}

ORACLES = {
    "csv_clips": """WITH r AS (SELECT o_orderkey AS k, coalesce(lower(CASE WHEN o_orderkey % 10 > 0 THEN o_orderpriority END), 'unknown') AS chart_type, 'v' || (o_custkey % 40) AS video_id, (o_orderkey % 6)::DOUBLE AS start_seconds, (o_orderkey % 6 + o_orderkey % 4)::DOUBLE AS end_seconds, o_orderstatus AS channel,
  CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate) END AS year FROM orders WHERE o_orderkey % 9 > 0 AND o_orderkey % 4 > 0),
u AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY video_id, chart_type, start_seconds, end_seconds ORDER BY k) = 1), i AS (SELECT *, row_number() OVER (PARTITION BY chart_type ORDER BY k) AS chart_index FROM u)
SELECT trim(regexp_replace(chart_type, '[^a-z0-9]+', '_', 'g'), '_') || '_' || chart_index AS clip_id, chart_type, chart_index, video_id, start_seconds, end_seconds, end_seconds - start_seconds AS duration_seconds, channel, year, k::VARCHAR AS source_row_id FROM i""",
    "jsonl_clips": "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'stem_' || o_orderkey ELSE o_orderpriority || '_' || o_orderkey END AS clip_id, o_orderpriority AS chart_type, o_orderkey AS chart_index, 'té' || chr(10) || o_orderstatus AS raw_video_title, NULL::VARCHAR AS video_id FROM orders ORDER BY 2, 3 LIMIT 500",
    "supplier_documents": """WITH j AS (SELECT s_suppkey, s_name, s_nationkey AS nation, '{"s_name":"' || s_name || '","at":{"nation":' || s_nationkey || ',"note":null}}' || chr(10) AS t FROM supplier) SELECT s_suppkey, s_name, nation, NULL::VARCHAR AS note, 1::BIGINT AS n_files, strlen(t) AS n_bytes, sha256(t) AS sha256 FROM j""",
    "csv_table": """SELECT p_partkey::VARCHAR AS z_key, p_name || ', "b"' AS name, '{"size":' || p_size || ',"brands":["' || p_brand || '"]}' AS more, 'more,name,z_key' AS columns FROM part""",
    "review_log": "SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'approved' END AS decision, doc_id AS clip_id, toxic::VARCHAR AS notes FROM labels WHERE doc_id % 4 > 0 AND doc_id % 3 > 0",
    "source_priority": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem QUALIFY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END = min(CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END) OVER (PARTITION BY l_orderkey)",
    "bundle_items": "SELECT o_orderkey * 10 + i AS id, o_orderstatus AS name FROM orders, (VALUES (0), (1)) v(i) WHERE o_orderkey % 4 > 0 AND o_orderkey % 5 > 0",
    "svg_roles": """SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN 'a-' || c_custkey || ',b-' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ',c-' || c_custkey ELSE '' END END AS ids, CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment || ' & co' END AS entities, CASE WHEN c_custkey % 7 > 0 THEN 'bar,label' END AS roles FROM customer""",
    "encoded_parts": "SELECT p_partkey, 'data:text/plain;base64,' || to_base64(encode(p_name)) AS uri, CASE WHEN p_size % 5 > 0 THEN p_size * 1000 END::INTEGER AS width, CASE WHEN p_size % 5 > 0 THEN p_partkey END::INTEGER AS height, 'generated/' || p_brand AS path FROM part",
    "model_calls": "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'failed' ELSE 'ok' END AS model_status, CASE WHEN c_custkey % 7 = 0 THEN 'ValueError: chart ' || c_custkey END AS failure_reason, CASE WHEN c_custkey % 7 > 0 THEN length(c_name) END::INTEGER AS n, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'a],b' ELSE 'a],b,c' END AS \"values\" FROM customer",
    "chart_rows": """WITH r AS (SELECT l_orderkey AS clip_id, l_linenumber AS n, (l_linenumber, l_suppkey, l_partkey, l_quantity) AS place, CASE WHEN l_linenumber = 2 THEN 'Total' ELSE 'S' || (l_suppkey % 6) END AS label, l_quantity::BIGINT::VARCHAR AS value, CASE WHEN l_linenumber % 3 > 0 THEN l_quantity::BIGINT || ' units' END AS raw_text, CASE WHEN l_linenumber > 4 THEN 'late' END AS state, CASE WHEN l_linenumber IN (5, 7) THEN '1999' END AS year, CASE WHEN l_orderkey % 5 = 0 THEN '9 in all' END AS seen FROM lineitem),
k AS (SELECT *, CASE WHEN raw_text IS NOT NULL THEN raw_text WHEN contains(seen, value) THEN seen END AS evidence_text FROM r WHERE NOT (n = 2 AND clip_id % 2 = 0) AND (raw_text IS NOT NULL OR seen IS NOT NULL AND contains(label || ' ' || seen, value))),
u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY clip_id, label, value, raw_text, state, year ORDER BY place) = 1) SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY place) AS ord, label, value, state, year, evidence_text FROM u""",
    "label_union": "WITH w AS (SELECT p_brand AS clip_id, 0 AS source, p_partkey, string_split(p_type, ' ') AS ws FROM part UNION ALL SELECT p_brand, 1, p_partkey, string_split(p_name, ' ') FROM part), t AS (SELECT clip_id, source, p_partkey * 100 + unnest(range(len(ws))) AS ord, unnest(ws) AS text FROM w), f AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY clip_id, text ORDER BY source, ord) = 1) SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY source, ord) AS place FROM f",
    "evidence_frames": """WITH l AS (SELECT l_orderkey AS clip_id, l_partkey AS k, l_linenumber AS i, l_partkey * 10 + l_linenumber AS n, CASE WHEN l_linenumber < 6 THEN l_quantity END AS a, l_quantity + 20 AS z, CASE WHEN l_linenumber <> 3 THEN l_quantity + l_linenumber END AS t FROM lineitem),
m AS (SELECT s.clip_id, s.k || '-' || s.i AS sentence_id, f.n, f.k FROM l s JOIN l f USING (clip_id) WHERE f.t IS NOT NULL AND (s.a IS NULL OR f.t BETWEEN s.a AND s.z) QUALIFY row_number() OVER (PARTITION BY s.clip_id, s.n ORDER BY f.n) <= 3)
SELECT clip_id, sentence_id, string_agg('f' || k, ',' ORDER BY n) AS frames FROM m GROUP BY 1, 2""",
}
