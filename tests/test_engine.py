"""Operators on the small cases of their contracts, sources, streams, and each query against its SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from factframe.functions import scalars
from factframe.operators import facts, joins, models, ordering, quality
from factframe.plans import catalog
from factframe.sources import config, tables
from factframe.streaming import jobs

SF = "/root/testdata/sf0.001"
def test_axis_ticks_go_and_data_stays(spark):
    rows = [(0, e, v) for e in ("cyclists", "drivers") for v in (0, 50, 100)] + [(1, "cyclists", 88), (1, "drivers", 85)]
    got = facts.without_axis_ticks(spark.createDataFrame(rows, "at bigint, e string, v bigint"), "at", "e", "v")
    assert sorted(r["v"] for r in got.collect()) == [85, 88]


def test_even_pick_keeps_the_ends(spark):
    rows = spark.range(12).withColumn("g", F.lit(1))
    got = [r["id"] for r in ordering.pick_evenly(rows, ["g"], [F.col("id")], 4).orderBy("id").collect()]
    assert got == [0, 4, 7, 11]
    assert [r["id"] for r in ordering.pick_evenly(rows, ["g"], [F.col("id")], 1).collect()] == [11]


def test_interpolation_goes_beyond_the_ticks(spark):
    value = joins.interpolated(F.col("y"), [(660.0, 0.0), (180.0, 400.0)])
    got = [r[0] for r in spark.createDataFrame([(360.0,), (480.0,), (700.0,)], "y double").select(F.round(value, 6)).collect()]
    assert got == [250.0, 150.0, 0.0]


def test_nearest_with_a_tolerance(spark):
    left = spark.createDataFrame([(1, 1, 10), (1, 2, 100), (2, 3, 5)], "k bigint, id bigint, at bigint")
    right = spark.createDataFrame([(1, 7, 8, "a"), (1, 8, 12, "b"), (1, 9, 160, "c")], "k bigint, id bigint, at bigint, v string")
    got = {r["id"]: (r["near_v"], r["distance"]) for r in joins.nearest(left, right, ["k"], "at", "id", ["v"], 50).collect()}
    assert got == {1: ("a", 2), 2: (None, 60), 3: (None, None)}


def test_upsert(spark):
    rows = lambda *made: spark.createDataFrame(made, "entity_id string, value bigint")
    got = {r["entity_id"]: (r["value"], r["action"]) for r in joins.upsert(rows(("car", 1), ("b", 2)), rows(("b", 5), ("c", 6)), ["entity_id"], "value").collect()}
    assert got == {"car": (1, "kept"), "b": (5, "updated"), "c": (6, "inserted")}


def test_labels_match(spark):
    rows = spark.createDataFrame([("Insured United States", "Uninsured United States"), ("United States", "the united states"), ("a b", "b a")], "a string, b string")
    assert [r[0] for r in rows.select(scalars.labels_match(F.col("a"), F.col("b"))).collect()] == [False, True, True]


def test_quality_and_routes(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("b", 1, 1), ("c", 1, 0)], "k string, x int, y int")
    issues = quality.check(rows, "k", [("hard_fail", "no_x", F.col("x") == 0), ("needs_review", "no_y", F.col("y") == 0)])
    assert {r["k"]: (r["status"], r["issue_codes"]) for r in quality.status(rows.select("k"), issues, "k").collect()} == {"a": ("hard_fail", "no_x"), "b": ("pass", ""), "c": ("needs_review", "no_y")}


def test_model_failures_are_rows(spark):
    rows = spark.createDataFrame([(1, "p"), (2, "p")], "k bigint, p string")
    answer = 'Sure: ```json\n{"rows": [{"label": "a", "value": "1", "raw_text": "1"}], "states": [{"state": "s", "year": 1990, "rows": [{"label": "b", "value": "2", "raw_text": "2"}, {"label": "b", "value": "2", "raw_text": "2"}]}]}\n```'
    got = models.ask(rows, "recover", "k", "p", lambda: models.Recorded({("recover", "1"): answer}))
    assert {r["k"]: r["model_status"] for r in got.collect()} == {1: "ok", 2: "failed"}
    parsed = got.withColumn("result", models.salvaged(F.col("response"), models.CHART))
    flat = models.chart_rows(parsed, "k").orderBy("k", "ord").collect()
    assert [(r["label"], r["state"], r["year"]) for r in flat] == [("a", None, None), ("b", "s", "1990")]


def test_clip_csv(spark, tmp_path):
    (tmp_path / "clips.csv").write_text(
        "﻿Link,Start,End,ChartType,Title,Author,Year,SourceWebsite,ID\n"
        "https://youtu.be/a,0:10,0:20,Bar,One,X,2001,w,1\nhttps://youtu.be/a,10,20,bar,Again,X,2001,w,2\nhttps://youtu.be/b,0:30,0:20,Bar,Bad,X,2001,w,3\n,1,2,Bar,No link,X,,w,4\nhttps://youtu.be/c,1:00:00,1:00:05,Bar,Two,X,bad,w,5\n"
    )
    got = tables.read_clips(spark, str(tmp_path)).orderBy("clip_id").collect()
    assert [(r["clip_id"], r["video_id"], r["start_time"], r["year"]) for r in got] == [("bar_1", "a", "00:00:10", 2001), ("bar_2", "c", "01:00:00", None)]


def test_tables_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("b", [1, 2])], "z string, a array<int>")
    tables.write_csv(rows, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["a", "z"]
    log = spark.sql("SELECT 1L AS id, 's' AS sample_id, 'stage1_review' AS stage, 'approved' AS decision, '' AS original_value, '' AS reviewed_value, 'r' AS reviewer, timestamp'2020-01-01' AS reviewed_at, '' AS notes, 'm' AS model_version, 'h' AS config_hash")
    for _ in range(2):
        tables.append_reviews(log, str(tmp_path / "log"))
    assert tables.read_reviews(spark, str(tmp_path / "log"), "s").count() == 2
    svg = spark.createDataFrame([(1, '<svg><g id="a" data-role="bar" data-entity-id="e"/></svg>'), (2, "nothing")], "k int, s string")
    assert [(r["ids"], r["roles"]) for r in tables.svg_roles(svg, "k", "s").orderBy("k").collect()] == [(["a"], ["bar"]), (None, None)]
    one, two = rows.select("z"), spark.createDataFrame([("b",), ("c",)], "z string")
    assert sorted(r["z"] for r in tables.first_present([one, two], ["z"]).collect()) == ["b", "c"]


def test_config(tmp_path):
    (tmp_path / "base.yaml").write_text("a: {x: 1, y: 2}\nb: 1\n")
    (tmp_path / "child.yaml").write_text("extends: base.yaml\na: {y: 3}\n")
    (tmp_path / "loop.yaml").write_text("extends: loop.yaml\n")
    assert config.load(tmp_path / "child.yaml") == {"a": {"x": 1, "y": 3}, "b": 1}
    assert len(config.config_hash({"a": 1})) == 64
    with pytest.raises(ValueError):
        config.load(tmp_path / "loop.yaml")


def test_streamed_changes_equal_the_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select(F.col("user_id").alias("clip_id"), F.col("event_type").alias("entity_id"), F.col("ts").cast("timestamp").alias("ts"), F.floor(F.col("value") / 10).cast("bigint").alias("value")).orderBy("ts").limit(300)
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = jobs.changes(stream).writeStream.format("memory").queryName("changed").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    none = {c: F.lit(None).cast("string") for c in ("entity", "unit", "source_type", "evidence_frames", "evidence_sentence_id", "confidence", "review_status", "state_end")}
    rows = spark.read.parquet(str(tmp_path / "in")).withColumns({"metric": F.lit("value"), "state_start": F.unix_micros("ts").cast("double"), "place": F.lit(0), "value_type": F.lit("exact"), **none})
    key = lambda r: (r["clip_id"], r["entity_id"], r["event_type"], -1 if r["value"] is None else r["value"])
    assert sorted(map(key, spark.table("changed").collect())) == sorted(map(key, facts.change_events(rows).collect()))
    sessions = jobs.paused_sessions(stream).writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    sessions.awaitTermination()
    assert spark.table("sessions").count() > 0


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(list(map(plain, v))) if isinstance(v, (list, tuple)) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(tuple(map(plain, r)) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in order) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
