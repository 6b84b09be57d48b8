"""The commands end to end on one small clip, and facts from model rows."""

import json

from pyspark.sql import functions as F

from factframe import flows
from factframe.operators.visual import visual_facts
from factframe.sources import tables


def rows(spark, tmp_path, made):
    names = ["state", "year", "label", "series", "metric", "value", "unit", "source_frame", "time_seconds", "confidence"]
    lines = [json.dumps({"clip_id": "bar_1", "ord": i} | dict(zip(names, [None, y, label, None, None, v, None, "f", t, 0.0]))) for i, (y, label, v, t) in enumerate(made)]
    (tmp_path / "rows.json").write_text("\n".join(lines) + "\n\n")
    return spark.read.schema(tables.VISUAL_ROWS).json(str(tmp_path / "rows.json")).where("clip_id IS NOT NULL")


def test_visual_facts(spark, tmp_path):
    made = [(None, e, str(v), 0.0) for e in ("Cyclists", "Drivers") for v in (0, 50, 100)] + [(None, "Cyclists", "88%", 1.0), (None, "Drivers", "85%", 1.0), (None, "???", "5", 1.0), (None, "Walkers", "many", 1.0), (None, "380,000 km: far", "380000", 1.0)]
    got = visual_facts(rows(spark, tmp_path, made)).orderBy("ord").collect()
    assert [(r["entity_id"], r["value"], r["unit"], r["confidence"]) for r in got] == [("cyclists", 88.0, "%", 0.8), ("drivers", 85.0, "%", 0.8)]


def test_commands(spark, tmp_path):
    (tmp_path / "clips.csv").write_text("Link,Start,End,ChartType,Title,Author,Year,SourceWebsite,ID\nhttps://youtu.be/a,3,10,Bar,One,X,2001,w,1\nhttps://youtu.be/b,3,10,Bar,Two,X,2001,w,2\n")
    rows(spark, tmp_path, [(1990, "Car", "48", 0.0), (1990, "Bus", "15.5", 0.0), (2017, "Car", "35.9", 1.0), (2017, "Bus", "6.8", 1.0)])
    (tmp_path / "said.json").write_text(json.dumps({"sentence_id": "7", "ord": 1, "clip_id": "bar_1", "text": "A plane makes 80 miles; a bus makes 7.", "start": 2.0, "end": 4.0}))
    (tmp_path / "labels.json").write_text("\n".join(json.dumps({"clip_id": "bar_1", "ord": i, "label": x}) for i, x in enumerate(["Plane", "Bus"])))
    files = ["clip.mp4", "keyframes/selected.png", "semantic.svg", "dynamic_data.json", "chart_data_validation.json", "animation_detection.json"]
    (tmp_path / "artifacts.json").write_text(json.dumps({"clip_id": "bar_1", "files": files, "bad_json": [], "extractable": True, "n_csv": 5, "n_final": 3, "n_event_csv": 9}))
    cfg = {"clips": str(tmp_path / "clips.csv"), "visual_rows": str(tmp_path / "rows.json"), "sentences": str(tmp_path / "said.json"), "labels": str(tmp_path / "labels.json"), "artifacts": str(tmp_path / "artifacts.json"), "charts": str(tmp_path / "none.json"), "out": str(tmp_path / "out"), "reviews": str(tmp_path / "log"), "sample_id": "s"}
    flows.context(spark, cfg)
    interval = spark.read.parquet(cfg["out"] + "/intervals").where("clip_id = 'bar_1'").first()
    assert (interval["context_source"]["start"], interval["context_source"]["end"], interval["visual_clip_context"]["start"]) == (0.0, 15.0, 3.0)
    flows.assets(spark, cfg)
    final = {r["entity_id"]: r["value"] for r in spark.read.parquet(cfg["out"] + "/final_table").collect()}
    assert final == {"car": 35.9, "bus": 7.0, "plane": 80.0}
    facts = spark.read.parquet(cfg["out"] + "/facts")
    assert {(r["source_type"], r["value"]) for r in facts.where("review_status = 'needs_review' AND entity_id = 'bus'").collect()} == {("visual", 15.5), ("visual", 6.8), ("narration", 7.0)}
    assert spark.read.parquet(cfg["out"] + "/change_events").groupBy("event_type").count().orderBy("event_type").collect()[0]["count"] == 3
    assert {r["state_id"] for r in spark.read.parquet(cfg["out"] + "/states").collect()} == {"state_001", "state_002", "state_003", "state_004"}
    flows.check(spark, cfg)
    assert {r["clip_id"]: r["status"] for r in spark.read.parquet(cfg["out"] + "/quality").collect()} == {"bar_1": "needs_review", "bar_2": "hard_fail"}
    assert {r["issue_code"] for r in spark.read.parquet(cfg["out"] + "/issues").where("clip_id = 'bar_1'").collect()} == {"event_csv_json_count_mismatch"}
    log = spark.createDataFrame([(i, "s", "stage1_review", d, '{"clip_id": "bar_1"}', "", "r", None, "", "m", "h") for i, d in enumerate(["rejected", "approved"])], tables.REVIEWS)
    tables.append_reviews(log.withColumn("reviewed_at", F.lit("2020-01-01").cast("timestamp")), cfg["reviews"])
    flows.reviewed(spark, cfg)
    assert {r["clip_id"]: r["route"] for r in spark.read.parquet(cfg["out"] + "/routes").collect()} == {"bar_1": "accepted", "bar_2": "unreviewed"}
    assert spark.read.parquet(cfg["out"] + "/accepted_values").count() == 3
