"""Charts told from states, and clips as their reviews leave them: the small cases of their contracts."""

import json

import pytest
from pyspark.sql import functions as F

from factframe.operators import metadata, narration, reviewed
from factframe.sources import tables

STATES = "clip_id bigint, place bigint, state_key string, state_label string, state_id string, entity_id string, entity string, metric string, value double, unit string, source_type string, confidence double"


def told(spark, made, lines):
    rows = [(1, i, m.get("key"), None, m.get("id", "state_001"), m["entity"].lower().replace(" ", "-"), m["entity"], m.get("metric", ""), m["value"], m.get("unit"), m.get("source", "visual"), m.get("sure")) for i, m in enumerate(made)]
    charts, marks = metadata.chart_metadata(spark.createDataFrame(rows, STATES), spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "clip_id bigint, ord bigint, line string"))
    return charts.first(), marks.orderBy("n").collect()


def test_a_confirmed_moment_goes_first(spark):
    made = [{"entity": e, "metric": "Illiteracy", "value": v, "unit": "%", "key": k, "source": s} for k, s, pair in (("1990", "visual", (48.0, 15.5)), ("2017", "visual_frame_align", (36.1, 6.9))) for e, v in zip(("Region A", "Region B"), pair)]
    chart, marks = told(spark, made + [made[0] | {"entity": "Region C"}], ["Illiteracy 2017", "Region A"])
    assert (chart["title"], chart["unit"], chart["y_axis"], chart["n_marks"]) == ("Illiteracy (2017)", "%", "Illiteracy", 2)
    assert [(m["name"], m["value"]) for m in marks] == [("Region A", 36.1), ("Region B", 6.9)]


def test_metrics_of_a_static_chart_stay_apart(spark):
    made = [{"entity": e, "metric": m, "value": float(i), "id": f"state_{i}"} for i, (e, m) in enumerate((e, m) for e in ("Auto", "Bike", "Walk") for m in ("Average", "Near transit"))]
    chart, marks = told(spark, made, ["90 percent"])
    assert chart["n_marks"] == 6 and chart["moment"] == "state" and chart["unit"] == "%" and [m["value"] for m in marks] == [0, 1, 2, 3, 4, 5]


def test_names_that_no_frame_has_go(spark):
    made = [{"entity": "cycling", "value": 88.0}, {"entity": "cycling", "value": 85.0}, {"entity": "cyclists", "value": 88.0, "source": "visual_frame_align"}, {"entity": "drivers", "value": 85.0, "source": "visual_frame_align"}]
    chart, marks = told(spark, [m | {"metric": "drivers", "key": "2019"} for m in made], ["compliance with traffic laws", "88%", "cyclists"])
    assert (chart["title"], chart["y_axis"]) == ("compliance with traffic laws", "Value") and [(m["name"], m["value"]) for m in marks] == [("cyclists", 88), ("drivers", 85)]


def test_marks_of_odd_states(spark):
    """No number, no entity, ties, repeated rows and names without Latin letters."""
    made = [{"entity": "unknown", "value": 1.0}, {"entity": "a", "value": None}, {"entity": "b", "value": float("nan")}]
    assert told(spark, made, []) == (None, []) and told(spark, [], ["x"]) == (None, [])
    chart, marks = told(spark, [{"entity": "日本", "value": 1.0}, {"entity": "日本", "value": 2.0}, {"entity": "c", "value": 3.0, "sure": 0.1}, {"entity": "C", "value": 4.0, "sure": 0.9}], [None])
    assert chart["title"] == "Value" and [(m["n"], m["value"]) for m in marks] == [(1, 1), (2, 4)]


@pytest.fixture
def found(spark):
    value = {
        "clip": {"start_seconds": 0.5, "clip_id": "z"}, "narration": {"status": "", "full_text": "hello world"}, "animation": {"overall_description": "bars grow", "major_actions": [{"action": "bar_grow"}]},
        "chart_data": [{"label": "CAR", "value": "20", "_n": 1}, {"label": "", "value": None, "_n": 2}, 7, {"_n": 3}, {"label": "BUS"}],
    }
    clips = [("a", {"title": "T", "start_seconds": "9"}, "provisional"), ("b", None, None), ("c", {}, None), ("d", {}, None), ("e", {}, None), ("f", {"title": "F"}, "own"), (None, {}, None)]
    log = [("a", 1, "approved", json.dumps(value)), ("c", 2, "needs_revision", "{}"), ("d", 3, "排除", "{}"), ("e", 4, "maybe", "{}"), ("f", 5, "approved", "{cut")]
    reviews = spark.createDataFrame([(*x, "r", None, None) for x in log], "clip_id string, id bigint, decision string, reviewed_value string, reviewer string, reviewed_at timestamp, notes string")
    return reviewed.judged(spark.createDataFrame(clips, "clip_id string, fields map<string, string>, narration_status string"), reviews)


def test_reviews_decide(found):
    got = {r["clip_id"]: (r["route"], r["reason"]) for r in found.collect()}
    assert got == {"a": ("accepted", None), "b": ("unreviewed", "no_asset_review"), "c": ("unreviewed", "blocking_decision:needs_revision"), "d": ("excluded", None), "e": ("unreviewed", "unsupported_decision:maybe"), "f": ("accepted", None)}


def test_reviews_lie_over_clips(found):
    a, f = reviewed.overlaid(found).orderBy("clip_id").collect()
    assert a["fields"] == {"title": "T", "start_seconds": "0.5"} and (a["narration_status"], a["narration_text"], a["animation_description"], a["animation_action_count"]) == ("provisional", "hello world", "bars grow", 1)
    assert f["fields"] == {"title": "F"} and (f["narration_status"], f["narration_text"], f["animation_description"], f["animation_action_count"]) == ("own", "", None, 0)


def test_reviewed_rows_replace_a_clips_own(spark, found):
    assert [(r["clip_id"], r["ord"], r["row"]) for r in reviewed.reviewed_rows(found).orderBy("ord").collect()] == [("a", 0, {"label": "CAR", "value": "20"}), ("a", 4, {"label": "BUS"})]
    own = spark.createDataFrame([(c, i, {"label": "own"}) for c in "abf" for i in range(2)], "clip_id string, ord int, row map<string, string>")
    got = sorted((r["clip_id"], r["ord"], r["row"]["label"]) for r in reviewed.corrected(own, found).collect())
    assert got == [("a", 0, "CAR"), ("a", 4, "BUS"), ("f", 0, "own"), ("f", 1, "own")]
    assert reviewed.overlaid(found.where(F.lit(False))).count() == reviewed.reviewed_rows(found.where(F.lit(False))).count() == 0


def test_frames_of_sentences_without_bounds(spark):
    """All frames of the clip count, those after a known end too; a long clip's frames meet by time."""
    said = spark.createDataFrame([("a", "1", None, 1.0), ("a", "2", 2.0, None), ("a", "3", 3.0, 4.0), ("a", "4", 4.0, 3.0), ("b", "5", 0.0, 1.0)], "clip_id string, sentence_id string, start double, end double")
    frames = spark.createDataFrame([("a", i, f"f{i}", None if i == 1 else float(i), None) for i in range(200)], "clip_id string, idx bigint, source_frame string, time_seconds double, path string")
    for width in (None, 0.5, 60.0):
        got = {r["sentence_id"]: [f["frame_id"] for f in r["evidence_frames"]] for r in narration.frames_during(said, frames, width=width).collect()}
        assert got == {"1": ["f0", "f2", "f3"], "2": ["f0", "f2", "f3"], "3": ["f3", "f4"]}


def test_clips_from_a_csv_with_quotes(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Link,Start,End,ChartType,Title,Author,Year,SourceWebsite,ID\nhttps://youtu.be/a,3,10,Bar,"The ""best"", they say",X,2001,w,1\n')
    (clip,) = tables.read_clips(spark, str(tmp_path)).collect()
    assert (clip["raw_video_title"], clip["channel"], clip["year"]) == ('The "best", they say', "X", 2001)
