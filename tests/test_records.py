"""Whole records: the small cases of their contracts, and random ones against plain step-by-step versions."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from factframe.operators import facts as op
from factframe.operators import models, narration, quality
from factframe.operators.visual import visual_facts, with_frames
from factframe.sources import tables

FIELDS = [x.split(":")[0].split()[0] for x in op.RECORD.replace(op.FRAME, "f").split(", ")]


def records(spark, made, source="visual"):
    """made: dicts of what differs from a plain record."""
    base = dict.fromkeys(FIELDS) | {"clip_id": 1, "entity_id": "car", "metric": "value", "source_type": source, "evidence_frames": [], "confidence": 0.5, "review_status": "machine", "value_type": "exact"}
    rows = [base | {"ord": i, "state_end": m.get("state_start")} | m for i, m in enumerate(made)]
    return spark.createDataFrame([tuple(r[c] for c in FIELDS) for r in rows], op.RECORD)


def states(spark, made):
    return op.with_state_ids(op.merge_states(records(spark, made)))


def moment(value, start, **more):
    return {"value": float(value), "state_start": start, **more}


def test_neighbours_that_say_the_same_merge(spark):
    (one,) = states(spark, [moment(10, 0.0, state_end=0.5), moment(10, 0.5, state_end=1.0)]).collect()
    assert (one["state_start"], one["state_end"], one["n_facts"]) == (0.0, 1.0, 2)
    got = states(spark, [moment(10, 0.0), moment(20, 0.5), moment(10, 1.0)]).orderBy("place").collect()
    assert [(r["value"], r["state_id"]) for r in got] == [(10, "state_001"), (20, "state_002"), (10, "state_003")]


def test_changes(spark):
    got = op.change_events(states(spark, [moment(10, 0.0), moment(10, 1.0), moment(20, 2.0), moment(20, 3.0, unit="%")])).orderBy("event_id").collect()
    assert [(r["event_id"], r["event_type"], r["value"], r["unit"]) for r in got] == [("event_001", "insert", 10, None), ("event_002", "update", 20, None), ("event_003", "update", 20, "%")]


def test_states_of_one_key(spark):
    got = states(spark, [moment(v, t, entity_id=e, state_key="1990") for e, v, t in (("a", 1, 0.0), ("b", 2, 0.5), ("c", 3, 1.0))]).collect()
    assert {(r["state_id"], r["state_key"], r["state_label"], r["state_start"], r["state_end"]) for r in got} == {("state_001", "1990", "1990", 0.0, 1.0)}
    made = [moment(v, t, entity_id=e, state_key=y) for y, e, v, t in (("1990", "a", 48, 0.0), ("1990", "b", 15.5, 0.0), ("2017", "a", 35.9, 1.0), ("2017", "b", 6.8, 1.0))]
    two = states(spark, made)
    assert sorted(r["state_id"] for r in two.collect()) == ["state_001"] * 2 + ["state_002"] * 2
    assert [r["event_type"] for r in op.change_events(two).orderBy("event_id").collect()] == ["insert", "insert", "update", "update"]
    assert {r["entity_id"]: r["value"] for r in op.final_table(two).collect()} == {"a": 35.9, "b": 6.8}


def test_conflicts_need_review(spark):
    a, b = records(spark, [moment(20, 0.0)]), records(spark, [moment(30, 0.0, unit="%", evidence_sentence_id="7")], "narration")
    got = {r["source_type"]: r for r in op.fuse(a, b).collect()}
    assert {r["review_status"] for r in got.values()} == {"needs_review"} and got["visual"]["conflict_with"]["value"] == 30 and got["narration"]["conflict_with"]["source_type"] == "visual"
    (both,) = op.fuse(a, records(spark, [moment(20, 3.0, evidence_sentence_id="7", confidence=0.9)], "narration")).collect()
    assert (both["source_type"], both["confidence"], both["evidence_sentence_id"]) == ("both", 0.9, "7")


def plainly_fused(visual, said):
    out = [dict(r) for r in visual]
    key = lambda r: (r["value"], r["unit"] or None)
    for n in said:
        met = [r for r in out if r["entity_id"] == n["entity_id"]]
        clash = False
        for r in met:
            if key(r) == key(n):
                r["source_type"] = "both" if r["source_type"] == "visual" else r["source_type"]
                r["evidence_sentence_id"], r["review_status"], r["confidence"] = n["evidence_sentence_id"], "machine", max(r["confidence"] or 0, n["confidence"] or 0)
            else:
                clash, r["review_status"], r["conflict_with"] = True, "needs_review", ("narration", n["value"])
        if clash or not met:
            out.append(dict(n) | ({"review_status": "needs_review", "conflict_with": ("visual", None)} if clash else {}))
    return out


def plainly_merged(rows):
    """The contract record by record: what a run says and where it ends, as far as it goes."""
    out = []
    for e in sorted({r["entity_id"] for r in rows}):
        own = []
        for r in sorted((dict(r) for r in rows if r["entity_id"] == e), key=lambda r: (r["state_start"] or 0.0, r["ord"])):
            p = own[-1] if own else None
            same = p and all(p[c] == r[c] for c in ("value", "review_status", "state_key")) and (p["unit"] or None) == (r["unit"] or None)
            if same and (p["state_end"] is None or r["state_start"] is None or r["state_start"] >= p["state_end"]):
                p["state_end"] = r["state_end"] if r["state_end"] is not None else p["state_end"]
                p["confidence"] = max(p["confidence"] or 0, r["confidence"] or 0)
                p["evidence_sentence_id"] = p["evidence_sentence_id"] or r["evidence_sentence_id"]
                met = {p["source_type"], r["source_type"]}
                if len(met) == 2 and met <= {"visual", "narration", "both"}:
                    p["source_type"] = "both"
            else:
                own.append(r)
        out += own
    return out


MERGED = ["entity_id", "value", "state_start", "state_end", "confidence", "source_type", "evidence_sentence_id"]


def merged_rows(rows):
    """A blank sentence id is none."""
    return sorted(((r["clip_id"], *(r[f] if f != "evidence_sentence_id" else r[f] or None for f in MERGED)) for r in rows), key=str)


def test_merging_equals_the_plain_loop(spark):
    rng = random.Random(11)
    pick = lambda: {"entity_id": rng.choice("ab"), "value": rng.choice([None, 1.0, 1.0, 1.0, 2.0]), "unit": rng.choice(["", None]), "state_start": rng.choice([None, 0.0, 1.0, 2.0, 3.0, 4.0]), "state_end": rng.choice([None, None, 0.5, 1.5, 2.5, 9.0]), "state_key": rng.choice([None, None, "x"]), "confidence": rng.choice([None, 0.2, 0.9]), "evidence_sentence_id": rng.choice(["", None, "3", "4"]), "source_type": rng.choice(["visual", "narration", "both", "visual_frame_align", op.ALIGNED, "other"]), "review_status": rng.choice(["machine", "machine", "needs_review"])}
    rows = records(spark, [{"clip_id": c, **pick()} for c in range(300) for _ in range(rng.randint(1, 14))])
    plain = [r.asDict() for r in rows.collect()]
    want = [r for c in range(300) for r in plainly_merged([p for p in plain if p["clip_id"] == c])]
    assert merged_rows(op.merge_states(rows).collect()) == merged_rows(want)


def test_a_run_without_an_end_takes_what_follows(spark):
    made = [{"value": 1.0, "state_start": s, "state_end": e} for s, e in ((0.0, 10.0), (5.0, None), (6.0, None))]
    assert [(r["state_start"], r["n_facts"]) for r in op.merge_states(records(spark, made)).orderBy("state_start").collect()] == [(0.0, 1), (5.0, 2)]
    made = [{"value": 1.0, "state_start": s, "state_end": s + 1, "source_type": t} for s, t in ((0.0, "visual"), (1.0, op.ALIGNED))]
    assert [(r["source_type"], r["n_facts"]) for r in op.merge_states(records(spark, made)).collect()] == [("visual", 2)]


def test_fusion_and_merging_equal_the_plain_steps(spark):
    rng = random.Random(6)
    for _ in range(2):
        make = lambda n: [{"clip_id": c, "entity_id": rng.choice("ab"), "value": rng.choice([None, 1.0, 2.0]), "unit": rng.choice(["", None, "%"]), "state_start": (s := rng.choice([None, 0.0, 1.0, 2.0, 3.0])), "state_end": s if s is None else s + rng.choice([0.0, 1.0]), "state_key": rng.choice([None, "x"]), "confidence": rng.choice([None, 0.2, 0.9]), "evidence_sentence_id": str(rng.randint(1, 9))} for c in range(100) for _ in range(rng.randint(0, n))]
        visual, said = make(4), make(4)
        a, b = records(spark, visual), records(spark, said, "narration")
        seen = ["entity_id", "value", "source_type", "evidence_sentence_id", "confidence", "review_status"]
        of = lambda rows, c: [r for r in rows if r["clip_id"] == c]
        plain = lambda df: [r.asDict() for r in df.orderBy("ord").collect()]
        va, vb = plain(a), plain(b)
        want = [(c, *(r[f] for f in seen), tuple(r.get("conflict_with") or (None, None))) for c in range(100) for r in plainly_fused(of(va, c), of(vb, c))]
        got = [(r["clip_id"], *(r[f] for f in seen), tuple(r["conflict_with"][:2]) if r["conflict_with"] else (None, None)) for r in op.fuse(a, b).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        fields = ["entity_id", "value", "state_start", "state_end", "confidence", "source_type", "evidence_sentence_id"]
        both = a.unionByName(b.withColumn("ord", F.col("ord") + 1000))
        want = [(c, *(r[f] for f in fields)) for c in range(100) for r in plainly_merged(of(plain(both), c))]
        assert sorted(((r["clip_id"], *(r[f] for f in fields)) for r in op.merge_states(both).collect()), key=str) == sorted(want, key=str)


LINE = "clip_id string, ord bigint, state string, year int, label string, series string, x string, y string, metric string, value string, unit string, raw_text string, evidence_text string, source_frame string, time_seconds double, confidence double"


def test_axis_ticks_and_frames(spark):
    rows = [("c", i, None, None, e, None, None, None, None, v, None, None, None, f, t, None) for i, (e, v, t, f) in enumerate([(e, str(v), 0.02, None) for e in ("cyclists", "drivers") for v in (0, 50, 100)] + [("cyclists", "88%", 9.0, "f2"), ("drivers", "85%", None, "f2"), ("walkers", "7", None, None)])]
    frames = spark.createDataFrame([("c", 0, "f1", 0.0, "p1"), ("c", 1, "f2", 1.0, None)], tables.FRAMES)
    got = visual_facts(with_frames(spark.createDataFrame(rows, LINE), frames)).orderBy("ord").collect()
    assert [(r["value"], r["unit"], r["state_start"], r["evidence_frames"][0]["frame_id"]) for r in got] == [(88, "%", 1.0, "f2"), (85, "%", 1.0, "f2"), (7, None, 0.0, "f1")]


def test_narration(spark):
    sentences = spark.createDataFrame(
        [("a", "7", 1, "CAR reaches 80 miles.", 1.0, 2.0, None), ("b", "1", 1, "A 747 would need 28 straight days, and a spaceship with current technology would need two full days.", 0.0, 4.0, 0.9), ("b", "2", 2, "And in a car, a lot of time.", 5.0, 6.0, 0.9), ("b", "3", 3, "A car takes 9 years.", 50.0, 60.0, 0.9), ("d", "1", 1, "The car increases quickly.", None, None, None)],
        tables.SENTENCES,
    )
    aliases = narration.chart_aliases(spark.createDataFrame([("b", 0, "Boeing 747"), ("b", 1, "Spaceship")], tables.LABELS), spark.createDataFrame([("a", ""), ("b", ""), ("d", "")], "clip_id string, text string"))
    windows = spark.createDataFrame([("b", 4.0, 20.0)], tables.WINDOWS)
    frames = spark.createDataFrame([("b", i, f"f{i}", float(i), None) for i in range(8)], tables.FRAMES)
    got = narration.narration_facts(sentences, aliases, windows, frames).orderBy("clip_id", "ord").collect()
    assert sorted(((r["clip_id"], r["entity_id"], r["value"], r["unit"], r["evidence_sentence_id"]) for r in got), key=lambda r: (r[0], r[4], r[1])) == [("a", "car", 80.0, "miles", "7"), ("b", "boeing-747", 28.0, "day", "1"), ("b", "spaceship", 2.0, "day", "1"), ("b", "car", None, "day", "2")]
    by = {(r["clip_id"], r["entity_id"]): r for r in got}
    assert by["b", "car"]["value_type"] == 'qualitative: "a lot of time"' and [f["frame_id"] for f in by["b", "boeing-747"]["evidence_frames"]] == ["f0", "f1", "f2"]
    done = op.with_state_ids(op.merge_states(narration.narration_facts(sentences, aliases, windows, frames)))
    assert {r["clip_id"]: (r["data_completeness"], r["data_change_count"]) for r in op.summary(done).collect()} == {"a": ("complete", 1), "b": ("partial", 3)}


def planned(spark, made, chart="bar", limit=8):
    done = states(spark, [{"evidence_frames": [(f"f{m['state_start']}", m["state_start"], None)], **m} for m in made])
    clips = op.summary(done).withColumn("chart_type", F.lit(chart))
    plans, rows = op.plan_states(done, clips, limit)
    return plans.first()["reason"], [r["state_id"] for r in rows.orderBy("state_start").collect()]


def test_state_plans(spark):
    years = [moment(i, float(i), state_key=str(2000 + i)) for i in range(12)]
    reason, kept = planned(spark, years, limit=4)
    assert reason == op.SELECTED and kept == ["state_001", "state_005", "state_008", "state_012"]
    one_frame = [{**y, "evidence_frames": [("f", 1.0, None)]} for y in years[:4]]
    assert planned(spark, one_frame, "line") == ("static_chart_points_from_single_visual_frame", [])
    assert planned(spark, years[:1]) == ("not_dynamic_recovered_data", [])
    assert planned(spark, [years[0], {**years[1], "evidence_frames": []}])[0] == "fewer_than_two_complete_evidenced_data_states"
    assert planned(spark, [moment(1, 0.0), moment(2, 1.0), moment(1, 2.0)])[0] == "no_entity_or_value_change"


@pytest.mark.parametrize(
    ("made", "direction"),
    [
        ([("a", "2000-01", 9, 5.0), ("a", "2010-11", 3, 0.0)], "decrease"),
        ([("a", "1", 1, 0.0), ("b", "1", 5, 0.0), ("a", "2", 2, 1.0), ("b", "2", 1, 1.0)], "mixed"),
        ([("a", "1", 1, 0.0)], None),
        ([("a", "1", 1, 0.0), ("b", "2", 2, 1.0)], None),
    ],
)
def test_intent(spark, made, direction):
    done = states(spark, [moment(v, t, entity_id=e, state_key=k) for e, k, v, t in made])
    (got,) = op.reconciled(spark.createDataFrame([(1, "Line")], "clip_id bigint, chart_type string"), done).collect()
    assert got["data_direction"] == direction and got["metric"] is None
    assert got["actions"] == {"decrease": ["line_draw_downward"], "mixed": ["line_draw_upward", "line_draw_downward"], None: None}[direction]


BAR = "clip_id bigint, idx bigint, entity_id string, label string, value double, value_text string, value_type string, value_estimated boolean, value_plausible boolean, plausibility_message string"
CLIP = "clip_id bigint, at double, tick_unit string, frame_id string, path string"


def bars(spark, made):
    return spark.createDataFrame([(1, i, e, e, v, None, None, None, ok, m) for i, (e, v, ok, m) in enumerate(made)], BAR)


def test_upsert_of_bars(spark):
    done = states(spark, [moment(v, 1.0, entity_id=e, entity=e, state_key="2017", unit=u) for e, v, u in (("a", 1, ""), ("b", 2, "kg"), ("c", 3, ""))])
    clip = spark.createDataFrame([(1, 1.0, "$", "k", "p")], CLIP)
    out, skipped = op.upsert_bars(done, bars(spark, [("a", 36.1, None, None), ("b", 6.9, True, None), ("c", 5.1, False, "too far"), ("d", 1.0, None, None), ("", 9.0, None, None), ("e", None, None, None)]), clip)
    got = {r["entity_id"]: (r["value"], r["unit"], r["action"]) for r in out.collect()}
    assert got == {"a": (36.1, "$", "updated"), "b": (6.9, "kg", "updated"), "c": (3.0, "", "kept"), "d": (1.0, "$", "created")}
    assert sorted((r["entity_id"], r["reason"]) for r in skipped.collect()) == [("c", "too far"), ("e", "no numeric value")]
    made, _ = op.upsert_bars(done.limit(0), bars(spark, [("a", 5.0, None, None)]), clip)
    assert [(r["state_id"], r["confidence"], r["state_start"]) for r in made.collect()] == [("state_001", 0.85, 1.0)]


def test_cleanup(spark):
    made = [moment(v, 0.0, entity_id=e, entity=e, state_key="t") for e in ("cyclists", "drivers") for v in (0, 50, 100)]
    made += [moment(88, 1.0, entity_id="cyclists", entity="Cyclists", state_key="k", source_type=op.ALIGNED), moment(85, 1.0, entity_id="drivers", entity="Drivers", state_key="k", source_type=op.ALIGNED)]
    made += [moment(30, 1.0, entity_id="cycling", entity="cycling", metric="drivers", state_key="k"), moment(30, 5.0, entity_id="sat", entity="SAT", state_key="z")]
    got = op.cleaned_states(states(spark, made), bars(spark, [("cyclists", 88.0, None, None), ("drivers", 85.0, None, None)])).collect()
    assert sorted((r["entity_id"], r["value"]) for r in got) == [("cyclists", 88.0), ("drivers", 85.0)]


def events(spark, path, rows):
    """A folder of an events table of (event_id, user_id, event_type, value), a minute each."""
    made = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double").withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") * 60).cast("timestamp_ntz")).withColumn("props", F.lit("{}"))
    made.coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def as_its_sql(spark, d, name):
    """Rows of a query, and those of its SQL."""
    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{d}/events.parquet/*.parquet'")
    key = lambda r: tuple((x is not None, x) for x in r)
    got = entry.queries()[name](spark, d)
    said = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in said.description]
    return sorted(map(tuple, got.select(names).collect()), key=key), sorted(said.fetchall(), key=key)


def test_states_without_a_start_are_at_no_moment_of_the_query(spark, tmp_path):
    made = [(53, "click", 50.0), (159, "click", 150.0), (265, "purchase", 50.0), (371, "purchase", 150.0), (300, "view", 500.0)]
    got, said = as_its_sql(spark, events(spark, tmp_path, [(n, 7, kind, value) for n, kind, value in made]), "clean_states")
    assert got == said and [r[3] for r in got if r[1] == "purchase"] == [0.0, 1.0]


def test_tasks_of_records_stay_small(spark, tmp_path, monkeypatch):
    from factframe.plans import adapters, record_queries

    d = events(spark, tmp_path, [(n, n % 40, "click" if n % 2 else "view", n % 7 * 100.0) for n in range(400)])
    monkeypatch.setattr(adapters.parts, "__defaults__", (20,))
    # 400 records at 20 a task: the clips' partitions hold for states, and are neither merged by size nor dealt out again.
    assert record_queries.fact_islands(spark, d).rdd.getNumPartitions() == record_queries.state_ids(spark, d).rdd.getNumPartitions() == record_queries.change_events(spark, d).rdd.getNumPartitions() == record_queries.fuse_sources(spark, d).rdd.getNumPartitions() == 20
    got, said = as_its_sql(spark, d, "fact_summary")
    assert got == said and len(got) == 40


def test_documents_of_one_key_are_files_of_their_own_and_read_once(spark, tmp_path):
    made = [("a b/c", "é"), ("a b/c", None), (None, "x"), ("p=q", "y")]
    root = str(tmp_path / "written")
    for _ in range(2):
        tables.write_documents(spark.createDataFrame(made, "k string, v string").repartition(3, "k"), root, "k")
    files = tables.read_files(spark, root)
    assert {(r["clip_id"], r["n_files"]) for r in tables.clip_folders(files, root).collect()} == {("k=a b%2Fc", 2), ("k=__HIVE_DEFAULT_PARTITION__", 1), ("k=p%3Dq", 1)}
    read = tables.read_documents(files, "v string").join(tables.file_hashes(files), "path").collect()
    assert sorted((r["v"] or "", r["length"]) for r in read) == [("", 11), ("x", 10), ("y", 10), ("é", 11)]
    assert sorted((r["k"] or "", r["v"] or "") for r in spark.read.schema("k string, v string").option("multiLine", True).json(root).collect()) == sorted((k or "", v or "") for k, v in made)


def chart(**more):
    import json

    return json.dumps(more)


def test_chart_rows(spark):
    row = {"label": "Car", "value": "48", "raw_text": "Car 48", "year": None}
    texts = [
        chart(states=[{"year": 1990, "source_frame": "f1", "rows": [{k: v for k, v in row.items() if k != "year"}]}, {"year": 2017, "source_frame": "f2", "rows": [row]}]),
        chart(rows=[{**row, "year": 1990}], states=[{"year": 1990, "rows": [{k: v for k, v in row.items() if k != "year"}]}]),
        chart(title="Cars", y_axis="Sales", rows=[{"label": "cars", "value": "3", "raw_text": "3"}, {"label": "sales 1990", "value": "4", "raw_text": "4"}, {"label": "1990", "value": "1990", "raw_text": "1990"}, {"label": "x", "value": "5", "unit": "Dollars", "raw_text": "5"}, {"label": "y", "value": "5", "unit": "USD", "raw_text": "$5"}, {"label": "z", "value": "1,200", "evidence_text": "none"}], visible_text=["1200 cars"]),
        chart(rows=[{"label": "unprinted", "value": "7", "raw_text": "8"}], has_extractable_data=True),
        'text {"title": "cut", "rows": [{"label": "a", "value": "1", "raw_text": "1"}, {"label": "b", "val',
        "no json",
    ]
    read = spark.createDataFrame(list(enumerate(texts)), "k int, r string").withColumn("result", models.salvaged(F.col("r"), models.CHART))
    rows = models.chart_rows(read, "k").orderBy("k", "ord").collect()
    assert [(r["k"], r["label"], r["year"], r["source_frame"]) for r in rows] == [(0, "Car", "1990", "f1"), (0, "Car", None, "f2"), (1, "Car", "1990", None), (2, "y", None, None), (2, "z", None, None), (4, "a", None, None)]
    assert rows[4]["evidence_text"] == "1200 cars"
    flags = {r["k"]: r["has_extractable_data"] for r in models.chart_flags(read, models.chart_rows(read, "k"), "k").collect()}
    assert flags == {0: True, 1: True, 2: True, 3: False, 4: True, 5: False}


def test_actions(spark):
    made = spark.sql("SELECT array(named_struct('action', 'fly', 'description', null, 'evidence_timestamps', array(0.1D, 1.4D, 0.1D))) AS a, array(0.0D, 1.5D) AS s")
    (got,) = made.select(models.animation_actions(F.col("a"), F.lit(True), F.col("s")).alias("s"), models.animation_actions(F.col("a"), F.lit(True)).alias("p"), models.animation_actions(F.col("a"), F.lit(False)).alias("n")).collect()
    assert [tuple(x) for x in got["s"]] == [("other", "", [0.0, 1.5])] and got["p"][0]["evidence_timestamps"] == [0.1, 1.4] and got["n"] == []


def test_quality_layers(spark):
    schema = "clip_id string, files array<string>, bad_json array<string>, include boolean, numeric_count bigint, exclude_reason string, n_states bigint, n_state_ids bigint, n_events bigint, dynamic boolean, extractable boolean, n_csv bigint, n_final bigint, n_event_csv bigint, planned boolean, svgs array<struct<success: boolean, svg: string>>"
    files = [*quality.REQUIRED, "semantic_state_input_manifest.json", "semantic_state_svg_manifest.json"]
    good = (files, [], True, 4, None, 4, 2, 4, True, True, 4, 2, 4, True, [(True, "a")])
    clips = spark.createDataFrame(
        [
            ("good", *good),
            ("lost", quality.REQUIRED[:3], [], None, None, None, None, None, None, None, None, None, None, None, None, None),
            ("broken", files, ["dynamic_data.json"], *good[2:]),
            ("out", files, [], False, 0, op.NO_DATA, 0, 0, 0, False, False, 0, 0, 0, False, None),
            ("odd", quality.REQUIRED, [], True, 0, None, 0, 1, 0, True, False, 0, 0, 0, True, [(False, None)]),
            ("why", files, [], False, 0, "other", 0, 0, 2, False, False, 0, 0, 1, False, None),
        ],
        schema,
    )
    found = {}
    for r in quality.rule_issues(clips).orderBy("place").collect():
        found.setdefault(r["clip_id"], []).append(r["issue_code"])
    assert found == {
        "lost": ["missing_required_file"] * 5,
        "broken": ["invalid_json"],
        "odd": ["included_without_numeric_facts", "included_without_states", "dynamic_flag_without_multiple_states_or_events", "validation_include_mismatch", "missing_dynamic_data_csv", "missing_final_data_table", "missing_semantic_state_inputs", "missing_semantic_state_svgs", "semantic_state_svg_failed"],
        "why": ["excluded_without_standard_reason", "event_csv_json_count_mismatch"],
    }
    data = spark.createDataFrame([("a", "state_001", "car", "price"), ("a", "state_002", "bus", "price"), ("b", "state_001", "car", "value")], "clip_id string, state_id string, entity_id string, metric string")
    svgs = spark.createDataFrame([("a", None, "t", True, ["entity-car"], [], []), ("a", "state_001", "s1", False, None, None, None), ("a", "state_002", "s2", True, [], ["car"], ["bar"]), ("b", None, "t", True, None, None, None), ("b", "state_001", "s1", True, None, None, None)], tables.DRAWINGS)
    crossed = quality.cross_issues(data, svgs)
    assert sorted((r["clip_id"], r["issue_code"]) for r in crossed.collect()) == [("a", "data_entity_missing_in_semantic"), ("a", "missing_state_semantic_svg"), ("a", "semantic_missing_bar_role"), ("a", "state_data_entity_missing_in_semantic"), ("b", "invalid_semantic_svg"), ("b", "invalid_state_semantic_svg")]
    answers = spark.createDataFrame([("a", "ok", (True, None, ["x", "y"])), ("b", "ok", (False, None, None)), ("c", "ok", None), ("d", "failed", None), ("e", "unavailable", None), ("f", "ok", (True, "hard_fail", None))], tables.ANSWERS)
    told = quality.model_issues(answers)
    assert sorted((r["clip_id"], r["severity"], r["issue_code"]) for r in told.collect()) == [("a", "needs_review", "x"), ("a", "needs_review", "y"), ("c", "needs_review", "qc_vlm_bad_response"), ("d", "needs_review", "qc_vlm_failed"), ("e", "needs_review", "qc_vlm_unavailable"), ("f", "hard_fail", "qc_vlm_flagged")]
    every = quality.all_issues(quality.rule_issues(clips), crossed, told)
    assert every.count() == 17 + 6 + 6 and {r["clip_id"]: r["status"] for r in quality.status(every.select("clip_id").distinct(), every, "clip_id").collect()}["b"] == "hard_fail"


def test_numbers_in_words():
    text = "Twenty-one days, one two, seventeen full miles; a hundred. two straight  years and SEVEN\npercent or someone"
    assert [(text[a:z].strip(), v) for a, z, v in narration.spoken(text)] == [("Twenty-one days", 21), ("one two", 3), ("seventeen full miles", 17), ("two straight  years", 2), ("SEVEN\npercent", 7)]
    assert [v for _, _, v in narration.spoken("éone six_two 3three twenty--  five")] == [1, 25]
