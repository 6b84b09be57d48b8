"""Joins over time buckets, labels and aliases, windows in chunks and lines of charts, against every pair tried."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from factframe.operators import facts, joins, keyframes, labels, ordering, series

rng = random.Random(21)
SPAN = "clip long, {0} long, {0}_a double, {0}_z double"


def spans(name, n):
    rows = []
    for i in range(n):
        a = rng.choice([None, *(rng.randrange(0, 120) / 4 for _ in range(9))])
        z = rng.choice([None, -1.0]) if rng.random() < 0.1 else None if a is None else a + rng.choice([0.0, 0.25, 1.0, 3.0, 500.0])
        rows.append((rng.randrange(3), i, a, z))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    left, right = spans("s", 50), spans("r", 40)
    return left, right, spark.createDataFrame(left, SPAN.format("s")), spark.createDataFrame(right, SPAN.format("r"))


@pytest.mark.parametrize("most", [1024, 3])
@pytest.mark.parametrize(("closed", "missing"), [(False, False), (True, True)])
def test_overlaps(monkeypatch, tables, most, closed, missing):
    monkeypatch.setattr(joins, "MOST_BUCKETS", most)
    left, right, a, b = tables
    want = []
    for c, i, s, e in left:
        for d, j, t, f in right:
            if c == d:
                if None in (s, e, t, f):
                    want += [(i, j)] if missing else []
                elif min(e, f) > max(s, t) or closed and min(e, f) == max(s, t):
                    want.append((i, j))
    got = joins.overlapping(a, b, ["clip"], ("s_a", "r_a"), ("s_z", "r_z"), closed, missing, width=2.0)
    assert got.columns == ["clip", "s", "s_a", "s_z", "r", "r_a", "r_z", "clip_start", "clip_end"]
    assert sorted((r["s"], r["r"]) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("closed, missing", [(False, False), (True, True)])
def test_bounded_overlap_is_one_join_and_whole(spark, monkeypatch, tables, closed, missing):
    monkeypatch.setattr(joins, "MOST_BUCKETS", 3)
    _, _, a, b = tables
    args = ["clip"], ("s_a", "r_a"), ("s_z", "r_z"), closed, missing
    got, plain = joins.overlapping(a, b, *args, width=2.0, bounded=True), joins.overlapping(a, b, *args)
    assert got.columns == plain.columns and sorted((r["s"], r["r"]) for r in got.collect()) == sorted((r["s"], r["r"]) for r in plain.collect())
    assert got._jdf.queryExecution().analyzed().toString().count("Join ") == (3 if missing else 1)


@pytest.mark.parametrize("most", [1024, 3])
def test_containment_and_cover(monkeypatch, spark, tables, most):
    monkeypatch.setattr(joins, "MOST_BUCKETS", most)
    left, right, a, b = tables
    whole = lambda *x: None not in x
    want = [(i, j) for c, i, s, e in left for d, j, t, f in right if c == d and whole(s, e, t, f) and s >= t - 0.3 and e <= f + 0.3]
    assert sorted((r["s"], r["r"]) for r in joins.contained(a, b, ["clip"], ("s_a", "r_a"), ("s_z", "r_z"), 0.3, width=2.0).collect()) == sorted(want)
    points = [(rng.randrange(4), i, rng.choice([None, 0.0, 3.25, rng.randrange(0, 140) / 4])) for i in range(60)]
    want = {i: min((j for d, j, s, f in right if c == d and whole(at, s, f) and s <= at <= f), default=None) for c, i, at in points}
    got = joins.covering(spark.createDataFrame(points, "clip long, p long, at double"), b, ["clip"], "at", "r_a", "r_z", "r", width=2.0)
    assert {r["p"]: r["interval"]["r"] if r["interval"] else None for r in got.collect()} == want


def test_states_at_times(spark):
    states = [(c, s, a / 4, a / 4 + rng.choice([0.0, 0.5, 4.0])) for c in range(2) for s, a in enumerate(sorted(rng.randrange(0, 200) for _ in range(12)))] + [(0, 99, None, 1.0)]
    targets = [(rng.randrange(3), i, rng.randrange(-40, 260) / 4) for i in range(120)]
    want = {}
    for c, i, t in targets:
        found = [(max(a - 0.25 - t, t - z - 0.25, 0), a, z, s) for d, s, a, z in states if c == d and a is not None]
        if found:
            want[i] = (min(found)[0], min(found)[1:3])
    rows = spark.createDataFrame(states, "clip long, s long, state_start double, state_end double"), spark.createDataFrame(targets, "clip long, i long, t double")
    for width in (None, 3.0):
        got = series.state_at(*rows, ["clip"], "t", 0.25, width)
        assert {r["i"]: (r["gap"], (r["state_start"], r["state_end"])) for r in got.collect()} == want


def test_one_clip_with_very_many_sentences_and_words(spark):
    n = 200_000
    said = spark.range(n).select(F.lit(1).alias("clip"), F.col("id").alias("s"), (F.col("id") * 2.0).alias("s_a"), (F.col("id") * 2.0 + 2.0).alias("s_z"))
    words = spark.range(n).select(F.lit(1).alias("clip"), F.col("id").alias("w"), (F.col("id") * 2.0 + 0.5).alias("w_a"), (F.col("id") * 2.0 + 1.5).alias("w_z"))
    met = joins.overlapping(said, words, ["clip"], ("s_a", "w_a"), ("s_z", "w_z"), width=20.0)
    assert met.agg(F.count("*"), F.count_if(F.col("s") == F.col("w"))).first() == (n, n)
    points = words.select("clip", "w", F.col("w_a").alias("at"))
    assert joins.covering(points, said, ["clip"], "at", "s_a", "s_z", "s", 20.0).where(F.col("interval.s") == F.col("w")).count() == n
    states = said.select("clip", "s", F.col("s_a").alias("state_start"), (F.col("s_a") + 0.25).alias("state_end"))
    assert series.state_at(states, points, ["clip"], "at", width=20.0).where("s = w AND gap = 0.25").count() == n


def test_labels_match_by_words(spark):
    make = lambda: " ".join(rng.choice(["Insured", "united", "STATES", "$20,000", "uk", "Less", "-"]) for _ in range(rng.randrange(0, 4)))
    a, b = {make() for _ in range(25)} | {"Uninsured United States", "the"}, {make() for _ in range(25)} | {"Insured United States", "The the"}
    split = lambda x: {w for w in "".join(c if c.isalnum() else " " for c in x.lower()).split()}
    want = sorted((x, y) for x in a for y in b if split(x) and split(y) and (split(x) <= split(y) or split(y) <= split(x)))
    got = labels.matching(spark.createDataFrame([(x,) for x in [*a, *a, None]], "own string"), spark.createDataFrame([(y,) for y in [*b, None]], "other string"), "own", "other")
    assert sorted(map(tuple, got.collect())) == want and ("Uninsured United States", "Insured United States") not in want


@pytest.mark.parametrize("chars", [2_000_000, 8])
def test_aliases_of_a_table(monkeypatch, spark, chars):
    monkeypatch.setattr(labels, "ALIAS_CHARS", chars)
    texts = [(1, "A Car, a cargo ship and a 747"), (2, None), (3, ""), (4, "carcar"), (5, "École 747 CAR")]
    names = [("car", "car"), ("auto", "car"), ("ship", "ship"), ("boeing", "747"), ("boeing", "boeing 747"), ("cargo", "cargo"), ("x", ""), ("x", None), ("car", "car"), ("school", "école")]
    want = sorted((i, e, a, t.lower().find(a) + 1) for i, t in texts if t for e, a in set(names) if a and a in t.lower())
    got = labels.mentioned(spark.createDataFrame(texts, "i long, t string"), "t", spark.createDataFrame(names, "entity string, alias string"))
    assert sorted((r["i"], r["entity"], r["alias"], r["at"]) for r in got.collect()) == want
    assert labels.mentioned(spark.createDataFrame(texts, "i long, t string"), "t", spark.createDataFrame([], "entity string, alias string")).count() == 0


def test_windows_in_chunks(spark):
    rows = [(rng.choice([None, "a", "b"]), i, rng.choice([None, float(rng.randrange(50))])) for i in range(200)]
    table = spark.createDataFrame(rows, "g string, i long, v double").repartition(5)
    groups = {g: sorted((r for r in rows if r[0] == g), key=lambda r: r[1]) for g in (None, "a", "b")}
    numbers = {r["i"]: r["n"] for r in ordering.numbered_apart(table, ["g"], [F.col("i")]).collect()}
    assert numbers == {r[1]: n for own in groups.values() for n, r in enumerate(own, 1)}
    want = {}
    for own in groups.values():
        for k, r in enumerate(own):
            near = [x[2] for x in own[max(0, k - 2) : k + 3] if x[2] is not None]
            want[r[1]] = statistics.median(near) if near else None
    for chunk in (7, 1000):
        got = series.rolling_median(table, ["g"], [F.col("i")], "v", chunk=chunk)
        assert got.columns == ["g", "i", "v", "smooth"] and {r["i"]: r["smooth"] for r in got.collect()} == want
    frames = spark.createDataFrame([(1, i, [float(i * i), 1.0]) for i in range(30)], "g long, i long, px array<double>")
    plain = {r["i"]: r["motion"] for r in keyframes.motion(frames, ["g"], "i", "px").collect()}
    assert {r["i"]: r["motion"] for r in keyframes.motion(frames, ["g"], "i", "px", 4).collect()} == plain


def test_all_points_of_a_line_are_final(spark):
    points = spark.createDataFrame([("c", 0, 0, "Net additions", "2000-01", 133600.0), ("c", 0, 1, "Net additions", "2007-08", 221600.0), ("c", 0, 2, "Net additions", "", None), ("d", 0, 4, None, None, 5.0)], "clip_id string, line long, idx long, series string, x_label string, value double")
    clips = spark.createDataFrame([("c", 5.0, "selected", "selected.png", None, None), ("d", None, None, None, "%", "???"), ("e", 1.0, "f", None, "", "")], "clip_id string, at double, frame_id string, path string, unit string, series_label string")
    states = facts.line_states(points, clips)
    got = {(r["clip_id"], r["state_id"]): (r["state_key"], r["entity_id"], r["entity"], r["value"], r["needs_review"]) for r in states.collect()}
    assert got == {("c", "state_001"): ("2000-01", "net-additions", "Net additions", 133600.0, True), ("c", "state_002"): ("2007-08", "net-additions", "Net additions", 221600.0, True), ("d", "state_001"): ("4", "series", "???", 5.0, True)}
    told = {r["clip_id"]: (r["n_states"], r["data_change_count"], r["dynamic_data"], r["include_in_dataset"]) for r in facts.line_summary(states, clips).collect()}
    assert told == {"c": (2, 0, True, True), "d": (1, 0, False, True), "e": (0, 0, False, False)}
    old = spark.createDataFrame([("c", 1.0), ("x", 2.0)], "clip_id string, value double")
    assert sorted((r["clip_id"], r["value"]) for r in facts.replaced(old, states, clips).collect()) == [("c", 133600.0), ("c", 221600.0), ("d", 5.0), ("x", 2.0)]


def test_curves_at_ticks(spark):
    path = spark.createDataFrame([(g, float(x), float(x * x)) for g in (1, 2, 3) for x in range(0, 40, 3)], "g long, x double, y double")
    ticks = spark.createDataFrame([(1, 4.5), (1, 100.0), (1, 1.0), (2, 5.0), (2, None)], "g long, tick double")
    got = facts.curve_points(path, ticks, ["g"]).collect()
    assert sorted((r["g"], r["idx"], r["x"]) for r in got if r["g"] == 1) == [(1, 0, 0.0), (1, 1, 3.0), (1, 2, 39.0)]
    assert sorted((r["idx"], r["x"], r["y"]) for r in got if r["g"] == 2) == [(i, 3.0 * i, 9.0 * i * i) for i in range(14)]
