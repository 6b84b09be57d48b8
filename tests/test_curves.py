"""Marks and curves against plain loops over every choice."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factframe.operators import curves, series


def walk(values, start, step, tolerance):
    out = []
    for v in values:
        if abs(v - start) <= tolerance * step:
            out.append(v)
            start += step
    return out


def plain_even(values, tolerance, least):
    if len(values) < 3:
        return values
    best = []
    for i, j in itertools.combinations(range(len(values)), 2):
        step = (values[j] - values[i]) / (j - i)
        if j - i > 1 and step >= least and len(found := walk(values, values[i], step, tolerance)) > len(best):
            best = found
    return best


@pytest.mark.parametrize("pairs", [1 << 20, 40])
def test_even_series(monkeypatch, pairs):
    monkeypatch.setattr(curves, "_PAIRS", pairs)
    rng = random.Random(2)
    for n in range(60):
        values = sorted(rng.choice([rng.uniform(0, 400), 40.0 * rng.randrange(10), 100.0]) for _ in range(n % 15))
        assert curves.even_series(np.array(values), 0.45, 8.0).tolist() == plain_even(values, 0.45, 8.0)
    assert curves.even_series(np.array([10.0, 60, 110, 135, 160, 210]), 0.25, 8.0).tolist() == [10, 60, 110, 160, 210]


def plain_grid(points, count, tolerance, least):
    gaps = [b - a for a, b in zip(points, points[1:]) if b > a]
    if len(points) < 2 or count < 2 or not gaps:
        return points
    tried = {min(gaps)} | {g / f for g in gaps for f in (2, 3, 4) if g / f >= least}
    best, most = points, 1
    for step in sorted(tried):
        for start in points:
            grid = [start + k * step for k in range(count)]
            score = sum(any(abs(v - g) < tolerance for g in grid) for v in points)
            if score > most:
                best, most = grid, score
    return best


def test_even_grid():
    rng = random.Random(4)
    for n in range(80):
        points = sorted(67.0 * rng.randrange(12) + rng.choice([0, 0, rng.uniform(-20, 20)]) for _ in range(n % 9))
        count = rng.randrange(0, 9)
        assert curves.even_grid(np.array(points), count, 14.0, 8.0).tolist() == plain_grid(points, count, 14.0, 8.0)
    # Of gaps of 134, 134, 66 and 67 the true one is the half.
    assert curves.even_grid(np.array([0.0, 134, 268, 334, 401]), 7, 14.0, 8.0).tolist() == [66.0 * k for k in range(7)]


def test_running_means():
    assert curves.running_means(np.array([0.0, 8, 13, 25, 200]), 10) == [8.5, 25, 200]
    assert curves.running_means(np.array([]), 10) == []


def plain_simple(points, epsilon):
    if len(points) < 3:
        return points
    (ax, ay), (zx, zy) = points[0], points[-1]

    def far(p):
        long = (zx - ax) ** 2 + (zy - ay) ** 2
        t = max(0.0, min(1.0, ((p[0] - ax) * (zx - ax) + (p[1] - ay) * (zy - ay)) / long)) if long else 0.0
        return ((p[0] - ax - t * (zx - ax)) ** 2 + (p[1] - ay - t * (zy - ay)) ** 2) ** 0.5

    at = max(range(1, len(points) - 1), key=lambda i: (far(points[i]), -i))
    return plain_simple(points[: at + 1], epsilon)[:-1] + plain_simple(points[at:], epsilon) if far(points[at]) > epsilon else [points[0], points[-1]]


def test_simplify():
    rng = random.Random(5)
    for n in range(40):
        points = [(float(rng.randrange(20)), float(rng.randrange(20))) for _ in range(n)]
        x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
        assert [points[i] for i in curves.simplify(x, y, 3.0)] == plain_simple(points, 3.0)
    corner = np.arange(20_000.0)
    assert curves.simplify(corner, np.abs(corner - 7000), 5.0).tolist() == [0, 7000, 19_999]


def price(path, gap, jump):
    return sum(min(abs(b[1] - a[1]), jump + 30) + 80 * (b[0] - a[0] - 1) for a, b in zip(path, path[1:]) if b[0] - a[0] <= gap)


def test_cheapest_path_of_small_grids():
    rng = random.Random(8)
    for _ in range(60):
        xs = sorted(rng.sample(range(9), 5))
        columns = [(x, np.array(sorted({float(rng.randrange(0, 90, 10)) for _ in range(3)}))) for x in xs]
        got = curves.trace(columns, 3, 45.0, True)
        tried = [price(list(zip(xs, ys)), 3, 45.0) for ys in itertools.product(*[c[1] for c in columns])]
        assert [p[0] for p in got] == xs and price(got, 3, 45.0) == min(tried)


def test_links_one_column_at_a_time():
    columns = [(0, np.array([0.0, 50])), (1, np.array([40.0])), (2, np.array([0.0, 45])), (9, np.array([7.0, 90]))]
    # The last column stands alone, so its first value is taken, and the path goes on from the cheapest one before.
    assert curves.trace(columns, 3, 45.0, False) == [(0, 50), (1, 40), (2, 45), (9, 7)]


def test_series_of_a_table(spark):
    rows = spark.createDataFrame([(1, float(v), 5) for v in (0, 50, 100, 107, 150)] + [(2, None, 3), (3, 4.0, None), (4, 10.0, 2), (4, 10.0, 2)], "g long, v double, n long")
    assert {r["g"]: r["series"] for r in curves.dominant_even(rows, ["g"], "v").collect()} == {1: [0, 50, 100, 150], 2: [], 3: [4], 4: [10, 10]}
    assert {r["g"]: r["grid"] for r in curves.rebuilt_grid(rows, ["g"], "v", "n").collect()} == {1: plain_grid([0.0, 50, 100, 107, 150], 5, 14.0, 8.0), 2: [], 3: [4], 4: [10, 10]}
    assert curves.merged_marks(rows.limit(0), ["g"], "v").count() == 0
    cells = spark.createDataFrame([(1, x, float(y)) for x in range(4) for y in (10, 10, 60 + 5 * x)] + [(1, 2, float(y)) for y in range(100, 120)], "g long, x long, y double")
    assert curves.traced(cells, ["g"], "x", "y").first()["path"] == [(0, 10), (1, 10), (3, 10)]
    line = curves.simplified(spark.createDataFrame([(1, i, float(i), abs(i - 5.0)) for i in range(11)] + [(1, 99, None, 1.0)], "g long, i long, x double, y double"), ["g"], "x", "y", ["i"], 0.5).first()
    assert line["line"] == [(0, 5), (5, 0), (10, 5)]


def plain_tail(seen, duration, fps, margin):
    last = min(0.05, max(0.0, margin))
    seen, out = list(seen), []
    for n, offset in enumerate((0.75, 0.5, margin, last), 1):
        time = max(0.0, min(duration - last, duration - offset))
        if all(abs(time - t) > 0.5 / fps for t in seen):
            seen.append(time)
            out.append((n, time))
    return out


def test_tail_candidates(spark):
    rng = random.Random(9)
    clips = {i: rng.choice([0.0, 0.1, 0.6, 3.0, 7.3]) for i in range(60)}
    frames = {i: [rng.choice([0.0, 2.2, 2.55, 2.75, 6.5, 7.0]) for _ in range(rng.randrange(3))] for i in clips}
    for fps, margin in ((4.0, 0.25), (1.0, 0.02)):
        got = series.tail_candidates(spark.createDataFrame([(i, t) for i, ts in frames.items() for t in ts], "g long, at double"), spark.createDataFrame([*clips.items(), (99, None)], "g long, d double"), ["g"], "at", "d", fps, margin)
        assert sorted(map(tuple, got.collect())) == sorted((i, *found) for i, d in clips.items() for found in plain_tail(frames[i], d, fps, margin))
