"""Marks on an axis and points of a curve: even series, grids, clusters, simplified lines, traced paths.

Each of these is sequential within a series (an axis, a curve), so a series'
values become one array, and Arrow batches of arrays go through numpy. Series
are dealt out by their key; one of them is a row, bounded by what a frame can
show.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs that are tried at a time.
_PAIRS = 1 << 20


def _by_series(rows: DataFrame, by: list[str], values: Column, work: Callable, schema: str) -> DataFrame:
    """(by, found): `work` over each group's sorted array; nulls in it are left out."""

    @F.pandas_udf(schema)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([work(x) for x in part], dtype=object)

    return rows.groupBy(*by).agg(F.array_sort(F.collect_list(values)).alias("__v")).select(*by, run("__v").alias("found"))


def even_series(values: np.ndarray, tolerance: float, least_step: float) -> np.ndarray:
    """The evenly spaced values among sorted ones that are most; of equals, that of the first pair.

    A pair of values that lie n places apart, n at least 2, says a start and
    a step, a n-th of its span. Going up from the start, a value within
    tolerance * step of the expected one is taken, and the next is expected a
    step further. All pairs go up side by side.
    """
    n = len(values)
    if n < 3:
        return values
    best, most = None, 0
    starts = max(1, _PAIRS // n)
    for a in range(0, n - 2, starts):
        i, j = np.nonzero(np.arange(a, min(a + starts, n))[:, None] + 2 <= np.arange(n)[None, :])
        i += a
        step = (values[j] - values[i]) / (j - i)
        fits = step >= least_step
        start, step = values[i[fits]], step[fits]
        if not len(step):
            continue
        expected, hits = start.copy(), np.zeros(len(step), np.int64)
        for value in values:
            hit = np.abs(value - expected) <= tolerance * step
            hits += hit
            expected[hit] += step[hit]
        at = int(hits.argmax())
        if hits[at] > most:
            best, most = (start[at], step[at]), int(hits[at])
    if best is None:
        return values[:0]
    expected, step = best
    out = []
    for value in values:
        if abs(value - expected) <= tolerance * step:
            out.append(value)
            expected += step
    return np.array(out)


def dominant_even(rows: DataFrame, by: list[str], value: str, tolerance: float = 0.45, least_step: float = 8.0) -> DataFrame:
    """(by, series): the evenly spaced values of a group that are most, as even_series() has it; fewer than three stay as they are."""
    work = lambda x: even_series(np.asarray(x, float), tolerance, least_step)
    return _by_series(rows, by, F.col(value).cast("double"), work, "array<double>").withColumnRenamed("found", "series")


def even_grid(points: np.ndarray, count: int, tolerance: float, least_step: float) -> np.ndarray:
    """`count` evenly spaced places from sorted detections some of which are missing or stray.

    Spacings tried are the smallest gap, and halves, thirds and quarters of
    all gaps, where those are least_step at least. A grid starts at a
    detection; its score is the detections within tolerance of a place. The
    highest score wins, then the smallest spacing, then the first start.
    Under two detections on it, the detections stay as they are.
    """
    gaps = np.diff(points)
    gaps = gaps[gaps > 0]
    if len(points) < 2 or count < 2 or not len(gaps):
        return points
    shares = (gaps[:, None] / np.array([2, 3, 4])).ravel()
    spacings = np.unique(np.concatenate([[gaps.min()], shares[shares >= least_step]]))
    best, most = points, 1
    for spacing in spacings:
        place = np.clip(np.rint((points[None, :] - points[:, None]) / spacing), 0, count - 1)
        score = (np.abs(points[None, :] - (points[:, None] + place * spacing)) < tolerance).sum(1)
        at = int(score.argmax())
        if score[at] > most:
            best, most = points[at] + np.arange(count) * spacing, int(score[at])
    return best


def rebuilt_grid(rows: DataFrame, by: list[str], value: str, count: str, tolerance: float = 14.0, least_step: float = 8.0) -> DataFrame:
    """(by, grid): a group's detections as an even grid of as many places as its labels, the largest `count` of its rows; see even_grid()."""

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for points, counts in parts:
            yield pd.Series([even_grid(np.asarray(p, float), int(n), tolerance, least_step) for p, n in zip(points, counts)], dtype=object)

    grouped = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.col(value).cast("double"))).alias("__v"), F.coalesce(F.max(count), F.lit(0)).cast("long").alias("__n"))
    return grouped.select(*by, run("__v", "__n").alias("grid"))


def running_means(values: np.ndarray, gap: float) -> list[float]:
    """Clusters of sorted values: one within `gap` of the last cluster moves it half way to itself, another is a new one."""
    out: list[float] = []
    for value in values.tolist():
        if out and value - out[-1] <= gap:
            out[-1] = (out[-1] + value) / 2
        else:
            out.append(value)
    return out


def merged_marks(rows: DataFrame, by: list[str], value: str, gap: float = 10.0) -> DataFrame:
    """(by, marks): a group's values merged as running_means() has it."""
    work = lambda x: running_means(np.asarray(x, float), gap)
    return _by_series(rows, by, F.col(value).cast("double"), work, "array<double>").withColumnRenamed("found", "marks")


def _far(x: np.ndarray, y: np.ndarray, a: int, z: int) -> tuple[int, float]:
    """The first of the points between a and z that are farthest from the segment of those two, and how far."""
    dx, dy = x[z] - x[a], y[z] - y[a]
    px, py, long = x[a + 1 : z] - x[a], y[a + 1 : z] - y[a], dx * dx + dy * dy
    t = np.clip((px * dx + py * dy) / long, 0.0, 1.0) if long else np.zeros(z - a - 1)
    far = np.sqrt((px - t * dx) ** 2 + (py - t * dy) ** 2)
    at = int(far.argmax())
    return a + 1 + at, float(far[at])


def simplify(x: np.ndarray, y: np.ndarray, epsilon: float) -> np.ndarray:
    """Places of the points that a line needs: its ends, and from each stretch the farthest point from the straight line, if over epsilon, on either side of which it goes on."""
    if len(x) <= 2:
        return np.arange(len(x))
    kept, open_ = {0, len(x) - 1}, [(0, len(x) - 1)]
    while open_:
        a, z = open_.pop()
        if z - a < 2:
            continue
        at, far = _far(x, y, a, z)
        if far > epsilon:
            kept.add(at)
            open_ += [(a, at), (at, z)]
    return np.array(sorted(kept))


_POINTS = "array<struct<x: double, y: double>>"


def _points(x: np.ndarray, y: np.ndarray) -> list[tuple[float, float]]:
    return list(zip(x.tolist(), y.tolist()))


def simplified(rows: DataFrame, by: list[str], x: str, y: str, order: list[str], epsilon: float = 5.0) -> DataFrame:
    """(by, line): a group's points (x, y), in order, that simplify() keeps; points without a place are left out."""
    known = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())

    def work(points) -> list:  # noqa: ANN001
        px, py = np.array([p["x"] for p in points], float), np.array([p["y"] for p in points], float)
        kept = simplify(px, py, epsilon)
        return _points(px[kept], py[kept])

    placed = [F.col(c).alias(f"at{n}") for n, c in enumerate(order)]
    return _by_series(known, by, F.struct(*placed, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")), work, _POINTS).withColumnRenamed("found", "line")


def trace(columns: list[tuple[int, np.ndarray]], gap: int, jump: float, whole: bool) -> list[tuple[float, float]]:
    """One value a column, right to left, so that jumps are small.

    columns: (x, sorted values) by x. A value is linked to the one of the
    column before that costs least: the jump, at most `jump` + 30, and 80 for
    each column in between. Beyond `gap` columns the path begins anew. It
    goes back from the cheapest value of the last column, and where it began
    anew, from the cheapest of the column before. The cost of a value is its
    link's alone, or, if `whole`, that of the path up to it, so that the path
    is the cheapest of all. The smallest of equals is taken.
    """
    costs: list[np.ndarray] = []
    links: list[np.ndarray | None] = []
    for k, (x, ys) in enumerate(columns):
        if not k or x - columns[k - 1][0] > gap:
            costs.append(np.zeros(len(ys)))
            links.append(None)
            continue
        each = np.minimum(np.abs(ys[:, None] - columns[k - 1][1][None, :]), jump + 30) + 80 * (x - columns[k - 1][0] - 1)
        if whole:
            each = each + costs[-1][None, :]
        links.append(each.argmin(1))
        costs.append(each.min(1))
    out: list[tuple[float, float]] = []
    at = None
    for (x, ys), cost, link in zip(reversed(columns), reversed(costs), reversed(links)):
        at = int(cost.argmin()) if at is None else at
        out.append((float(x), float(ys[at])))
        at = None if link is None else int(link[at])
    return out[::-1]


def traced(rows: DataFrame, by: list[str], x: str, y: str, gap: int = 3, jump: float = 45.0, most: int = 14, whole: bool = False) -> DataFrame:
    """(by, path): of each group's candidates y in columns x, whole numbers, one a column, as trace() has it.

    A column of over `most` candidates says nothing and is left out before
    anything is gathered; repeated candidates count once.
    """
    columns = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(x).cast("long").alias("x")).agg(F.array_sort(F.collect_set(F.col(y).cast("double"))).alias("ys")).where(F.size("ys") <= most)
    work = lambda found: trace([(c["x"], np.asarray(c["ys"], float)) for c in found], gap, jump, whole)
    return _by_series(columns, by, F.struct("x", "ys"), work, _POINTS).withColumnRenamed("found", "path")
