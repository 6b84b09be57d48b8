"""Exact top-k inner products in three phases with a uniform threshold."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_folder, finite_vector, scratch_folder

#: Distinct queries of a block, and bytes of their components: what is broadcast at a time.
BLOCK_QUERIES, BLOCK_BYTES = 16_384, 64 << 20
#: Scores that a task holds at a time.
_CELLS = 4 << 20
_LONG = 2**63 - 1


class _Block:
    """A block of queries by length: their numbers, components, and the cutoffs known so far."""

    def __init__(self, rows: list):
        self.of = {}
        for dim in {len(r["v"]) for r in rows}:
            own = [r for r in rows if len(r["v"]) == dim]
            self.of[dim] = (np.array([r["q"] for r in own], np.int64), np.array([r["v"] for r in own], np.float64))
        self.at = {int(q): (dim, i) for dim, (qs, _) in self.of.items() for i, q in enumerate(qs)}
        self.cutoff: dict[int, int] = {}


def _cuts(dim: int, lists: int) -> list[int]:
    return [dim * i // lists for i in range(lists + 1)]


def _matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, components) of the arrays in a column, by the length of the whole vector."""
    dims, values = batch.column("dim").to_numpy(zero_copy_only=False), batch.column(column)
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield int(dim), rows, values.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _best(scores: np.ndarray, ids: np.ndarray, held: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row, with those held so far: (scores, ids)."""
    scores, ids = np.concatenate([held[0], scores], axis=1), np.concatenate([held[1], np.broadcast_to(ids, scores.shape)], axis=1)
    if scores.shape[1] <= k:
        return scores, ids
    at = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)


def _gather(shared, r: int, lists: int, k: int):  # noqa: ANN001, ANN202
    """Phase 1 in a task: the k entries of list r with the highest part scores, for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = shared.value, {}
        for batch in batches:
            cls = batch.column("cls").to_numpy()
            for dim, rows, part in _matrices(batch, f"p{r}"):
                if dim not in block.of:
                    continue
                qs, asked = block.of[dim]
                asked = asked[:, slice(*_cuts(dim, lists)[r : r + 2])]
                old = held.get(dim, (np.empty((len(qs), 0)), np.empty((len(qs), 0), np.int64)))
                for a in range(0, len(rows), step := max(1, _CELLS // len(qs))):
                    old = _best(asked @ part[a : a + step].T, cls[rows[a : a + step]], old, k)
                held[dim] = old
        for dim, (scores, ids) in held.items():
            qs = block.of[dim][0]
            yield _entries(np.repeat(qs, scores.shape[1]), ids.ravel(), r, scores.ravel())

    return run


def _reach(shared, r: int, lists: int):  # noqa: ANN001, ANN202
    """Phase 2 in a task: the entries of list r that reach an equal share of a query's cutoff; all of a query without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            cls = batch.column("cls").to_numpy()
            for dim, rows, part in _matrices(batch, f"p{r}"):
                if dim not in block.of:
                    continue
                qs, asked = block.of[dim]
                asked = asked[:, slice(*_cuts(dim, lists)[r : r + 2])]
                share = np.array([block.cutoff.get(int(q), -np.inf) for q in qs])
                for a in range(0, len(rows), step := max(1, _CELLS // len(qs))):
                    scores = asked @ part[a : a + step].T
                    i, j = np.nonzero(scores * lists >= share[:, None])
                    yield _entries(qs[i], cls[rows[a + j]], r, scores[i, j])

    return run


def _entries(q: np.ndarray, cls: np.ndarray, r: int, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q), pa.array(cls), pa.array(np.full(len(q), r, np.int32)), pa.array(part.astype(np.int64))], names=["q", "cls", "list", "part"])


_ENTRY = "q bigint, cls bigint, list int, part bigint"


def _resolve(shared, lists: int):  # noqa: ANN001, ANN202
    """Whole scores in a task: of each row and its queries, the parts that no list has sent are fetched and added to the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            asked, own = batch.column("asked"), batch.column("asked").flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
            q, which, part = (own.field(c).to_numpy(zero_copy_only=False) for c in ("q", "list", "part"))
            order = np.lexsort((q, row))
            new = np.concatenate([[True], (np.diff(row[order]) != 0) | (np.diff(q[order]) != 0)])
            pair = np.empty(len(q), np.int64)
            pair[order] = np.cumsum(new) - 1
            row, q, entry = row[order][new], q[order][new], (which, pair, part)
            sent = np.full((lists, len(q)), np.nan)
            sent[entry[0], entry[1]] = entry[2]
            total, fetched = np.zeros(len(q)), np.zeros(len(q), np.int32)
            at = np.array([block.at[int(x)][1] for x in q], np.int64)
            for r in range(lists):
                known = ~np.isnan(sent[r])
                total[known] += sent[r][known]
                for dim, rows, components in _matrices(batch, f"p{r}"):
                    place = np.full(batch.num_rows, -1)
                    place[rows] = np.arange(len(rows))
                    need = np.flatnonzero(~known & (place[row] >= 0))
                    vectors = block.of[dim][1][:, slice(*_cuts(dim, lists)[r : r + 2])]
                    for a in range(0, len(need), step := max(1, _CELLS // max(1, vectors.shape[1]))):
                        n = need[a : a + step]
                        total[n] += np.einsum("ij,ij->i", vectors[at[n]], components[place[row[n]]])
                    fetched[need] += 1
            yield pa.RecordBatch.from_arrays([pa.array(q), batch.column("cls").take(pa.array(row)), pa.array(total.astype(np.int64)), pa.array(fetched)], names=["q", "cls", "score", "fetched"])

    return run


def _directly(shared, k: int):  # noqa: ANN001, ANN202
    """In a task, whole scores of vectors beyond the range of exact floats, in Python's integers; those beyond a long become its nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = shared.value, {}
        for batch in batches:
            for cls, first, v in zip(*(batch.column(c).to_pylist() for c in ("cls", "first", "v"))):
                if len(v) not in block.of:
                    continue
                whole = [int(x) for x in v]
                for q, vector in zip(*block.of[len(v)]):
                    score = sum(a * int(b) for a, b in zip(whole, vector))
                    best.setdefault(int(q), []).append((-max(-_LONG, min(_LONG, score)), first, cls))
            best = {q: sorted(found)[:k] for q, found in best.items()}
        flat = [(q, c, -s) for q, found in best.items() for s, _, c in found]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], pa.int64()) for i in range(3)], names=["q", "cls", "score"])

    return run


def _quantised(x: Column) -> Column:
    """floor(1024 x) as a double; beyond 2**43 a double is whole as it is."""
    return F.when(F.abs(x) < 2.0**43, F.floor(x * 1024).cast("double")).otherwise(x * 1024)


def _top(scored: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Of (q, cls, score), each query's k classes with the highest score, ties to the smaller first key."""
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first", "cls"))
    return scored.join(members, "cls").withColumn("place", place).where(F.col("place") <= k).select("q", "score", "keys")


def _whole(entries: DataFrame, table: DataFrame, shared, lists: int) -> DataFrame:  # noqa: ANN001
    """(q, cls, score, fetched) of the entries that lists have sent: entries meet their row once, at most a block of queries each."""
    wanted = entries.groupBy("cls").agg(F.collect_list(F.struct("q", "list", "part")).alias("asked"))
    return wanted.join(table.drop("keys", "wide"), "cls").mapInArrow(_resolve(shared, lists), "q bigint, cls bigint, score bigint, fetched int")


def _answers(table: DataFrame, queries: list, wide: bool, k: int, lists: int, counts: list[dict] | None) -> DataFrame:
    """(q, score, keys) of the k best classes of each query of a block, all of which are wide or none."""
    sc, block = table.sparkSession.sparkContext, _Block(queries)
    members = table.select("cls", "keys", F.get("keys", F.lit(0)).alias("first"))
    apart = lambda rows, shared: rows.select("cls", F.get("keys", F.lit(0)).alias("first"), F.concat(*[f"p{r}" for r in range(lists)]).alias("v")).mapInArrow(_directly(shared, k), "q bigint, cls bigint, score bigint")
    if wide:
        return _top(apart(table, sc.broadcast(block)), members, k)
    rows = table.where("NOT wide")

    def sent(work) -> DataFrame:  # noqa: ANN001
        """What each list sends."""
        out = [rows.select("cls", "dim", f"p{r}").mapInArrow(work(r), _ENTRY) for r in range(lists)]
        return reduce(DataFrame.unionByName, out)

    shared = sc.broadcast(block)
    first = sent(lambda r: _gather(shared, r, lists, k))
    in_list = F.row_number().over(Window.partitionBy("q", "list").orderBy(F.desc("part"), "cls"))
    gathered = _whole(first.withColumn("place", in_list).where(F.col("place") <= k).drop("place"), rows, shared, lists)
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    limits = gathered.withColumn("place", place).where(F.col("place") == k).select("q", "score").collect()  # one a query of the block at most
    block.cutoff = {r["q"]: r["score"] for r in limits}
    with_cutoffs = sc.broadcast(block)
    entries = sent(lambda r: _reach(with_cutoffs, r, lists))
    scored = _whole(entries, rows, with_cutoffs, lists)
    if counts is not None:
        pairs = sum(n * len(block.of[d][0]) for d, n in rows.groupBy("dim").count().collect() if d in block.of)
        counts.append({"pairs": pairs, "first": gathered.count(), "last": scored.count(), "fetched": scored.agg(F.sum("fetched")).first()[0] or 0})
    return _top(scored.select("q", "cls", "score").unionByName(apart(table.where("wide"), shared)), members, k)


def _ranked(met: DataFrame, k: int, key: str) -> DataFrame:
    """(q, id, v, best) with best sorted, a row a query, to its first k but for one entry of the query's own key and score with itself."""
    own = F.least(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x), F.lit(2.0**63))
    same = lambda b: (b["id"] == F.col("id")) & (F.abs(b["less"] + F.col("self")) <= F.when(F.col("self") < 2.0**53, 0.0).otherwise(F.col("self") * 1e-12))
    at = F.array_min(F.transform("best", lambda b, i: F.when(same(b), i)))
    left = F.slice(F.filter("best", lambda b, i: F.col("at").isNull() | (i != F.col("at"))), 1, k)
    rows = met.withColumn("self", own).withColumn("at", at).select(F.col("id").alias("query_id"), F.posexplode(left).alias("place", "b"))
    return rows.select("query_id", (F.col("place") + 1).alias("rank"), F.col("b.id").alias(key), (-F.col("b.less")).alias("score"))


def top_k_inner(vectors: DataFrame, queries: DataFrame, k: int = 10, lists: int = 2, key: str = "vec_id", vector: str = "embedding", block_queries: int = BLOCK_QUERIES, counts: list[dict] | None = None) -> DataFrame:
    """The k rows with the highest integer inner product of every query: (query_id, rank, key, score).

    A component x counts as floor(1024 x). Equal vectors are one class with
    the k + 1 smallest keys of its rows, so neither a common row nor a common
    query multiplies work. Classes are stored as `lists` columns, each a range
    of components; distinct queries are taken in blocks of at most
    `block_queries` and BLOCK_BYTES, which alone are broadcast.

    Phase 1: each list sends its k + 1 entries with the highest part scores;
    their whole scores give each query a cutoff that no answer is below.
    Phase 2: the cutoffs t go out, and each list sends the entries that reach
    t / lists: parts of an answer sum to t or more, so one of them does.
    Phase 3: parts that weren't sent are fetched for those entries only, and
    the k best kept. Ties go to the smaller key. Entries grow with about the
    square root of the number of rows. counts, if given, gets for each block
    how many whole scores phases 1 and 3 resolved, and of how many pairs.

    A query's own row, one of its key and vector, takes no part; a query with
    fewer others gets all. Vectors that are null, empty or hold null or
    non-finite components (after scaling, too) take no part, on either side;
    vectors of different lengths are never compared. Repeated rows are
    separate rows; queries repeated get repeated answers. Rows with a null
    key take no part. A score beyond the range of a long counts as the
    nearest long; vectors too large for exact sums in doubles are scored
    apart, in whole numbers. Empty tables give no rows; other columns are
    ignored.
    """
    spark = vectors.sparkSession
    folder = scratch_folder(spark, "topk")
    rows, asked = _clean(vectors, key, vector), _clean(queries, key, vector)

    # The first k + 1 rows of each class; a task drops what lies beyond before the shuffle.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    classes = rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("keys"))
    cut = lambda i: F.floor(F.size("v") * i / lists).cast("int")
    parts = [F.slice("v", cut(r) + 1, cut(r + 1) - cut(r)).alias(f"p{r}") for r in range(lists)]
    wide = F.array_max(F.transform("v", F.abs)) >= F.sqrt(F.lit(2.0**53) / F.size("v"))
    classes.select(F.monotonically_increasing_id().alias("cls"), F.size("v").alias("dim"), "keys", wide.alias("wide"), *parts).write.parquet(f"{folder}/classes")
    table = spark.read.parquet(f"{folder}/classes")

    asked.select("v").distinct().write.parquet(f"{folder}/distinct")
    distinct = spark.read.schema("v array<double>").parquet(f"{folder}/distinct")
    most = distinct.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("dim")).first()
    n_blocks = -(-most["n"] // max(1, min(block_queries, BLOCK_BYTES // (8 * most["dim"]))))
    # Dealt round robin, so that blocks are of one size, and written, so that the numbers stay.
    distinct.repartition(max(1, n_blocks)).select("v", wide.alias("wide"), F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("q")).write.parquet(f"{folder}/queries")
    known = spark.read.parquet(f"{folder}/queries")

    for b in range(n_blocks):
        own = known.where(F.col("block") == b).collect()
        for is_wide in (False, True):
            if some := [r for r in own if r["wide"] == is_wide]:
                _answers(table, some, is_wide, k + 1, lists, counts).write.mode("append").parquet(f"{folder}/answers")
    if not n_blocks:
        drop_folder(spark, folder)
        return spark.createDataFrame([], f"query_id bigint, rank int, `{key}` bigint, score bigint")

    answers = spark.read.parquet(f"{folder}/answers")
    flat = F.flatten(F.transform("found", lambda f: F.transform(f["keys"], lambda i: F.struct((-f["score"]).alias("less"), i.alias("id")))))
    best = answers.groupBy("q").agg(F.collect_list(F.struct("score", "keys")).alias("found")).select("q", F.array_sort(flat).alias("best"))
    out = _ranked(asked.join(known.select("q", "v").join(best, "q"), "v"), k, key).checkpoint()
    drop_folder(spark, folder)
    return out


def _clean(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    known = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")).where(F.col("id").isNotNull() & finite_vector(F.col("x")) & (F.size("x") > 0))
    return known.select("id", F.transform("x", _quantised).alias("v")).where(finite_vector(F.col("v")))
