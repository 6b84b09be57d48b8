"""Ranked lexical search: items times terms times documents, a blocked sparse product with the best of each row kept."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_folder, give_back, scratch_folder, term_runs, text_bytes

#: Bytes of items that are one block: their terms and rows are broadcast.
BLOCK_BYTES = 4 << 20
#: Documents of a block of the product, and entries at which a block is taken with fewer.
BLOCK_DOCS, BLOCK_ENTRIES = 16_384, 4_000_000
_COUNTS = "struct<n: bigint, terms: array<int>, tfs: array<int>>"


class Items:
    """A block of items: their keys, and how often each of the block's terms occurs in each, row by row."""

    def __init__(self, rows: list[tuple[object, Counter]]):
        self.keys = [key for key, _ in rows]
        self.number = {term: i for i, term in enumerate(dict.fromkeys(t for _, counts in rows for t in counts))}
        self.terms = [np.array([self.number[t] for t in counts], np.int64) for _, counts in rows]
        self.times = [np.array(list(counts.values()), np.int64) for _, counts in rows]


def _blocks(items: DataFrame, key: str, text: str, most: int) -> Iterator[list[tuple[object, Counter]]]:
    """Items as (key, terms with their number) in lists of about `most` bytes of distinct terms; a row is an item."""
    block, held = [], 0
    for row in items.select(key, text).toLocalIterator():
        counts: Counter = Counter()
        for run in term_runs((row[1] or "").encode("utf-8", "surrogatepass")):
            counts.update(run)
        if counts:
            block.append((row[0], counts))
            held += sum(map(len, counts)) + 16 * len(counts)
        if held >= most:
            yield block
            block, held = [], 0
    if block:
        yield block


def _counted(docs: DataFrame, key: str, text: str, shared) -> DataFrame:  # noqa: ANN001
    """(doc, n, terms, tfs) of the documents that have terms: how many, and which of the block's terms how often."""

    @F.arrow_udf(_COUNTS)
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        number = shared.value.number
        width, get = max(1, len(number)), number.get
        for texts in parts:
            sizes, cells = np.zeros(len(texts), np.int64), []
            for i, data in enumerate(text_bytes(texts)):
                for run in term_runs(data):
                    sizes[i] += len(run)
                    ids = np.fromiter(map(get, run, repeat(-1)), np.int64, len(run))
                    cells.append(ids[ids >= 0] + i * width)
            cell, tf = np.unique(np.concatenate([*cells, np.empty(0, np.int64)]), return_counts=True)
            ends = pa.array(np.searchsorted(cell, np.arange(len(texts) + 1) * width).astype(np.int32))
            listed = lambda values: pa.ListArray.from_arrays(ends, pa.array(values.astype(np.int32)))
            yield pa.StructArray.from_arrays([pa.array(sizes), listed(cell % width), listed(tf)], names=["n", "terms", "tfs"])
        give_back()

    counts = docs.select(F.col(key).cast("long").alias("doc"), count.asNondeterministic()(F.col(text)).alias("c"))
    return counts.select("doc", "c.*").where("n > 0")


class _Best:
    """The k best documents of an item so far: highest score, then smallest key."""

    def __init__(self, k: int):
        self.k, self.scores, self.docs = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        if len(self.scores) == self.k:
            some = scores >= self.scores[-1]
            scores, docs = scores[some], docs[some]
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs])
        if len(scores) > self.k:
            cut = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            above, ties = np.flatnonzero(scores > cut), np.flatnonzero(scores == cut)
            left = self.k - len(above)
            ties = ties[np.argpartition(docs[ties], left - 1)[:left]]
            kept = np.concatenate([above, ties])
            scores, docs = scores[kept], docs[kept]
        order = np.lexsort((docs, -scores))
        self.scores, self.docs = scores[order], docs[order]


def _spread(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m of documents with n terms; in whole numbers of any size where longs are too short."""
    if len(n) and 75 * int(n.max()) * docs >= 2**63:
        return np.array([25 + 75 * int(x) * docs // terms for x in n], np.int64)
    return 25 + 75 * n * docs // terms


def _product(shared, weights: np.ndarray, docs: int, terms: int, k: int):  # noqa: ANN001, ANN202
    """In a task, the k best documents of each item: block by block, rows of items times the block's impacts, by term."""

    def block(items: Items, best: list[_Best], keys: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * _spread(n, docs, terms)[doc]))
        order = np.argsort(term, kind="stable")
        doc, impact, at = doc[order], impact[order], np.searchsorted(term[order], np.arange(len(items.number) + 1))
        row = np.empty(len(keys), np.int64)
        for own, times, top in zip(items.terms, items.times, best):
            row[:] = 0
            for t, m in zip(own, times):
                a, z = at[t], at[t + 1]
                row[doc[a:z]] += m * impact[a:z]  # a document stands once in a term's row
            found = np.flatnonzero(row > 0)
            top.add(row[found], keys[found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best = [_Best(k) for _ in items.keys]
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            if held:
                rows = pa.Table.from_batches(held).combine_chunks()
                held.clear()
                lists = rows.column("terms").chunk(0)
                doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                flat = [rows.column(c).chunk(0).flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs")]
                block(items, best, rows.column("doc").to_numpy(), rows.column("n").to_numpy(), doc, *flat)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_DOCS or sum(len(b.column("terms").flatten()) for b in held) >= BLOCK_ENTRIES:
                flush()
        flush()
        sizes = [len(b.scores) for b in best]
        each = lambda parts: np.concatenate([*parts, np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(each(b.docs for b in best)), pa.array(each(b.scores for b in best))], names=["item", "doc", "score"])
        give_back()

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of every item: (item_key, rank, key, score), scores above 0 only.

    Terms are runs of digits, letters and what isn't ASCII, A-Z in lower
    case. With N documents that have terms, L terms in all, n in a document,
    df documents with a term, tf times in one, w = floor(1000 ln((2 N + 2) /
    (2 df + 1))) and m = 25 + 75 n N div L, a document's score is the sum of
    w * (10^9 tf div (1000 tf + 8 m)) over the item's terms, repeats included.

    Items are taken in blocks of about `block_bytes`, whose terms are
    broadcast; the texts are read once a block and give the matrix of the
    block's terms by documents, written as a table. N, L and df are
    aggregates of it. A task multiplies it in blocks of documents, row by row
    of the items, and keeps k entries an item, which alone are shuffled.

    Equal scores go by the smaller document key. Null and empty texts have no
    terms and count nowhere; null and empty items have no answers. Documents
    with a null key count in N, L and df but aren't ranked. Repeated
    documents are ranked each; each row of items is an item of its own, null
    and repeated keys included. Texts of any length are read whole, in runs
    of about a megabyte. Empty tables give no rows; other columns are ignored.
    """
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession, "ranking")
    schema = f"item bigint, doc bigint, score bigint, block int, `key` {items.schema[item_key].dataType.simpleString()}"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/answers")
    for b, rows in enumerate(_blocks(items, item_key, item_text, block_bytes)):
        block = Items(rows)
        shared = spark.sparkContext.broadcast(block)
        _counted(docs, key, text, shared).write.parquet(f"{folder}/{b}")
        matrix = spark.read.parquet(f"{folder}/{b}")
        total = matrix.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if total["docs"]:
            held = matrix.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one a term of the block at most
            weights = np.zeros(len(block.number), np.int64)
            for term, df in held:
                weights[term] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * df + 1)))
            found = matrix.where("doc IS NOT NULL").mapInArrow(_product(shared, weights, total["docs"], total["terms"], k), "item bigint, doc bigint, score bigint")
            place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc"))
            best = found.withColumn("place", place).where(F.col("place") <= k).drop("place")
            names = spark.createDataFrame(list(enumerate(block.keys)), f"item bigint, `key` {items.schema[item_key].dataType.simpleString()}")
            best.join(names, "item").select("item", "doc", "score", F.lit(b).alias("block"), "key").write.mode("append").parquet(f"{folder}/answers")
        drop_folder(spark, f"{folder}/{b}")
    rank = F.row_number().over(Window.partitionBy("block", "item").orderBy(F.desc("score"), "doc"))
    out = spark.read.schema(schema).parquet(f"{folder}/answers").select(F.col("key").alias(item_key), rank.alias("rank"), F.col("doc").alias(key), "score").checkpoint()
    drop_folder(spark, folder)
    return out
