"""Benchmark decontamination: one automaton over the word windows of test items, texts scanned once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TERM_BYTES, drop_folder, give_back, scratch_folder, term_runs, text_bytes

#: Bytes of items whose windows make one automaton: up to about 180 MB in a worker.
BLOCK_BYTES = 512 << 10
_RANGE = "array<struct<start: bigint, end: bigint>>"
LEAKS = f"struct<n_words: bigint, n_hit: bigint, items: array<string>, words: {_RANGE}, spans: {_RANGE}>"
_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Windows:
    """The windows of a block of items: each with its number of words and the items that have it."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], size: int):
        self.size, self.ids, self.made = size, [i for i, _ in items], None
        self.of: dict[bytes, list[int]] = defaultdict(list)
        for n, (_, words) in enumerate(items):
            for window in {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else ():
                self.of[window].append(n)

    def automaton(self) -> ahocorasick.Automaton | None:
        """Finds windows between spaces; bytes are letters, so that places are bytes."""
        if self.made is None and self.of:
            self.made = ahocorasick.Automaton()
            for window in self.of:
                self.made.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, window))
            self.made.make_automaton()
        return self.made


def _hits(text: bytes, automaton: ahocorasick.Automaton | None, size: int) -> tuple[int, list[tuple[int, int]], set[bytes]]:
    """Words of a text, the ranges of words inside windows, in order and apart, and the windows that occur."""
    done, kept, found, windows = 0, [], [], set()
    for run in term_runs(text):
        words = kept + run
        if automaton is not None:
            line = b" %b " % b" ".join(words)
            spaces = None
            for end, (n, window) in automaton.iter(line.decode("latin-1")):
                if spaces is None:
                    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                last = done - len(kept) + int(np.searchsorted(spaces, end))
                found.append((last - n, last))
                windows.add(window)
        done += len(run)
        kept = words[-(size - 1) :] if size > 1 else []
    return done, merged(found), windows


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges as ranges in order that don't touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _places(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as places in the original text, in code points, from the first word's start to the last one's end."""
    if not ranges:
        return []
    space = np.frombuffer(text.translate(TERM_BYTES), np.uint8) == 32
    starts, ends = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])), np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[z - 1]])) for a, z in ranges]


def _blocks(items: DataFrame, key: str, text: str, size: int, most: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items as (id, words) in lists of about `most` bytes, one at least; a longer item comes in parts that share size - 1 words."""
    block, held = [], 0
    for row in items.select(F.col(key).cast("string"), F.col(text)).toLocalIterator():
        kept: list[bytes] = []
        for run in term_runs((row[1] or "").encode("utf-8", "surrogatepass"), most):
            words = kept + run
            block.append((row[0], words))
            held += sum(map(len, words))
            kept = words[-(size - 1) :] if size > 1 else []
            if held >= most:
                yield block
                block, held = [], 0
    yield block


def _scanned(docs: DataFrame, text: str, to: str, windows: Windows) -> DataFrame:
    """docs with what a block of items adds to `to`."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    @F.arrow_udf(LEAKS)
    def scan(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        block = shared.value
        automaton = block.automaton()
        for texts, before in parts:
            rows = []
            for data, old in zip(text_bytes(texts), before):
                n, ranges, found = _hits(data, automaton, block.size)
                ids = {block.ids[i] for w in found for i in block.of[w]} - {None}
                if old.is_valid and (had := old.as_py()):
                    ids |= set(had["items"])
                    ranges = merged(ranges + [(r["start"], r["end"]) for r in had["words"]])
                rows.append((n, sum(z - a for a, z in ranges), sorted(ids), ranges, _places(data, ranges)))
            pairs = lambda i: pa.array([[{"start": a, "end": z} for a, z in r[i]] for r in rows], _PAIRS)
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.string())), pairs(3), pairs(4)]
            yield pa.StructArray.from_arrays(columns, names=["n_words", "n_hit", "items", "words", "spans"])
        give_back()

    before = F.col(to) if to in docs.columns else F.lit(None).cast(LEAKS)
    return docs.withColumn(to, scan(F.col(text), before))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "item_id", item_text: str = "text", text: str = "text", to: str = "leaks", size: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with `to`, a struct (n_words, n_hit, items, words, spans): what of a text stands in test items.

    Words are runs of digits, letters and what isn't ASCII, A-Z in lower
    case. A window is `size` words of an item in a row, or all words of a
    shorter one. A word inside any occurrence of a window is hit. items: the
    keys, as strings and sorted, of items with a window that occurs; words
    and spans: the hit runs, as places among the words and in the original
    text (code points), ends exclusive.

    All windows of a block of items are one Aho-Corasick automaton, and each
    text is read once for a block. Items of up to `block_bytes` are one
    block; more are taken in blocks, each of which writes the texts with what
    was found so far to a table. A window that many items share is stored
    once, and so is one that occurs in many texts.

    Null and empty texts have no words and no hits; null and empty items have
    no windows. An item with a null key hits words but isn't listed; items
    that share a key are listed once. Texts of any length are read whole, in
    runs of about a megabyte. Repeated rows are searched each; empty tables
    give no rows, or no hits. All columns of docs stay; `to` must be none of
    them (common.free_name() gives such a name).
    """
    if to in docs.columns:
        raise ValueError(f"docs has a column {to}")
    spark, out, folder = docs.sparkSession, docs, ""
    for n, block in enumerate(_blocks(items, key, item_text, size, block_bytes)):
        if n:  # the block before was not the last
            out, folder = _written(spark, out, folder)
        out = _scanned(out, text, to, Windows(block, size))
    return out


def _written(spark: SparkSession, rows: DataFrame, before: str) -> tuple[DataFrame, str]:
    """rows as a table in a new folder; the one that they were read from goes."""
    folder = scratch_folder(spark, "leaks")
    rows.write.parquet(folder)
    if before:
        drop_folder(spark, before)
    return spark.read.parquet(folder), folder
