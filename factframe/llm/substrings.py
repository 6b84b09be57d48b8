"""Exact substring deduplication over word windows, by anchors of fixed blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, mix, slices, tasks, words_of

#: Bytes of text that a task handles at a time, on average. Larger ones on
#: larger executors make fewer and longer messages between tasks.
GROUP_BYTES = 3 << 20
_CHUNK_BYTES = 1 << 18
#: Bytes of text whose hashes a bucket holds, on average.
BUCKET_BYTES = 8 << 20
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values[i] * base**i, from which hashes of ranges follow; the powers that shift a range to 0."""
    up, down = _powers(base, 1 << (len(values) + 1).bit_length())
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)]), down


def _windows(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every `size` words in a row."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    sums, down = _sums(words, base)
    return mix((sums[size:] - sums[:-size]) * down[: len(words) - size + 1])


class _Text(NamedTuple):
    """Texts end to end, and their words: byte starts and ends, hashes, text and place in it."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    check: np.ndarray  # the other half of the hash
    text: np.ndarray
    place: np.ndarray
    count: np.ndarray  # words of each text


def _read(texts: list[bytes]) -> _Text:
    data = b"\n".join(texts) + b"\n"
    start, end, low, high = words_of(data)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    text = (np.searchsorted(edges, start, side="right") - 1).astype(np.int32)
    count = np.bincount(text, minlength=len(texts))
    place = (np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
    return _Text(data, start, end, low, high, text, place, count)


class _Group:
    """The texts of a group of documents and the hashes of their windows, in an order that each pass finds again."""

    def __init__(self, table: pa.Table, window: int, block: int):
        keys = table.column("__key").to_pylist()
        texts = table.column("__text").to_pylist()
        self.order = sorted(range(len(keys)), key=lambda i: (keys[i], texts[i] or ""))
        self.window, self.block = window, block
        self.keys = np.array([keys[i] for i in self.order], np.int64)
        self.parts: list[_Text] = []
        held, size = [], 0
        for i in self.order:
            held.append((texts[i] or "").encode("utf-8", "surrogatepass"))
            size += len(held[-1])
            if size >= _CHUNK_BYTES:
                self.parts.append(_read(held))
                held, size = [], 0
        if held:
            self.parts.append(_read(held))
        firsts = np.cumsum([0] + [len(p.count) for p in self.parts])
        self.doc = np.concatenate([p.text + np.int32(f) for p, f in zip(self.parts, firsts)])
        self.place = np.concatenate([p.place for p in self.parts])
        self.count = np.concatenate([p.count for p in self.parts])

    def _hashes(self, size: int, base: int, of: str = "hash") -> np.ndarray:
        """Of the window that starts at each word; 0 where none fits."""
        pad = lambda h, n: np.concatenate([h, np.zeros(n - len(h), np.uint64)])
        return np.concatenate([pad(_windows(getattr(p, of), size, base), len(p.start)) for p in self.parts])

    def _fits(self, size: int) -> np.ndarray:
        """Whether a window of that size starts at each word, in a document that has a whole `window`."""
        n = self.count[self.doc]
        return (self.place + size <= n) & (n >= self.window)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of all rolling blocks, sorted; which have an aligned one; which lie in two documents; where each is; whose."""
        at = np.flatnonzero(self._fits(self.block))
        hashes = self._hashes(self.block, _ODD[2])[at] >> np.uint64(16)
        order = np.argsort(hashes, kind="stable")
        hashes, at = hashes[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        aligned = np.logical_or.reduceat(self.place[at] % self.block == 0, first) if len(first) else np.zeros(0, bool)
        last = np.concatenate([first[1:], [len(hashes)]]) - 1 if len(first) else first
        return hashes[first], aligned, self.doc[at[first]] != self.doc[at[last]], at, np.repeat(np.arange(len(first)), last - first + 1)

    def candidates(self, hit: np.ndarray, at: np.ndarray, whose: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows that hold a block that was hit: where they start; their distinct (hash, check, smallest key) sorted; whose."""
        anchor = np.zeros(len(self.doc) + 1, np.int64)
        anchor[at[hit[whose]]] = 1
        total = np.concatenate([[0], np.cumsum(anchor)])
        start = np.flatnonzero(self._fits(self.window))
        start = start[total[start + self.window - self.block + 1] > total[start]]
        one = self._hashes(self.window, _ODD[2])[start]
        two = (self._hashes(self.window, _ODD[0], "check")[start] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((two, one))  # within equal ones the document order, that is by key, stays
        start, one, two = start[order], one[order], two[order]
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]) if len(one) else np.zeros(0, bool)
        return start, one[new], two[new], self.keys[self.doc[start[new]]] if len(one) else np.zeros(0, np.int64), np.cumsum(new) - 1


def _planes(values: np.ndarray, size: int) -> bytes:
    """The lowest `size` bytes of each number, highest first, byte by byte: sorted numbers then compress well."""
    rows = values.astype(values.dtype.newbyteorder(">")).view(np.uint8).reshape(len(values), -1)
    return np.ascontiguousarray(rows[:, rows.shape[1] - size :].T).tobytes()


def _from_planes(raw: bytes, size: int) -> np.ndarray:
    rows = np.frombuffer(raw, np.uint8).reshape(size, -1)
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, 8 - size :] = rows.T
    return out.reshape(-1).view(">u8").astype(np.uint64)


def _dealt(hashes: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, slice]]:
    """Runs of sorted hashes of `bits` bits by bucket."""
    which = ((hashes >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(which)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(which)]):
        if b > a:
            yield int(which[a]), slice(int(a), int(b))


def _bits(rows: pa.Table, kind: str, n: int) -> np.ndarray:
    """Flags of the sorted hashes of a group, from the answers of all buckets."""
    own = sorted((b, bits, size) for k, b, bits, size in zip(*(rows.column(c).to_pylist() for c in ("kind", "bucket", "bits", "n"))) if k == kind)
    out = np.concatenate([np.unpackbits(np.frombuffer(bits, np.uint8), count=size) for _, bits, size in own] or [np.zeros(0, np.uint8)])
    if len(out) != n:
        raise ValueError("a group changed between two passes")
    return out.astype(bool)


_ANSWER = "kind string, __group bigint, bucket bigint, n bigint, bits binary"


def _answers(kind: str, bucket: int, groups: list[int], sizes: list[int], flags: np.ndarray) -> pa.Table:
    parts = np.split(flags, np.cumsum(sizes)[:-1])
    return pa.table(
        {"kind": [kind] * len(groups), "__group": pa.array(groups, pa.int64()), "bucket": pa.array([bucket] * len(groups), pa.int64()), "n": pa.array(sizes, pa.int64()), "bits": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())}
    )


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13, keep: tuple[str, ...] = (), to: str = "repeats", group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row a document: (key, *keep, to), `to` being a struct (n_words, n_removed, kept) without words of windows seen in a smaller key.

    A window is `window` words in a row, split at space and \\t-\\r. Words that
    a window covers go if its words also start in a document of a smaller
    key; all windows are judged on the input. kept: the other words, joined
    by one space.

    Any window holds a whole block of (window + 1) / 2 words that starts at a
    multiple of that in the other document. So the aligned blocks of all
    documents are the index, every rolling block is a probe, and a block is
    an anchor if it is aligned in one document and in another at all. Only
    windows round an anchor go on, on both sides; equal ones are brought
    together by 96-bit hashes, made of 128-bit ones of the words, with the
    smallest key of each, so that hits extend to whole repeats and however
    many copies a passage has, it costs one entry a group. Documents are
    dealt to groups by a hash of key and text, so rows of a common key spread;
    groups send sorted distinct hashes to buckets of the hash range and get
    back one bit for each. Texts are shuffled once and used three times. Two
    window sequences that differ count as equal with a chance of 2**-96 a pair.

    Null and empty texts have no words. Rows with a null key keep all words
    and hold nothing against others; they aren't shuffled. Rows of one key
    don't count against each other; repeated rows get equal results. No rows,
    no result. Columns that aren't in `keep` are left out; `keep` may hold any
    names but those of key and `to`.
    """
    block = (window + 1) // 2
    rows = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(keep) if c != text])
    size = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    n, n_buckets = (max(tasks(docs.sparkSession), -(-size // most)) for most in (group_bytes, bucket_bytes))
    dealt = rows.where("__key IS NOT NULL").withColumn("__group", F.pmod(F.xxhash64("__key", "__text"), F.lit(n)))

    def send_blocks(table: pa.Table) -> pa.Table:
        hashes, aligned, twice, _, _ = _Group(table, window, block).blocks()
        own = list(_dealt(hashes, 48, n_buckets))
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in own], pa.int64()),
                "__group": pa.array([table.column("__group")[0].as_py()] * len(own), pa.int64()),
                "n": pa.array([s.stop - s.start for _, s in own], pa.int64()),
                "hashes": pa.array([_planes(hashes[s], 6) for _, s in own], pa.binary()),
                "aligned": pa.array([np.packbits(aligned[s]).tobytes() for _, s in own], pa.binary()),
                "twice": pa.array([np.packbits(twice[s]).tobytes() for _, s in own], pa.binary()),
            }
        )

    def match_blocks(key: tuple, table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        hashes = np.concatenate([_from_planes(x, 6) for x in table.column("hashes").to_pylist()])
        aligned, twice = (np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=m) for x, m in zip(table.column(c).to_pylist(), sizes)]) for c in ("aligned", "twice"))
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
        many = np.diff(np.concatenate([first, [len(hashes)]]))
        hit = (np.maximum.reduceat(aligned[order], first) > 0) & ((many > 1) | (np.maximum.reduceat(twice[order], first) > 0))
        flags = np.empty(len(hashes), np.uint8)
        flags[order] = np.repeat(hit, many)
        return _answers("block", key[0].as_py(), table.column("__group").to_pylist(), sizes, flags)

    def send_windows(key: tuple, table: pa.Table, back: pa.Table) -> pa.Table:
        group = _Group(table, window, block) if table.num_rows else None
        if group is None:
            return _empty("bucket bigint, __group bigint, n bigint, hashes binary, checks binary, keys binary")
        hashes, _, _, at, whose = group.blocks()
        _, one, two, least, _ = group.candidates(_bits(back, "block", len(hashes)), at, whose)
        own = list(_dealt(one, 64, n_buckets))
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in own], pa.int64()),
                "__group": pa.array([table.column("__group")[0].as_py()] * len(own), pa.int64()),
                "n": pa.array([s.stop - s.start for _, s in own], pa.int64()),
                "hashes": pa.array([_planes(one[s], 8) for _, s in own], pa.binary()),
                "checks": pa.array([two[s].tobytes() for _, s in own], pa.binary()),
                "keys": pa.array([_planes(least[s], 8) for _, s in own], pa.binary()),
            }
        )

    def match_windows(key: tuple, table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        join = lambda c, f: np.concatenate([f(x) for x in table.column(c).to_pylist()])
        one, two = join("hashes", lambda x: _from_planes(x, 8)), join("checks", lambda x: np.frombuffer(x, np.uint32))
        least = join("keys", lambda x: _from_planes(x, 8)).view(np.int64)
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        smallest = np.repeat(np.minimum.reduceat(least[order], first), np.diff(np.concatenate([first, [len(a)]])))
        flags = np.empty(len(a), np.uint8)
        flags[order] = smallest < least[order]
        return _answers("window", key[0].as_py(), table.column("__group").to_pylist(), sizes, flags)

    names = [key, *keep, to]

    def cut(_: tuple, table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _empty(result)
        group = _Group(table, window, block)
        hashes, _, _, at, whose = group.blocks()
        start, one, _, least, entry = group.candidates(_bits(back, "block", len(hashes)), at, whose)
        earlier = _bits(back, "window", len(one))
        gone = start[earlier[entry] | (group.keys[group.doc[start]] > least[entry])] if len(start) else start
        change = np.zeros(len(group.doc) + window + 1, np.int64)
        np.add.at(change, gone, 1)
        np.add.at(change, gone + window, -1)
        covered = np.cumsum(change)[: len(group.doc)] > 0
        count = group.count
        removed = np.bincount(group.doc[covered], minlength=len(count))
        kept, done = [], 0
        for part in group.parts:
            n_words = len(part.start)
            kept += _kept(part, ~covered[done : done + n_words])
            done += n_words
        own = table.take(pa.array(group.order))
        del group, hashes, at, whose, start, one, least, entry, earlier, gone, change, covered
        give_back()
        return result_table(own, count, removed, kept)

    def result_table(own: pa.Table | pa.RecordBatch, count: np.ndarray, removed: np.ndarray, kept: list[str]) -> pa.Table:
        found = pa.StructArray.from_arrays([pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["n_words", "n_removed", "kept"])
        columns = [own.column(c) for c in ("__key", *("__text" if c == text else f"__{i}" for i, c in enumerate(keep)))]
        return pa.table([*columns, found], names=[f"c{i}" for i in range(len(names))])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            words = [(x or "").encode("utf-8", "surrogatepass").split() for x in part.column(1).to_pylist()]
            kept = [b" ".join(w).decode("utf-8", "surrogatepass") for w in words]
            yield from result_table(part, np.array([len(w) for w in words]), np.zeros(len(words), np.int64), kept).to_batches()

    kinds = ["bigint", *(docs.schema[c].dataType.simpleString() for c in keep), "struct<n_words: bigint, n_removed: bigint, kept: string>"]
    result = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    bare = rows.where("__key IS NULL").mapInArrow(untouched, result)
    groups = dealt.groupBy("__group")
    blocks = groups.applyInArrow(send_blocks, "bucket bigint, __group bigint, n bigint, hashes binary, aligned binary, twice binary")
    anchors = blocks.groupBy("bucket").applyInArrow(match_blocks, _ANSWER)
    windows = groups.cogroup(anchors.groupBy("__group")).applyInArrow(send_windows, "bucket bigint, __group bigint, n bigint, hashes binary, checks binary, keys binary")
    earlier = windows.groupBy("bucket").applyInArrow(match_windows, _ANSWER)
    return groups.cogroup(anchors.unionByName(earlier).groupBy("__group")).applyInArrow(cut, result).union(bare).toDF(*names)


def _empty(schema: str) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema)).empty_table()


def _kept(part: _Text, stays: np.ndarray) -> list[str]:
    """The words of each text that stay, one space between."""
    sizes = part.end - part.start + 1
    mark = np.zeros(len(part.data) + 1, np.int8)
    mark[part.start[stays]] = 1
    mark[part.end[stays] + 1] -= 1
    inside = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    data = np.frombuffer(part.data, np.uint8).copy()
    data[part.end] = 32
    data = data[inside].tobytes()
    lengths = np.bincount(part.text[stays], weights=sizes[stays], minlength=len(part.count)).astype(np.int64)
    ends = np.cumsum(lengths)
    return [data[b - n : b - 1].decode("utf-8", "surrogatepass") if n else "" for b, n in zip(ends.tolist(), lengths.tolist())]
