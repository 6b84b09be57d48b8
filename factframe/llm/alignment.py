"""Alignment of two tokenizers over the same texts: arrays over Arrow batches of texts, pairs counted and judged by joins."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_folder, give_back, scratch_folder, slices

#: The runs that a worker keeps from batch to batch: so many of the most frequent ones, of so many bytes at most each.
HEAD_RUNS, HEAD_BYTES = 1 << 16, 48
#: Pairs that are broadcast: those with at least this part of all entries (pair, document), so not more than so many.
HEAD_PAIRS = 1 << 17
#: Bytes of texts that are aligned, and characters of runs that are encoded, at once.
_BATCH, _CHUNK = 2 << 20, 1 << 16
#: The session's bound on Arrow batches, by which rows go to a worker.
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A place where both tokenizers begin anew, whatever stands on either side: before spaces that follow a visible ASCII or Latin character and lead to something else.
_CUT = r"(?<=[!-~À-ɏ])(?= +[^ ])"
#: The last character of a run that another may follow.
_VISIBLE = re.compile(r"[!-~À-ɏ]")
_LARGE = {x: pa.scalar(x, pa.large_string()) for x in ("", " ", ",", ";", "|")}
_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many as its count, one range after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _ends(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])


def _strings(strings: pa.Array, ends: np.ndarray, by: str) -> pa.Array:
    """Consecutive strings joined, up to each end."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), strings), _LARGE[by])


class Pair:
    """Two tokenizers: byte-level BPE from a tokenizers file (A), and a SentencePiece model with byte pieces (B)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
        tokens = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(map(byte.__getitem__, t)) if all(c in byte for c in t) else t.encode() for t in tokens]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array(list(map(len, known)), np.int64) for known in (self.bytes_a, self.bytes_b)]
        self.shown = [pa.array(list(map(str, range(len(known)))), pa.large_string()) for known in (self.bytes_a, self.bytes_b)]
        #: Whether no piece goes on with a space after anything else, so that texts fall apart before spaces.
        self.apart = not any(re.search(r"[^▁]▁", p) for p in pieces)
        self.known: Runs | None = None

    def encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(ids, ends of each text among them) of both, for texts that begin with a space, which B adds by itself.

        A text whose tokens' joined bytes differ from its own gets none of
        either. Runs that others may follow are encoded as one text of up to
        about _CHUNK characters, as their tokens are the same; the rest one by one.
        """
        order, found = [], ([], [])

        def add(at: list[int]) -> None:
            for own, x in zip(found, self._encoded([texts[i] for i in at])):
                own += x
            order.extend(at)

        joined, held = [], 0
        for i, text in enumerate(texts):
            if self.apart and _VISIBLE.match(text[-1:]):
                joined.append(i)
                held += len(text)
                if held > _CHUNK:
                    add(joined)
                    joined, held = [], 0
            else:
                add([i])
        add(joined)
        back = np.argsort(np.array(order, np.int64))
        out = []
        for own in found:
            ids, counts = (np.concatenate([*(x[k] for x in own), np.empty(0, np.int64)]).astype(np.int64) for k in (0, 1))
            out.append((ids[_ranges(_ends(counts)[:-1][back], counts[back])], _ends(counts[back])))
        return tuple(out)

    def _encoded(self, texts: list[str]) -> tuple[list, list]:
        """(ids, their number for each text) of consecutive texts by both tokenizers, as lists of parts; halved as long as tokens don't fit."""
        if not texts:
            return [], []
        whole, out = "".join(texts), []
        data, ends = whole.encode(), np.cumsum([len(t.encode()) for t in texts])
        for ids, known, sizes in ((self.a.encode(whole, add_special_tokens=False).ids, self.bytes_a, self.sizes[0]), (self.b.encode(whole[1:]), self.bytes_b, self.sizes[1])):
            if b"".join(map(known.__getitem__, ids)) == data:
                ids = np.array(ids, np.int64)
                places = np.cumsum(sizes[ids])
                cut = np.searchsorted(places, ends)
                if (places[cut] == ends).all():
                    out.append([(ids, np.diff(cut, prepend=-1))])
        if len(out) == 2:
            return tuple(out)
        if len(texts) == 1:
            return [(np.empty(0, np.int64), np.zeros(1, np.int64))], [(np.empty(0, np.int64), np.zeros(1, np.int64))]
        half = len(texts) // 2
        return tuple(x + y for x, y in zip(self._encoded(texts[:half]), self._encoded(texts[half:])))


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@cache
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


@dataclass
class Runs:
    """Runs with their groups, and their links as pairs of ids with the number of each: those of a run up to its end."""

    run: pa.Array
    times: np.ndarray
    numbers: np.ndarray
    groups: pa.Array
    ends: np.ndarray
    pairs: np.ndarray
    n: np.ndarray

    def take(self, at: np.ndarray) -> Runs:
        counts = np.diff(self.ends)[at]
        links = _ranges(self.ends[at], counts)
        return Runs(self.run.take(pa.array(at)), self.times[at], self.numbers[:, at], self.groups.take(pa.array(at)), _ends(counts), self.pairs[links], self.n[links])

    def __add__(self, more: Runs) -> Runs:
        both = lambda k: np.concatenate([getattr(self, k), getattr(more, k)])
        numbers = np.concatenate([self.numbers, more.numbers], axis=1)
        return Runs(pa.concat_arrays([self.run, more.run]), both("times"), numbers, pa.concat_arrays([self.groups, more.groups]), np.concatenate([self.ends, more.ends[1:] + self.ends[-1]]), both("pairs"), both("n"))


def aligned(both: Pair, runs: pa.Array) -> Runs:
    """Groups and links of runs.

    Ends of tokens are running sums of their bytes; where both tokenizers
    have one is a cut, and the number of cuts before a token is its group. A
    run ends with a cut, so groups are numbered through all runs. A group's
    tokens, counted by id, are crossed to its links.
    """
    encoded = both.encode(runs.cast(pa.large_string()).to_pylist())
    places = [np.cumsum(sizes[ids]) for (ids, _), sizes in zip(encoded, both.sizes)]
    cuts = np.intersect1d(*places, assume_unique=True)
    groups = [np.searchsorted(cuts, own) for own in places]
    each = [np.bincount(own, minlength=len(cuts)) for own in groups]
    ends = [_ends(own) for own in each]
    shown = [_strings(strings.take(pa.array(ids)), own, ",") for strings, (ids, _), own in zip(both.shown, encoded, ends)]
    # A run's last token of A is in its last group; a run without tokens ends where the one before does.
    to = np.concatenate([np.zeros(1, np.int64), groups[0] + 1])[encoded[0][1]]
    numbers = np.stack([np.diff(encoded[0][1]), np.diff(encoded[1][1]), np.diff(to), np.diff(_ends(each[0] * each[1])[to])])

    (group_a, a, n_a), (group_b, b, n_b) = [(key // size, key % size, n) for (key, n), size in ((np.unique(own * len(known) + ids, return_counts=True), len(known)) for own, (ids, _), known in zip(groups, encoded, both.shown))]
    of_b = np.bincount(group_b, minlength=len(cuts))
    at_b = _ranges(_ends(of_b)[group_a], of_b[group_a])
    at_a = np.repeat(np.arange(len(a)), of_b[group_a])
    links = _ends(np.bincount(group_a[at_a], minlength=len(cuts)))[to]
    return Runs(runs, np.zeros(len(runs), np.int64), numbers, _strings(pc.binary_join_element_wise(*shown, _LARGE["|"]), to, ";"), links, (a[at_a] << 32) + b[at_b], n_a[at_a] * n_b[at_b])


def _starts(texts: pa.Array, raw: np.ndarray, first: np.ndarray, apart: bool) -> np.ndarray:
    """Where the runs begin that texts, which begin at `first`, fall apart into: _CUT in UTF-8."""
    start = np.zeros(len(raw) + 1, bool)
    if apart:
        visible = (raw > 32) & (raw < 127)
        before, byte = raw[:-1], raw[1:]
        visible[1:] |= (byte >> 6 == 2) & ((before >= 0xC3) & (before <= 0xC8) | (before == 0xC9) & (byte <= 0x8F))
        start[1:-1] = visible[:-1] & (byte == 32)
        start[first + np.asarray(pc.binary_length(pc.utf8_rtrim(texts, " ")))] = False
    start[first] = True
    return np.flatnonzero(start[:-1])


def align_batch(both: Pair, texts: pa.Array, keep: int = HEAD_RUNS) -> tuple[list[np.ndarray], pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: numbers, groups; ends among pairs, distinct pairs in order, and their links. Up to `keep` runs stay known.

    Each distinct run is aligned once; runs known from before come first
    among the distinct ones, so their numbers are those they had.
    """
    texts = pc.binary_join_element_wise(_LARGE[" "], texts.cast(pa.large_string()).fill_null(""), _LARGE[""])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[: bounds[-1]]
    first = bounds[:-1]
    starts = _starts(texts, raw, first, both.apart)
    runs = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw))), texts.buffers()[2]])
    known = both.known if both.known is not None else aligned(both, runs.slice(0, 0))
    had = len(known.run)
    coded = pa.concat_arrays([known.run, runs]).dictionary_encode()
    known, codes = known + aligned(both, coded.dictionary.slice(had)), np.asarray(coded.indices)[had:].astype(np.int64)
    known.times = known.times + np.bincount(codes, minlength=len(known.run))
    both.known = known.take(_most(known, keep))
    del coded, runs, raw

    of = np.searchsorted(starts, first)
    # Without tokens are texts with a run without, an empty text among them: B has none for its only run, a space.
    bad = np.logical_or.reduceat(known.numbers[0][codes] == 0, of)
    numbers = [np.where(bad, 0, np.add.reduceat(own[codes], of)) for own in known.numbers]
    groups = pc.if_else(pa.array(bad), _LARGE[""], _strings(known.groups.take(pa.array(codes)), np.append(of, len(codes)), ";"))

    text = np.repeat(np.arange(len(first)), np.diff(of, append=len(codes)))
    held, times = np.unique(text * len(known.run) + codes, return_counts=True)
    text, codes = held // len(known.run), held % len(known.run)
    good = ~bad[text]
    text, codes, times = text[good], codes[good], times[good]
    counts = np.diff(known.ends)[codes]
    links = _ranges(known.ends[codes], counts)
    values, place = np.unique(known.pairs, return_inverse=True)
    key = np.repeat(text, counts) * len(values) + place[links]
    order = np.argsort(key)
    key, n = key[order], (np.repeat(times, counts) * known.n[links])[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.add.reduceat(n, new) if len(new) else n
    at, key = (key[new] // len(values), values[key[new] % len(values)]) if len(new) else (key, key)
    return numbers, groups, _ends(np.bincount(at, minlength=len(first))), key, n


def _most(runs: Runs, keep: int) -> np.ndarray:
    """The most frequent short runs, as they stand."""
    short = np.flatnonzero(np.asarray(pc.binary_length(runs.run)) <= HEAD_BYTES)
    if len(short) > keep:
        short = np.sort(short[np.argpartition(-runs.times[short], keep)[:keep]])
    return short


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", folder: str | None = None, shown: Column | None = None) -> DataFrame:
    """How the tokens of two tokenizers cover each text: (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    A space and the text are encoded by A, a byte-level BPE file; the text
    alone by B, a SentencePiece model that adds the space; special tokens'
    strings are plain text. Byte places where tokens of both end cut them
    into groups, written as `a1,a2|b1;a3|b2,b3`. Each token of A is linked to
    each of B in its group. A pair of ids counts the documents that have it
    linked; n_best are the links whose count is the highest of their A id's,
    ties included, count_sum is the counts' sum over links.

    Texts fall apart before spaces that follow a visible character, where no
    merge of either tokenizer goes across (of a model with pieces that do,
    whole texts are taken). Each distinct run of a batch of texts is encoded
    and aligned once; texts are composed of their runs. A text's distinct
    pairs are kept with it, and are what is counted: a document is an entry
    for each of its pairs. Entries of frequent pairs meet their counts by a
    broadcast, of at most HEAD_PAIRS pairs; the others, few of each, by a join.

    Texts that are null or empty, or whose tokens' joined bytes differ from a
    space and the text (as with U+2581), have no tokens: zeros, and groups is
    ''. A repeated row is a document of its own; null keys are kept. A text
    is aligned in one task. Empty tables give no rows; other columns are
    ignored.

    folder: where tables between jobs go, on storage that all executors
    share; they are the caller's to remove once the result has been read.
    Without it they lie in the checkpoint folder and are removed, and the
    result, groups and all, is a checkpoint.
    shown: an expression of the column groups that is kept in its place, as
    groups are several times the texts' size.
    """
    spark, within, keep = docs.sparkSession, folder or scratch_folder(docs.sparkSession, "alignment"), HEAD_RUNS
    kept = lambda name: spark.read.parquet(f"{within}/{name}")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        for batch in slices(batches, 2, 2 * _BATCH):
            numbers, groups, ends, pairs, n = align_batch(both, batch.column(2), keep)
            lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)) for x in (pairs, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, numbers), groups.cast(pa.string()), *lists], names=["row", "doc", *_NUMBERS, "groups", "pair", "n"])
            del numbers, groups, ends, pairs, n, lists
            give_back()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    fields = f"row bigint, doc {rows.schema['doc'].dataType.simpleString()}, {', '.join(f'{c} bigint' for c in _NUMBERS)}, groups string, pair array<bigint>, n array<bigint>"
    with _setting(spark, _BATCH_SETTING, str(_BATCH)):
        rows.mapInArrow(align, fields).withColumn("groups", F.col("groups") if shown is None else shown).write.parquet(f"{within}/texts")

    kept("texts").select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")).write.parquet(f"{within}/pairs")
    counts = kept("pairs").withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))  # as many as A has ids at most
    total = counts.agg(F.sum("docs")).first()[0] or 0
    judged = counts.join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).cast("long").alias("best"))
    common = F.col("docs") * HEAD_PAIRS >= total
    head, entries = judged.where(common), kept("texts").select("row", F.inline(F.arrays_zip("pair", "n")))
    rare = entries.join(F.broadcast(head.select("pair")), "pair", "left_anti").join(judged.where(~common), "pair")
    met = entries.join(F.broadcast(head), "pair").unionByName(rare)
    weights = met.groupBy("row").agg(F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
    none = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    out = kept("texts").drop("pair", "n").join(weights, "row", "left").select(F.col("doc").alias(key), *_NUMBERS, *none, "groups")
    if folder:
        return out
    out = out.checkpoint()
    drop_folder(spark, within)
    return out
