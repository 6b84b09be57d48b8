"""Near duplicates by SimHash: 64-bit fingerprints linked through multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, hex64, with_checkpoint_dir
from .components import connected_components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BITS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text as a signed 64-bit number; zero without words.

    A-Z are lower-cased, words are split at space and \\t-\\r, the hashes are
    XXH64 (seed 42) of the space-joined shingles, repeats included; a text of
    fewer words is one shingle. A bit is set if over half the hashes set it.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), 42)]
    elif shingle == 3:
        hashes = [digest(b"%b %b %b" % three, 42) for three in zip(words, words[1:], words[2:])]
    else:
        hashes = [digest(b" ".join(words[i : i + shingle]), 42) for i in range(len(words) - shingle + 1)]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.array(hashes[at : at + 4096], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint64)
    return int((bits << _BITS).sum(dtype=np.uint64).astype(np.int64))


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, to: str = "fp") -> DataFrame:
    """docs with the SimHash of its text column as a signed long; null texts count as empty."""

    @F.pandas_udf(T.LongType())
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([fingerprint(x, shingle) for x in part], dtype="int64")
        give_back()

    return docs.withColumn(to, simhash(F.col(text)))


def _segments(width: int, count: int) -> list[tuple[int, int]]:
    """(shift, bits) of each segment of a fingerprint, the first ones longer."""
    sizes = [width // count + (i < width % count) for i in range(count)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(count)]


def _ball(own: Column, tag: Column, bits: int) -> Column:
    """Keys of the segments that have one bit more than `own`."""
    masks = F.array(*[F.lit(1 << i).cast("long") for i in range(bits)])
    unset = F.filter(masks, lambda m: own.bitwiseAND(m) == 0)
    return F.transform(unset, lambda m: F.struct((tag + own + m).alias("key"), F.lit(False).alias("same")))


def hamming_links(classes: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """Multi-index hashing: pairs of fingerprints that differ in at most `distance` bits.

    classes: (fp, rep), one row a distinct fingerprint. Of `segments` segments
    at least one differs in at most distance // segments bits. Each
    fingerprint goes into one table a segment, keyed by the segment's bits,
    and probes each table with the Hamming ball of that radius round its own
    bits. Where the radius is 1, only set bits are added: of two segments that
    differ in one bit just one lacks it, so each pair is met once and the
    ball costs half. Candidates are verified on all 64 bits. Two segments
    suit billions of rows: a 32-bit key stays selective. Returns (u, v) reps.
    """
    radius = distance // segments
    if radius > 1:
        raise ValueError("segments must be over distance / 2")
    keys, balls = [], []
    for n, (shift, bits) in enumerate(_segments(64, segments)):
        own = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1))
        tag = F.lit(n).cast("long") * F.lit(1 << 40)
        keys.append(F.struct((tag + own).alias("key"), F.lit(True).alias("same")))
        if radius:
            balls.append(_ball(own, tag, bits))
    stored = classes.select("fp", "rep", F.explode(F.array(*keys)).alias("k")).select("k.key", F.col("fp").alias("fp2"), F.col("rep").alias("rep2"))
    probes = classes.select("fp", "rep", F.explode(F.concat(F.array(*keys), *balls)).alias("k")).select("k.key", "k.same", "fp", "rep")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= distance
    met = probes.join(stored, "key").where(near & (~F.col("same") | (F.col("rep") < F.col("rep2"))) & (F.col("rep") != F.col("rep2")))
    return met.select(F.greatest("rep", "rep2").alias("u"), F.least("rep", "rep2").alias("v"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 3, segments: int = 2, shingle: int = 3) -> DataFrame:
    """One row a document: (key, fingerprint, component_id), linking fingerprints at `distance` bits or fewer.

    Equal fingerprints are one class, pre-aggregated before any join, so
    thousands of copies cost one table entry. component_id is the smallest
    key in reach of links, itself included. Null and wordless texts share
    fingerprint zero and are linked like any other. Rows with a null key
    link others as any row does, keep their fingerprint and take the
    component's id, null where no row of the component has a key. A very long
    text is hashed in parts, so it takes its own memory and little more.
    Empty tables give no rows; other columns of docs are ignored.
    """
    prints = _prints(docs, key, text, shingle)
    classes = prints.groupBy("fp").agg(F.min("__key").alias("first"))
    found = connected_components(hamming_links(classes.select("fp", F.col("fp").alias("rep")), distance, segments)).toDF("fp", "part")
    parts = classes.join(found, "fp", "left").select("fp", "first", F.coalesce("part", "fp").alias("part"))
    labels = parts.select("fp", "part").join(parts.groupBy("part").agg(F.min("first").alias("component_id")), "part").drop("part")
    return prints.join(labels, "fp", "left").select(F.col("__key").alias(key), hex64(F.col("fp")).alias("fingerprint"), "component_id")


def _prints(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(key, fp) of every row, written once, as the texts should be hashed only once."""
    with_checkpoint_dir(docs.sparkSession)
    kept = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"))
    return with_fingerprints(kept, "__text", shingle).select("__key", "fp").checkpoint()
