"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space, and tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; where none is set, a folder of our own, in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="factframe-"))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for tables between jobs."""
    with_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind it as it takes to be none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hex64(fingerprint: Column) -> Column:
    """A signed long as 16 lower-case hex digits of its bits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def finite_vector(embedding: Column) -> Column:
    """True for vectors that are not null and hold only finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return embedding.isNotNull() & ~F.coalesce(F.exists(embedding, bad), F.lit(True))


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose values of a column are about `most` bytes together."""
    for batch in batches:
        at, held = 0, 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if held and held + (n or 0) > most:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n or 0
        if at < batch.num_rows:
            yield batch.slice(at)


def give_back() -> None:
    """Return a worker's freed memory to the system: workers live on between stages and share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library; nothing to do
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


IS_SPACE = np.isin(np.arange(256), list(SPACES))
#: Random values of a byte at a place in its word, for the first places, and what makes those of the others.
_PLACES, _SEEDS = 64, (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_VALUES = [mix(np.arange(256 * _PLACES, dtype=np.uint64) + seed) for seed in _SEEDS]


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and both halves of a 128-bit hash of every word of `data`, which ends in a space.

    A word's hash is the sum of random values, one for each byte and place
    (simple tabulation), scrambled: no arithmetic between places that words
    could be made to cancel out by, as there is in a power series.
    """
    raw = np.frombuffer(data, np.uint8)
    space = IS_SPACE[raw]
    before = np.concatenate([[True], space[:-1]])
    start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    index = np.arange(len(raw))
    code = (index - np.maximum.accumulate(np.where(space, index, -1)) - 1 << 8) + raw
    far = np.flatnonzero(~space & (code >= 256 * _PLACES))
    near = np.where(code < 256 * _PLACES, code, 0)
    halves = []
    for values, seed in zip(_VALUES, _SEEDS):
        each = values[near]
        each[far] = mix(code[far].astype(np.uint64) + seed)
        each[space] = 0
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        halves.append(mix(sums[end] - sums[start]))
    return start, end, *halves


#: Bytes of a text's terms, A-Z in lower case, and a space for all others: digits, letters and what isn't ASCII make terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_runs(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text in order, as lists of about `most` bytes, so that a very long text isn't held as words at once."""
    plain = text.translate(TERM_BYTES)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + most)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def text_bytes(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 of each text; of null, nothing."""
    for value in texts.cast(pa.large_binary()):
        yield value.as_buffer().to_pybytes() if value.is_valid else b""
