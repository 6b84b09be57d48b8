"""Media columns: find, validate, type and carve media inside binary values by their signatures."""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Magic bytes by kind: fixed values of the formats.
MAGIC = {
    "audio/wav": b"RIFF",
    "image/png": b"\x89PNG\r\n\x1a\n",
    "image/gif": b"GIF8",
    "image/bmp": b"BM",
    "image/jpeg": b"\xff\xd8\xff",
    "application/gzip": b"\x1f\x8b\x08",
}
#: Samples a second of the audio that holds a payload, and bytes in a unit of it.
RATE, UNIT = 8000, 576


class Found(NamedTuple):
    kind: str
    start: int
    length: int
    data_start: int
    data_length: int


@cache
def _signatures():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, magic in MAGIC.items():
        automaton.add_word(magic.decode("latin-1"), (kind, len(magic)))
    automaton.make_automaton()
    return automaton


class _Known:
    """What walks through a value have found out: places that lead nowhere, by a bit a kind of place, and where no end marker follows.

    Walks that begin at different places often come to the same ones. Each
    place is gone on from once, so all walks together take time in
    proportion to the value.
    """

    def __init__(self, size: int):
        self.size, self.bits, self.endless = size, None, None

    def passed(self, at: int, bit: int) -> bool:
        """Whether a walk came by before; it was not successful then, as a success goes on behind itself."""
        if self.bits is None:
            self.bits = bytearray(self.size)
        before = self.bits[at] & bit
        self.bits[at] |= bit
        return bool(before)

    def end_of_jpeg(self, value: bytes, at: int) -> int:
        if self.endless is not None and at >= self.endless:
            return -1
        found = value.find(b"\xff\xd9", at, *([] if self.endless is None else [self.endless + 1]))
        if found < 0:
            self.endless = at
        return found


def _wav(b: memoryview, at: int, known: _Known) -> Found | None:
    """RIFF/WAVE: the size holds, chunks tile it, a PCM format chunk comes before the data, whose length fits the block size."""
    if len(b) - at < 44 or b[at + 8 : at + 12] != b"WAVE":
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    if end > len(b):
        return None
    pos, form, data = at + 12, None, None
    while pos + 8 <= end:
        name, size = bytes(b[pos : pos + 4]), struct.unpack_from("<I", b, pos + 4)[0]
        if pos + 8 + size > end:
            return None
        if name == b"fmt " and size >= 16:
            form = struct.unpack_from("<HHIIHH", b, pos + 8)
        if name == b"data" and form:
            data = (pos + 8, size)
        pos += 8 + size + size % 2
    if pos != end or not form or not data:
        return None
    tag, channels, rate, per_s, block, bits = form
    if tag != 1 or block != channels * bits // 8 or not block or per_s != rate * block or data[1] % block:
        return None
    return Found("audio/wav", at, end - at, *data)


def _png(b: memoryview, at: int, known: _Known) -> Found | None:
    """PNG: an IHDR first, every chunk's checksum right, up to IEND."""
    pos, first, data = at + 8, True, None
    while pos + 12 <= len(b):
        size, name = struct.unpack_from(">I", b, pos)[0], bytes(b[pos + 4 : pos + 8])
        if pos + 12 + size > len(b) or first != (name == b"IHDR") or first and size != 13:
            return None
        if zlib.crc32(b[pos + 4 : pos + 8 + size]) != struct.unpack_from(">I", b, pos + 8 + size)[0]:
            return None
        if name == b"IDAT" and data is None:
            data = (pos + 8, size)
        pos, first = pos + 12 + size, False
        if name == b"IEND":
            return Found("image/png", at, pos - at, *data) if data and size == 0 else None
    return None


def _gif(b: memoryview, at: int, known: _Known) -> Found | None:
    """GIF87a or 89a: colour tables, blocks and sub-blocks lead to the trailer."""
    if len(b) - at < 14 or bytes(b[at + 4 : at + 6]) not in (b"7a", b"9a"):
        return None
    table = lambda flags: 3 << ((flags & 7) + 1) if flags & 128 else 0
    pos, images = at + 13 + table(b[at + 10]), 0
    start = pos
    while pos < len(b):
        if b[pos] == 0x3B:
            return Found("image/gif", at, pos + 1 - at, start, pos - start) if images else None
        if known.passed(pos, 2 if images else 1):
            return None
        if b[pos] == 0x21:
            pos += 2
        elif b[pos] == 0x2C and pos + 11 < len(b):
            pos, images = pos + 11 + table(b[pos + 9]), images + 1
        else:
            return None
        while pos < len(b) and b[pos]:
            if known.passed(pos, 8 if images else 4):
                return None
            pos += 1 + b[pos]
        pos += 1
    return None


def _bmp(b: memoryview, at: int, known: _Known) -> Found | None:
    """BMP with a 40-byte header or a later one: sizes, planes, depth and the pixel rows fit."""
    if len(b) - at < 54:
        return None
    size, zero, data, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    if zero or header not in (40, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or width <= 0 or not height:
        return None
    if data < 14 + header or size > len(b) - at or data + (width * bits + 31) // 32 * 4 * abs(height) > size:
        return None
    return Found("image/bmp", at, size, data + at, size - data)


def _jpeg(b: memoryview, at: int, known: _Known) -> Found | None:
    """JPEG: marker segments with a frame and a scan, up to the end marker. The value is searched in place, nothing is copied."""
    pos, frame = at + 2, False
    while pos + 4 <= len(b) and b[pos] == 0xFF:
        mark, size = b[pos + 1], struct.unpack_from(">H", b, pos + 2)[0]
        if size < 2 or mark in (0x00, 0xD8, 0xFF) or known.passed(pos, 32 if frame else 16):
            return None
        frame |= 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC)
        pos += 2 + size
        if mark == 0xDA:
            end = known.end_of_jpeg(b.obj, pos) if frame else -1
            return Found("image/jpeg", at, end + 2 - at, pos, end - pos) if end >= 0 else None
    return None


def _gzip(b: memoryview, at: int, known: _Known) -> Found | None:
    """Gzip: the stream inflates to its end with the right checksum."""
    if len(b) - at < 18 or b[at + 3] & 0xE0:
        return None
    inflate = zlib.decompressobj(31)
    try:
        pos = at
        while not inflate.eof and pos < len(b):
            data = b[pos : pos + 65536]
            while data and not inflate.eof:  # at most 1 MB of output is held, whatever the stream says
                inflate.decompress(data, 1 << 20)
                data = inflate.unconsumed_tail
            pos += 65536
    except zlib.error:
        return None
    end = min(pos, len(b)) - len(inflate.unused_data)
    return Found("application/gzip", at, end - at, at, end - at) if inflate.eof else None


_VALID = {"audio/wav": _wav, "image/png": _png, "image/gif": _gif, "image/bmp": _bmp, "image/jpeg": _jpeg, "application/gzip": _gzip}


def sniff(value: bytes | None, seen: Counter | None = None) -> list[Found]:
    """The valid media in a value, leftmost first and not overlapping.

    Aho-Corasick proposes places by magic bytes; a place counts only if its
    format's structure and lengths hold there. The search goes on after each.
    Values of any length are searched whole; what GIF and JPEG walks have
    passed in vain isn't walked again, so many false heads cost no more.
    seen, if given, counts the places of each kind that were proposed.
    """
    if not value:
        return []
    out, free, view, known = [], 0, memoryview(value), _Known(len(value))
    for last, (kind, size) in _signatures().iter(value.decode("latin-1")):
        at = last - size + 1
        if at < free:
            continue
        if seen is not None:
            seen[kind] += 1
        if found := _VALID[kind](view, at, known):
            out.append(found)
            free = at + found.length
    return out


def carved(value: bytes, found: Found) -> bytes:
    """The content of audio, else the whole media."""
    at, n = (found.data_start, found.data_length) if found.kind == "audio/wav" else (found.start, found.length)
    return value[at : at + n]


def as_wav(text: str | None) -> bytes:
    """A text's UTF-8 bytes as 8-bit mono samples, filled with 255 to a positive multiple of UNIT."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = raw + b"\xff" * ((-len(raw)) % UNIT if raw else UNIT)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(data))
    return head + data


def store_as_media(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media, declared): each text stored losslessly as 8-bit audio.

    The declared type is the generic one; sniff_media() corrects it. Null
    texts count as empty and give one unit of fill.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            texts = part.column(1).to_pylist()
            sizes = [len((x or "").encode("utf-8", "surrogatepass")) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array([as_wav(x) for x in texts], pa.binary()), pa.array(["application/octet-stream"] * len(texts), pa.string())],
                names=["key", "n_bytes", "media", "declared"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(store, f"key {kind}, n_bytes bigint, media binary, declared string").withColumnRenamed("key", key)


def sniff_media(values: DataFrame, key: str, media: str, declared: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a value: (key, *keep, media, declared, actual, found, proposed, inside).

    actual: the type of the media that fills the whole value, else of the
    first valid one inside, else the declared type. found: every valid media
    as (kind, start, length, data), where data is the carved content: the
    samples of audio, else the whole media. The samples of audio are searched
    too: proposed counts the places in them that have a signature, by kind,
    and inside has those that proved valid, as (kind, start, length) from the
    start of the samples. Null and empty values have none and keep the
    declared type; repeated rows give equal ones; no rows, no result; other
    columns are ignored, and `keep` may hold any names but those of the result.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = [("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())]
        kinds, nested = pa.list_(pa.struct([*place, ("data", pa.binary())])), pa.list_(pa.struct(place))
        for part in slices(batches, 0):
            actual, found, proposed, inside = [], [], [], []
            for value, said in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                hits, seen, within = sniff(value), Counter(), []
                whole = next((h for h in hits if h.start == 0 and h.length == len(value)), hits[0] if hits else None)
                actual.append(whole.kind if whole else said)
                own = [carved(value, h) for h in hits]
                for h, data in zip(hits, own):
                    if h.kind == "audio/wav":
                        within += sniff(data, seen)
                found.append([{"kind": h.kind, "start": h.start, "length": h.length, "data": data} for h, data in zip(hits, own)])
                proposed.append(list(seen.items()))
                inside.append([{"kind": h.kind, "start": h.start, "length": h.length} for h in within])
            made = [pa.array(actual, pa.string()), pa.array(found, kinds), pa.array(proposed, pa.map_(pa.string(), pa.int64())), pa.array(inside, nested)]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "actual", "found", "proposed", "inside"])

    rows = values.select(F.col(media).alias("media"), F.col(declared).alias("declared"), F.col(key).alias("__key"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(keep)])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    place = "kind: string, start: bigint, length: bigint"
    out = rows.mapInArrow(look, f"{fields}, actual string, found array<struct<{place}, data: binary>>, proposed map<string, bigint>, inside array<struct<{place}>>")
    return out.select(F.col("__key").alias(key), *[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)], "media", "declared", "actual", "found", "proposed", "inside")
