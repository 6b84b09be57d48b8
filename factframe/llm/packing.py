"""Packing of tokenised documents into sequences of fixed length: best-fit decreasing."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, slices

#: Token ids held before a group is packed and released: bounds a task's memory, whatever its size.
GROUP_TOKENS = 4_000_000
#: Words, and parts of words, whose ids a worker remembers, in each of two generations.
MEMORY_WORDS = 120_000

#: What a tokenizer's file says if the split below is its own: fixed values.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Texts for which the split below equals that tokenizer's.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ\t-\r ]*")
#: Its split of lower-case text of those characters, white space dropped.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\t-\r ]+")


@cache
def _byte_letters() -> dict[int, str]:
    """Characters to the letters that byte-level BPE writes their UTF-8 bytes with."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(33, 256)}


class _Memory(dict):
    """What `make` gives for strings, remembered for short ones."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= 64:
            if len(self) >= MEMORY_WORDS:  # what is in use moves on to the new generation, the rest goes with the old one
                self.old = self.copy()
                self.clear()
            self[text] = ids
        return ids


class WordTokens:
    """Texts to their ids as little-endian unsigned 32-bit numbers.

    Where the file names the normalizer and the split that are known here, a
    text's ids are those of its words in a row. A text, or else a word, of
    plain characters is split and looked up part by part, which costs a tenth
    of encode(); there are far fewer parts than words with their punctuation.
    All others, and all texts of other tokenizers, go through encode() itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.model = (t := Tokenizer.from_file(path)), t.model
        with open(path, encoding="utf-8") as file:
            own = json.load(file)
        added = [a["content"] for a in own["added_tokens"]]
        self.known = own["normalizer"] == _NORMALIZER and own["pre_tokenizer"] == _PRE_TOKENIZER and own["model"]["type"] == "BPE" and own["model"].get("dropout") is None and own.get("post_processor") is None and own.get("truncation") is None and own.get("padding") is None and all(a.startswith("<|") and not re.search(r"\s", a) for a in added)
        self.parts, self.words = _Memory(self._part), _Memory(self._word)
        self.letters = _byte_letters()

    def _part(self, part: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(part.translate(self.letters))]).tobytes()

    def _word(self, word: str) -> bytes:
        return self._plain(word) if _PLAIN.fullmatch(word) and "<|" not in word else self.whole(word)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        """A text's ids. str.split() also splits at four control characters that the tokenizer keeps."""
        if not self.known:
            return self.whole(text)
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return self._plain(text)
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


@cache
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each piece of at most `capacity` tokens.

    Pieces are taken from long to short (ties in input order); each goes into
    the open window with the least room that still holds it, the oldest of
    those, else into a new one. A segment tree over the remaining capacities
    0..capacity counts the open windows of each, so that the tightest fit is
    the first filled leaf at or right of the piece's length.
    """
    size = 1 << capacity.bit_length()
    tree = [0] * (2 * size)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    heads = [0] * (capacity + 1)
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0

    def count(room: int, change: int) -> None:
        node = room + size
        while node:
            tree[node] += change
            node >>= 1

    def first_from(room: int) -> int:
        node = room + size
        if tree[node]:
            return room
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                while node < size:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
                return node - size
            node >>= 1
        return -1

    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = first_from(need) if need < capacity else -1
        if room < 0:
            which, room, opened = opened, capacity, opened + 1
        else:
            which = open_by_room[room][heads[room]]
            heads[room] += 1
            count(room, -1)
        window[i], offset[i] = which, capacity - room
        if left := room - need:
            open_by_room[left].append(which)
            count(left, 1)
    return window, offset


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: (key, start, length, ids, doc_tokens, sequence_id, offset).

    A document's ids are those of its text, no special ones, then `end_id`.
    It's cut into full windows of `capacity` ids and a rest; a full window is
    a sequence of its own, the rests are packed best-fit decreasing. Rests
    are packed among those of their task, in groups of about GROUP_TOKENS
    ids: nothing is shuffled, memory is bounded, and a group of that size
    leaves next to no padding but in its last windows. sequence_id has the
    task's partition number above bit 40. Each id of each document lies in
    one piece; ids are little-endian unsigned 32-bit numbers. Null texts are
    empty and give the end id only; rows with a null or repeated key are
    packed each; an empty table gives no rows; other columns are ignored,
    whatever their names. `path` is any tokenizer file, read in each task.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(path)
        end = array("I", [end_id]).tobytes()
        made = TaskContext.get().partitionId() << 40
        keys, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, keys, held, size
            doc, start, length, ids = [], [], [], []
            for d, raw in enumerate(held):
                for at in range(0, len(raw), 4 * capacity):
                    piece = raw[at : at + 4 * capacity]
                    doc.append(d)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    ids.append(piece)
            window, offset = best_fit_decreasing(np.array(length, np.int64), capacity)
            doc = np.array(doc, np.int64)
            tokens = np.array([len(x) // 4 for x in held], np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(keys).take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens[doc]), pa.array(window + made), pa.array(offset)],
                names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            made += int(window.max()) + 1
            keys, held, size = [], [], 0
            return out

        for batch in batches:
            for part in slices([batch], 1, 4 << 20):
                keys.append(part.column(0))
                for value in part.column(1).to_pylist():
                    held.append(words.ids(value or "") + end)
                    size += len(held[-1]) // 4
                if size >= GROUP_TOKENS:
                    yield flush()
        if held:
            yield flush()
        give_back()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(pack, f"key {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint").withColumnRenamed("key", key)
