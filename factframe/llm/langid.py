"""Language of texts and of their parts: script ranges, per-word scores, Viterbi with a switching penalty."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back

UNKNOWN = "und"
#: At most about so many documents of a language are learned from: the bound of the sample.
SAMPLE_PER_LANGUAGE = 1000
#: Languages that a model may have, so that it can be broadcast: under 300 MB.
MAX_LANGUAGES = 1000
#: log2 of the number of buckets of character n-grams: bounds the model, whatever the sample.
BUCKET_BITS = 15
#: Log-score a change of language costs, that of a letter's script being foreign, the weight of overlapping n-grams.
SWITCH, FOREIGN, WEIGHT = 8.0, 60.0, 0.4
#: Words whose scores a worker remembers; words that are labelled together.
MEMORY_WORDS, GROUP_WORDS = 150_000, 200_000

#: First code points of script ranges and their scripts: fixed values of Unicode's blocks.
RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "other"), (0x20000, "han"), (0x30000, "other"),
]
SCRIPTS = sorted({s for _, s in RANGES})
_SPACE_RUN = re.compile(r"\S+")


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter; its script."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    starts = [a for a, _ in RANGES]
    names = np.array([SCRIPTS.index(s) for _, s in RANGES], np.uint8)
    edges = np.searchsorted(starts, np.arange(0x110000), side="right") - 1
    return letter, names[edges]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word) of every n-gram of 1 to 3 letters, word ends included; letters and first script of each word."""
    letter, script = _tables()
    codes = np.frombuffer(("\n" + "\n".join(words) + "\n\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.cumsum(codes == 10) - 1
    is_letter = letter[codes]
    c = np.where(is_letter, codes, 0)
    a, b, d = c[:-2], c[1:-1], c[2:]
    mid = b > 0
    shift = np.uint32(32 - BUCKET_BITS)
    with np.errstate(over="ignore"):
        one = b * np.uint32(2654435761)
        two = one + d * np.uint32(2246822519) + np.uint32(374761393)
        three = two + a * np.uint32(3266489917) + np.uint32(668265263)
    at = word[1:-1][mid]
    buckets = np.concatenate([x[mid] * np.uint32(0x9E3779B1) >> shift for x in (one, two, three)])
    n = len(words)
    letters = np.bincount(word[is_letter], minlength=n)[:n]
    first = np.full(n, len(SCRIPTS), np.int64)
    where = np.nonzero(is_letter)[0][::-1]
    first[word[where]] = script[codes[where]]
    return buckets, np.tile(at, 3), letters, first


@dataclass
class Model:
    """Log-probabilities of n-gram buckets and the scripts in use, by language."""

    languages: list[str]
    table: np.ndarray  # bucket, language
    uses: np.ndarray  # script (the last row: none), language

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-scores of each word by language, the best at most 0; its letters. Words without letters are neutral."""
        buckets, word, letters, first = features(words)
        n, k = len(words), len(self.languages)
        out = np.stack([np.bincount(word, weights=self.table[buckets, i], minlength=n)[:n] for i in range(k)], axis=1) * WEIGHT
        allowed = self.uses[first]
        out -= np.where(allowed | ~allowed.any(1, keepdims=True), 0, FOREIGN)
        out -= np.log(np.exp(out - out.max(1, keepdims=True)).sum(1, keepdims=True)) + out.max(1, keepdims=True)
        out[letters == 0] = 0
        return out.astype(np.float32), letters


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model:
    """Learn from rows with a language, about `per_language` of each, picked by a hash of the key.

    The sample is bounded, so is the model: (bucket, language) sums, made in
    each task and added up before they reach the driver, one packed row a
    language, for at most `max_languages` languages, which bounds the model
    at 256 KB each; more are an error, and mean a higher bound. Null texts
    teach nothing; rows without a language are left out; without any, the model
    knows no language.
    """
    known = docs.where(F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    names = sorted(totals)
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not names:
        return Model([], np.zeros((1 << BUCKET_BITS, 0)), np.zeros((len(SCRIPTS) + 1, 0), bool))
    share = F.create_map(*[F.lit(x) for name in names for x in (name, min(1.0, per_language / totals[name]))])
    drawn = known.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).select("text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.dropna().groupby("lang"):
                words: Counter[str] = Counter()
                for value in part["text"]:
                    words.update(value.lower().split())
                if not words:
                    continue
                buckets, word, letters, first = features(list(words))
                times = np.fromiter(words.values(), np.int64, len(words))
                sums = np.bincount(buckets, weights=times[word], minlength=1 << BUCKET_BITS)
                scripts = np.bincount(first, weights=times * letters, minlength=len(SCRIPTS) + 1)
                both = np.concatenate([sums, scripts[:-1]])
                at = np.nonzero(both)[0]
                yield pd.DataFrame({"lang": name, "feature": at, "n": both[at]})

    table = np.zeros(((1 << BUCKET_BITS) + len(SCRIPTS), len(names)))
    sums = drawn.mapInPandas(count, "lang string, feature int, n double").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    at = {name: i for i, name in enumerate(names)}
    for r in sums.groupBy("lang").agg(F.collect_list("feature").alias("features"), F.collect_list("n").alias("ns")).toLocalIterator():
        table[r["features"], at[r["lang"]]] = r["ns"]
    grams, scripts = table[: 1 << BUCKET_BITS] + 0.3, table[1 << BUCKET_BITS :]
    uses = np.vstack([scripts > 0.01 * np.maximum(scripts.sum(0), 1), np.zeros(len(names), bool)])
    return Model(names, np.log(grams / grams.sum(0)), uses)


def viterbi(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word of each text, a change costing `switch`; ties keep the language, then the first.

    Texts lie end to end in scores, longest first, and advance side by side.
    """
    k = scores.shape[1]
    small = np.min_scalar_type(max(k - 1, 0))  # holds any language's number
    came = np.zeros(scores.shape, small)
    value = np.zeros((len(sizes), k), np.float32)
    lanes, own = np.arange(len(sizes)), np.arange(k, dtype=small)
    longest = int(sizes[0]) if len(sizes) else 0
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), side="right")
    for t in range(longest):
        n = active[t]
        at, v = starts[:n] + t, value[:n]
        best = v.argmax(1)
        jump = v[lanes[:n], best] - switch
        stay = v >= jump[:, None]
        came[at] = np.where(stay, own, best[:, None])
        value[:n] = np.where(stay, v, jump[:, None]) + scores[at]
    out = np.zeros(len(scores), small)
    state = value.argmax(1).astype(small)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        out[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return out


class _Words:
    """Rows of the score table by word, for one worker."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores, self.letters = np.zeros((0, len(self.model.languages)), np.float32), np.zeros(0, np.int64)

    def look_up(self, words: list[str]) -> np.ndarray:
        if new := list({w for w in words if w not in self.rows}):
            if len(self.rows) + len(new) > MEMORY_WORDS:
                self.clear()
                new = list(set(words))
            scores, letters = self.model.score(new)
            self.rows.update(zip(new, range(len(self.letters), len(self.letters) + len(new))))
            self.scores, self.letters = np.concatenate([self.scores, scores]), np.concatenate([self.letters, letters])
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))


def _label(texts: list[str], words: _Words) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text of a group."""
    names = words.model.languages
    if not names:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    split = [t.lower().split() for t in texts]
    order = sorted(range(len(texts)), key=lambda i: -len(split[i]))
    sizes = np.array([len(split[i]) for i in order], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    rows = words.look_up([w for i in order for w in split[i]])
    labels, letters = viterbi(words.scores[rows], starts, sizes), words.letters[rows]
    out: list = [None] * len(texts)
    for i, start, size in zip(order, starts, sizes):
        own, weight = labels[start : start + size], letters[start : start + size]
        if not (total := int(weight.sum())):
            out[i] = (UNKNOWN, 0.0, [])
            continue
        share = np.bincount(own, weights=weight, minlength=len(names))
        best = int(share.argmax())
        out[i] = (names[best], float(share[best] / total), _spans(texts[i], own, names))
    return out


def _spans(text: str, labels: np.ndarray, names: list[str]) -> list[dict]:
    cuts = np.nonzero(np.diff(labels))[0] + 1
    if not len(cuts):
        return [{"lang": names[labels[0]], "start": 0, "end": len(text)}]
    places = [m.start() for m in _SPACE_RUN.finditer(text)]
    ends = [0, *(places[c] for c in cuts), len(text)]
    return [{"lang": names[labels[c]], "start": a, "end": b} for c, a, b in zip([0, *cuts], ends, ends[1:])]


def identify(docs: DataFrame, model: Model, text: str = "text", to: str = "language") -> DataFrame:
    """docs with `to`, a struct (lang_pred, score, lang_spans): the language with the most letters, its share of them, and all spans.

    Each word gets a score by language from its letters' n-grams; languages
    that don't use its script are ruled out. Viterbi labels the words of the
    whole text. Spans (lang, start, end) cover the text in code points, ends
    exclusive. A null text, or one without a letter, gives `und`, 0 and no
    spans, as does a model without languages. Repeated rows get equal
    results; an empty table gives no rows. All columns of docs stay as they
    are; `to` must be none of them (common.free_name() gives such a name).
    """
    spans = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_spans", spans)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(schema)
    def label(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Words(shared.value)
        for part in parts:
            texts = [x or "" for x in part]
            done: list = [None] * len(texts)
            # Texts of like length go together, about GROUP_WORDS words at a time.
            group, held = [], 0
            for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
                group.append(i)
                held += len(texts[i]) // 6
                if held >= GROUP_WORDS:
                    for j, found in zip(group, _label([texts[g] for g in group], words)):
                        done[j] = found
                    group, held = [], 0
            for j, found in zip(group, _label([texts[g] for g in group], words)):
                done[j] = found
            yield pd.DataFrame(done, columns=["lang_pred", "score", "lang_spans"])
        give_back()

    # Called non-deterministic, so that a filter on the result isn't pushed below it and every text labelled twice.
    return docs.select("*", label.asNondeterministic()(F.col(text)).alias(to))


def held_out(key: Column) -> Column:
    """The quarter of documents that nothing is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
