"""Alignment of tokenizers against a plain version over whole texts, without SQL as SQL has no tokenizers."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factframe.llm import alignment
from factframe.llm.queries import op13_alignment, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def groups_of(text: str | None) -> list[tuple[list[int], list[int]]]:
    """Groups of a whole text, cut where tokens of both end."""
    both = alignment.pair(A, B)
    if not text:
        return []
    whole = (" " + text).encode()
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    if b"".join(both.bytes_a[i] for i in a) != whole or b"".join(both.bytes_b[i] for i in b) != whole:
        return []
    ends = []
    for ids, sizes in ((a, both.bytes_a), (b, both.bytes_b)):
        at, own = 0, []
        for i in ids:
            at += len(sizes[i])
            own.append((at, i))
        ends.append(own)
    cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    out, at = [], [0, 0]
    for cut in cuts:
        group = []
        for side, own in enumerate(ends):
            first = at[side]
            while at[side] < len(own) and own[at[side]][0] <= cut:
                at[side] += 1
            group.append([i for _, i in own[first : at[side]]])
        out.append(tuple(group))
    return out


def plain(rows: list[tuple]) -> list[tuple]:
    held: Counter = Counter()
    each = [groups_of(t) for _, t in rows]
    for groups in each:
        held.update({(a, b) for g in groups for a in g[0] for b in g[1]})
    most: dict = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (doc, _), groups in zip(rows, each):
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        shown = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), shown))
    return sorted(out, key=repr)


def texts() -> list[str | None]:
    rng = random.Random(3)
    odd = ["the", " ", "  ", "\n", "\t", "'s", "don't", "naïve", "École", "日本語", "текст", "🙂", "</s>", "<|endoftext|>", "<0x41>", "12345", "...", "x" * 40, " ", "　", "ﬁ", "é", "\x00", "ɏ ", "\r\n", "of", "–", "​", "<s>"]
    made = ["".join(rng.choice(odd) + rng.choice(["", "", " "]) for _ in range(rng.randrange(1, 30))) for _ in range(250)]
    return [*made, *made[:20], None, "", " ", "   ", "a ", " a", "a  b   ", "▁", "a ▁ b", "one▁two", "q7" * 20_000, "the cat " * 20_000]


def test_equal_to_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HEAD_RUNS", 20)
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a null key"), (3, "a repeated key"), (3, "a repeated key")]
    docs = spark.createDataFrame([(d, t, "own", 1) for d, t in rows], "doc_id long, text string, run string, row int")
    got = alignment.align_tokenizers(docs, A, B)
    want = plain(rows)
    assert any(w[1] for w in want) and sum(w[1] == 0 for w in want) >= 3
    assert sorted(map(tuple, got.collect()), key=repr) == want


@pytest.mark.parametrize("apart", [True, False])
def test_runs_have_the_tokens_that_whole_texts_have(monkeypatch, apart):
    """Without Spark: runs joined or alone, and whole texts where pieces go across spaces."""
    both = alignment.pair(A, B)
    monkeypatch.setattr(both, "apart", apart)
    cut = re.compile(alignment._CUT)
    for text in filter(None, texts()[:120]):
        whole = " " + text
        places = [0, *(m.start() for m in cut.finditer(whole)), len(whole)] if apart else [0, len(whole)]
        runs = [whole[a:z] for a, z in zip(places, places[1:])]
        (ids_a, ends_a), (ids_b, ends_b) = both.encode(runs)
        assert len(ends_a) == len(ends_b) == len(runs) + 1
        if (ends_a[1:] > ends_a[:-1]).all():  # else some run's bytes differ, and so do the text's
            assert ids_a.tolist() == both.a.encode(whole, add_special_tokens=False).ids and ids_b.tolist() == both.b.encode(text)
        else:
            assert groups_of(text) == []


@pytest.mark.parametrize("keep", [0, 20, 1 << 17])
def test_batches_after_each_other(keep):
    """Without Spark: texts in small batches, with all, few or none of the runs known from those before."""
    both = alignment.Pair(A, B)
    for at in range(0, len(texts()), 41):
        part = texts()[at : at + 41]
        numbers, groups, ends, pairs, n = alignment.align_batch(both, pa.array(part, pa.string()), keep)
        assert len(both.known.run) <= keep
        for i, want in enumerate(map(groups_of, part)):
            links = Counter((a << 32) + b for g in want for a in g[0] for b in g[1])
            assert groups[i].as_py() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want)
            assert [int(x[i]) for x in numbers] == [sum(len(g[0]) for g in want), sum(len(g[1]) for g in want), len(want), links.total()]
            assert list(zip(pairs[ends[i] : ends[i + 1]].tolist(), n[ends[i] : ends[i + 1]].tolist())) == sorted(links.items())


def test_tables_between_jobs_are_no_larger_than_texts(spark, tmp_path):
    """Distinct runs, each of which was a row with its tokens, groups and links, several times the texts' size on disk."""
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnoprstuvwy", k=rng.randrange(3, 9))) if rng.random() < 0.2 else rng.choice(["the", "of", "and", "in", "was"]) for _ in range(400))) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    digest = F.sha2("groups", 256)
    got = alignment.align_tokenizers(docs, A, B, folder=str(tmp_path / "own"), shown=digest).collect()
    held = sum(p.stat().st_size for p in (tmp_path / "own").rglob("*.parquet"))
    assert held < 1.5 * sum(len(t) for _, t in rows)
    want = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest()) for w in plain(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [0, 50, 1 << 17])
def test_frequent_and_rare_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "HEAD_PAIRS", most)
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, alignment.align_tokenizers(docs, A, B).collect()), key=repr) == plain(rows)


def test_empty_table(spark):
    assert alignment.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_query_equals_the_plain_version(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in plain(rows)]
    assert sorted(map(tuple, op13_alignment(spark, d).collect()), key=repr) == sorted(want, key=repr)
