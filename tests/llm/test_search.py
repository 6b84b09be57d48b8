"""Ranked search and decontamination against plain versions, with nulls, ties, repeats, long texts and blocks."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from factframe.llm.leaks import find_leaks
from factframe.llm.ranking import rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    counts = [(d, Counter(w), len(w)) for d, t in docs if (w := terms(t))]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c, n in counts:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def prose(rng: random.Random, n: int) -> str:
    return rng.choice([" ", ", ", "\n", " – "]).join(rng.choice(["Alpha", "beta", "GAMMA", "delta9", "émile", "École", "x", "The", "the", "of"]) for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.randrange(0, 60))) for i in range(60)]
    docs += [(100 + i, docs[3][1]) for i in range(30)] + [(7, docs[3][1]), (None, docs[4][1]), (500, None), (501, ""), (502, "!?"), (503, "alpha beta " * 200_000)]
    items = [(i, prose(rng, rng.randrange(1, 30))) for i in range(12)] + [(0, "alpha alpha émile"), (None, "beta gamma"), (40, None), (41, ""), (42, "nowhere found")]
    items += [(43, " ".join(terms(docs[9][1])[3:18])), (44, " ".join(terms(docs[9][1])[3:18]))]
    return docs, items


@pytest.mark.parametrize("block", [4 << 20, 100])
def test_ranks_equal_the_formula(spark, tables, block):
    docs, items = tables
    got = rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), 5, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(docs, items, 5)


def test_ranks_of_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{k} long, text string, item bigint, score string") for k in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    assert rank_documents(docs, items).count() == 0
    assert rank_documents(some, items).count() == 0
    assert rank_documents(docs, some.withColumnRenamed("doc_id", "item_id")).count() == 0


def leaks(text: str | None, items: list[tuple], size: int = 10) -> tuple:
    words, hit, ids = terms(text), set(), set()
    for item, other in items:
        own = terms(other)
        n = min(len(own), size)
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1 if windows else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                ids |= {str(item)} if item is not None else set()
    return len(words), len(hit), tuple(sorted(ids))


@pytest.mark.parametrize("block", [512 << 10, 120])
def test_leaks_equal_every_window_tried(spark, tables, block):
    docs, items = tables
    docs = [d for d in docs if d[0] != 503]
    rows = [(i, d, t, "own") for i, (d, t) in enumerate(docs)]
    got = find_leaks(spark.createDataFrame(rows, "r long, doc_id long, text string, items string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block).collect()
    assert len(got) == len(docs)
    for row in got:
        n, hit, ids = leaks(row["text"], items)
        assert (row["leaks"]["n_words"], row["leaks"]["n_hit"], tuple(row["leaks"]["items"])) == (n, hit, ids), row
        assert row["items"] == "own"
        shown = [w for s in row["leaks"]["spans"] for w in terms(row["text"][s["start"] : s["end"]])]
        ranges = [terms(row["text"])[r["start"] : r["end"]] for r in row["leaks"]["words"]]
        assert shown == [w for r in ranges for w in r] and len(shown) == hit
        assert all(TERM.fullmatch(row["text"][i].translate(LOWER)) for s in row["leaks"]["spans"] for i in (s["start"], s["end"] - 1))


def test_leaks_in_very_long_texts_and_none(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    text = "é zero " * 400_000 + passage + " zero" * 300_000
    docs = spark.createDataFrame([(1, text), (2, None), (3, passage[4:])], "doc_id long, text string")
    got = {r["doc_id"]: r["leaks"] for r in find_leaks(docs, spark.createDataFrame([(9, passage.upper() + "!")], "item_id long, text string")).collect()}
    assert got[1]["n_words"] == 1_100_011 and got[1]["n_hit"] == 11 and [(s["start"], s["end"]) for s in got[1]["spans"]] == [(2_800_000, 2_800_000 + len(passage))]
    assert (got[2]["n_words"], got[2]["n_hit"]) == (0, 0) and got[3]["n_hit"] == 10
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert {r["leaks"]["n_hit"] for r in find_leaks(docs, nothing).collect()} == {0} and find_leaks(docs.limit(0), nothing).count() == 0


def test_leaks_query_columns(spark):
    from factframe.llm.queries import op12_leaks

    row = op12_leaks(spark, "/root/testdata/sf0.001").where("contaminated").first()
    assert row and len(row["items_sha256"]) == len(hashlib.sha256().hexdigest())


def test_false_heads_of_media_take_time_in_proportion():
    import time

    from factframe.llm import media

    rng = random.Random(1)
    gif = lambda n: b"".join(b"GIF87a" + bytes(rng.choice([97, 110, 32, 122]) for _ in range(14)) for _ in range(n // 20))
    jpeg = lambda n: (b"\xff\xd8\xff\xc0\x00\x04ab\xff\xda\x00\x02" + b"x" * 8) * (n // 20)
    for make in (gif, jpeg):
        took = []
        for n in (200_000, 1_600_000):
            value = make(n)
            best = []
            for _ in range(2):
                began = time.process_time()
                assert media.sniff(value) == []
                best.append(time.process_time() - began)
            took.append(min(best))
        assert took[1] < 20 * took[0] + 0.2


def test_what_walks_have_passed_changes_no_result(monkeypatch):
    from factframe.llm import media

    rng = random.Random(3)
    parts = [b"GIF89a", b"GIF87a\x01\x00\x01\x00\x00\x00\x00", b",\0\0\0\0\1\0\1\0\0\2\2D\1\0", b"!\xfe\3abc\0", b";", b"\0", b"\xff\xd8\xff\xe0\x00\x04ab", b"\xff\xc0\x00\x04ab", b"\xff\xda\x00\x02", b"\xff\xd9", b"q"]
    values = [b"".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    got = [media.sniff(v) for v in values]
    monkeypatch.setattr(media._Known, "passed", lambda *_: False)
    monkeypatch.setattr(media._Known, "end_of_jpeg", lambda _, value, at: value.find(b"\xff\xd9", at))
    assert got == [media.sniff(v) for v in values] and {f.kind for g in got for f in g} == {"image/gif", "image/jpeg"}


def test_hex_entities_are_disguises():
    from factframe.llm.pii import find_pii

    text = "mail jane&#x40;example&#x2E;com or joe&#X0040;site&period;org now"
    _, both = find_pii(text)
    assert [text[a:z] for a, z in both["email"]] == ["jane&#x40;example&#x2E;com", "joe&#X0040;site&period;org"]


def test_more_languages_than_the_bound(spark):
    from factframe.llm.langid import fit

    docs = spark.createDataFrame([(i, f"words of {i}", f"l{i % 3}") for i in range(30)], "doc_id long, text string, lang string")
    assert fit(docs, max_languages=3).languages == ["l0", "l1", "l2"]
    with pytest.raises(ValueError, match="more than 2"):
        fit(docs, max_languages=2)
