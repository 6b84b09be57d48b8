"""The pipeline stage by stage against plain versions, and the queries that SQL can express against their SQL."""

import array
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from factframe.llm import pii, queries, simhash
from factframe.llm.common import table
from factframe.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    odd = [(10_000, None, "en", "s", 0), (10_001, "12 34", "en", "s", 5), (10_002, "", None, "s", 0), (10_003, "x@y.zz", "en", "s", 6)]
    docs = table(spark, SF, "documents")
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(2).withColumn("doc_id", F.col("doc_id") + 20_000))
    out = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF)
        made.write.parquet(f"{folder}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs.collect())
    return out


def test_language_drops_only_what_has_none(steps):
    assert {r["doc_id"] for r in steps[0]} - {r["doc_id"] for r in steps[1]} == {10_000, 10_001, 10_002}


def five_words(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def kept_by_jaccard(texts):
    """Ids that stay, by brute force: the least of each component at 0.8 of five-word shingles."""
    own = {i: five_words(t) for i, t in texts.items()}
    parent = {i: i for i in own}
    for a in own:
        for b in own:
            if a < b and 10 * len(own[a] & own[b]) >= 8 * len(own[a] | own[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i for i in parent if find(parent, i) == i}


def test_near_groups_meet_brute_force_jaccard(steps):
    assert {r["doc_id"] for r in steps[2]} == kept_by_jaccard({r["doc_id"]: r["text"] for r in steps[1]})


def test_near_chains_of_changed_words(spark):
    rng = random.Random(8)
    texts = {}
    for group in range(6):
        words = [f"g{group}w{rng.randint(0, 999)}" for _ in range(100)]
        for _ in range(15):  # a chain: each changes one word more, so its ends are far apart
            words[rng.randrange(100)] = f"x{rng.randint(0, 10**9)}"
            texts[len(texts) + 1] = " ".join(words)
    texts[500], texts[501], texts[502] = "Two words", "two  WORDS", "two other"
    docs = spark.createDataFrame([*texts.items(), (None, "two words"), (None, "without an id")], "doc_id bigint, text string")
    got = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()]
    assert got.count(None) == 1 and {i for i in got if i} == kept_by_jaccard(texts) and len(got) < 20


def test_near_rows_of_one_id_are_judged_one_by_one(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(20)) for x in "ab")
    rows = [(2, a), (5, a), (5, b), (6, a), (9, b), (5, b), (None, b), (None, None), (7, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, row int")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(2, a, 1), (5, b, 1), (7, "", 1)]


CLASH = ["kept", "base", "spans", "redacted", "score", "lang_pred", "__label", "n_words", "n_removed", "language", "repeats", "pii", "row", "one", "first", "cid"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_with_odd_rows_and_clashing_names(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = table(spark, SF, "documents").limit(30)
    odd = [(None, "no id here, only some words of text", "en", "s", 1), (1, None, None, None, None), (1, "", "en", "s", 0), (None, None, None, None, None), (8_000, "long " * 30_000, "en", "s", 150_000)]
    docs = docs.unionByName(spark.createDataFrame(odd * 2, docs.schema)).select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])
    got = stage(spark, docs, SF)
    if name == "packing":
        assert got.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    else:
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASH)
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_repeats_go(steps):
    seen = {}
    got = {r["doc_id"]: r["text"] for r in steps[3]}
    for r in sorted(steps[2], key=lambda r: r["doc_id"]):
        words = WORDS.findall(r["text"])
        gone = [False] * len(words)
        for p in range(len(words) - 12):
            if seen.setdefault(tuple(words[p : p + 13]), r["doc_id"]) < r["doc_id"]:
                gone[p : p + 13] = [True] * 13
        assert got[r["doc_id"]] == (" ".join(w for w, g in zip(words, gone) if not g) if any(gone) else r["text"])


def test_personal_data_is_masked(steps):
    before, after = ({r["doc_id"]: r for r in s} for s in (steps[3], steps[4]))
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r["text"] == pii.masked(before[i]["text"], pii.find_pii(before[i]["text"])[1]) and r["n_chars"] == len(r["text"])
    assert after[10_003]["text"] == "[EMAIL]"


def test_pieces_hold_all_ids(steps):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces = {}
    for r in steps[5]:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for r in steps[4]:
        ids = tk.encode(r["text"], add_special_tokens=False).ids + [1]
        assert sum(p[1] for p in pieces[r["doc_id"]]) == len(ids)
        assert all(zlib.crc32(array.array("I", ids[s : s + n]).tobytes()) == c for s, n, c in pieces[r["doc_id"]])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    order = [want.columns.index(c) for c in got.columns]
    key = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert key(got.collect()) == key([r[i] for i in order] for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, SF)
    ids = {r[0] for r in rows.select(rows.columns[0]).collect()}
    if rows.columns[0] == "doc_id":
        assert ids == {r[0] for r in table(spark, SF, "documents").select("doc_id").collect()}
    else:
        assert ids


def test_language_of_held_out_documents(spark):
    found = queries.op5_langid(spark, SF).where("held_out").join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n >= 0.95
