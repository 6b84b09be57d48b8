"""Each operator against a plain version on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import array
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from factframe.llm import chat, langid, licenses, media, packing, pieces, pii, simhash, substrings, topk
from factframe.llm.components import connected_components
from factframe.llm.queries import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, units string, kept string, score string, `__text` string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, lang="en", first=0):
    rows = [(i, t, lang, "s", None, "x", "y", "z", "q", None) for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "in", "é", "ñ", "Re", "."]) for _ in range(rng.randint(1, 4)))
    base = [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(25)]
    near = [b + " extra" for b in base[:5]]
    shared = " ".join(word() for _ in range(20))
    return [*base, *near, *base[:6], shared + " a b", "c " + shared, "d\t" + shared + "\n\n" + shared, None, "", "   ", "one", "one two", "x " * 3000, "日本語 текст 🙂", "w\x1cx \x85y", *base[:1] * 4]


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 1), (10, 11), (11, 12), (12, 13), (13, 14), (14, 15), (5, 5), (20, None), (10, 11)] + [(100, i) for i in range(101, 140)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, **{i: 10 for i in range(10, 16)}, 100: 100, **{i: 100 for i in range(101, 140)}}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_simhash_through_rows_without_a_key(spark, monkeypatch):
    """Fingerprints that only rows without a key have link others; a component of such rows only has no id."""
    rows = [(5, 0b0), (None, 0b111), (2, 0b111111), (None, 0xFFFF << 40), (None, 0xFFFF << 40), (9, -1)]
    monkeypatch.setattr(simhash, "_prints", lambda *_: spark.createDataFrame(rows, "__key bigint, fp bigint"))
    got = sorted(simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect(), key=lambda r: (r[1], r[0] or 0))
    assert [(r["doc_id"], r["component_id"]) for r in got] == [(5, 2), (None, 2), (2, 2), (None, None), (None, None), (9, 9)]


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORDS.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(spark, texts):
    got = simhash.near_duplicates(documents(spark, texts)).collect()
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    parent = {i: i for i in prints}
    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    assert sorted(map(tuple, got)) == [(i, f"{prints[i]:016x}", find(parent, i)) for i in prints]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_hamming_links_meet_all_pairs(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(8)]
    prints = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(15)} | {0, 2**64 - 1, 2**63, 7})
    classes = spark.createDataFrame([(p - (p >> 63 << 64), i) for i, p in enumerate(prints)], "fp bigint, rep bigint")
    want = {(b, a) for a, b in itertools.combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3}
    for segments in (2, 3, 4):
        assert {tuple(r) for r in simhash.hamming_links(classes, 3, segments).collect()} == want


def test_substrings(spark, texts):
    found = substrings.drop_repeats(documents(spark, texts), keep=("kept", "score"), group_bytes=4000, bucket_bytes=9000)
    assert found.columns == ["doc_id", "kept", "score", "repeats"]
    got = {r["doc_id"]: tuple(r["repeats"]) for r in found.collect()}
    seen, want = {}, {}
    for i, t in enumerate(texts):
        words = WORDS.findall(t or "")
        gone = [False] * len(words)
        for p in range(len(words) - 12):
            w = tuple(words[p : p + 13])
            if seen.setdefault(w, i) < i:
                gone[p : p + 13] = [True] * 13
        want[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    assert got == want and any(w[1] for w in want.values())


def test_substrings_keys(spark):
    long = " ".join(f"w{i}" for i in range(20))
    rows = spark.createDataFrame([(None, long), (5, long), (5, long), (7, long + " end"), (-3, "a " + long), (None, long)], "k bigint, t string")
    got = sorted((r["k"] is None, r["k"] or 0, r["repeats"]["n_removed"]) for r in substrings.drop_repeats(rows, "k", "t").collect())
    assert got == [(False, -3, 0), (False, 5, 20), (False, 5, 20), (False, 7, 20), (True, 0, 0), (True, 0, 0)]
    assert substrings.drop_repeats(rows.limit(0), "k", "t").count() == 0


def test_substrings_of_words_that_power_series_confuse(spark):
    word = "a"
    for _ in range(12):  # the Thue-Morse word: its power series equals its complement's modulo 2**64
        word += word.translate(str.maketrans("ab", "ba"))
    first = " ".join(f"w{i}" for i in range(12))
    rows = spark.createDataFrame([(1, f"{first} {word}"), (2, f"{first} {word.translate(str.maketrans('ab', 'ba'))}")], "doc_id bigint, text string")
    assert {r["repeats"]["n_removed"] for r in substrings.drop_repeats(rows).collect()} == {0}


def base_finds(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return {k: [m.span() for m in re.finditer(p, text) if ok(m[0])] for k, (p, ok) in rules.items()}


def test_pii_base():
    rng = random.Random(1)
    plain = ["".join(rng.choice("12 9.@a-+()c5") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    for t in [*plain, "4111 1111 1111 1111 a@b.c@d.e +1 (017) 555-7713 1.2.3.4.5.6 256.1.1.1 00255.1.1.1", "9" * 5000, "a" * 5000 + "@"]:
        assert pii.base_spans(t) == base_finds(t), t


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail john.doe (at) example [dot] com now", "email", "john.doe (at) example [dot] com"),
        ("j0e at mail dot example dot com", "email", "j0e at mail dot example dot com"),
        ("john＠ехample.com", "email", "john＠ехample.com"),
        ("call plus one five five five two three four five six seven eight nine", "phone", "plus one five five five two three four five six seven eight nine"),
        ("ip one nine two dot one six eight dot one dot two five", "ip", "one nine two dot one six eight dot one dot two five"),
        ("é ４111 1111 1111 1111", "card", "４111 1111 1111 1111"),
        ("to jane@example dot se, please", "email", "jane@example dot se"),
        ("jane (at) mail dot example dot kr", "email", "jane (at) mail dot example dot kr"),
        ("jane&#64;firma dot no", "email", "jane&#64;firma dot no"),
    ],
)
def test_pii_disguises(text, kind, found):
    base, both = pii.find_pii(text)
    assert not base[kind] and [text[a:b] for a, b in both[kind]] == [found]


def test_pii_two_letters_are_no_label_without_a_certain_at():
    for t in ("jane@example.com dot is a sign", "we look at it dot se is there", "a@ dot se", "@example dot se", "x" * 300 + " dot se", "a@" + "b" * 400 + " dot se"):
        base, both = pii.find_pii(t)
        assert base == both, t


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("to jane.doe at firma.de", "email", "jane.doe at firma.de"),
        ("to jane.doe\tat\tfirma.co.uk", "email", "jane.doe\tat\tfirma.co.uk"),
        ("x 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
        ("x +1 415 555 two six 71", "phone", "+1 415 555 two six 71"),
        ("call plus 1 (415) 555-2671", "phone", "plus 1 (415) 555-2671"),
        ("x 4111 1111 1111 11L1", "card", "4111 1111 1111 11L1"),
        ("\"four 111 1111 1111 1111\"", "card", "four 111 1111 1111 1111"),
        ("x +1 (848) 555-137 three now", "phone", "+1 (848) 555-137 three"),
    ],
)
def test_pii_lone_disguises(text, kind, found):
    assert found in [text[a:b] for a, b in pii.find_pii(text)[1][kind]]


def test_pii_article_is_no_digit():
    base, both = pii.find_pii("ouvi. +1 (848) 555-1373 Un an oule")
    assert base == both and len(base["phone"]) == 1


WORD = "|".join(sorted(map(re.escape, pii.DIGITS), key=lambda w: (-len(w), w)))
OPEN, CLOSE, DOTS = r"[\[({<]", r"[\])}>]", "dot|punkt|punto|point"
SPOKEN = rf"[ \t]+(?:{DOTS})[ \t]+"
BOXED = rf"[ \t]*{OPEN}[ \t]*(?:{DOTS}|\.)[ \t]*{CLOSE}[ \t]*"
TAIL = rf"[A-Za-z0-9-]+(?:(?:{SPOKEN}|{BOXED}|\.)[A-Za-z0-9-]+)*?(?:{BOXED}[A-Za-z0-9-]|{SPOKEN}(?:{pii._LAST})\b)"
#: The disguises as one pattern, whose look-aheads take time in the square of a text's length.
PLAIN_RULES = re.compile(
    "(?P<gone>[­​-‍⁠﻿]+)"
    rf"|(?P<at>[ \t]*{OPEN}[ \t]*(?:at|@|arroba|klammeraffe)[ \t]*{CLOSE}[ \t]*|&#0*64;|&commat;|(?<=[A-Za-z0-9])[ \t]+(?:at|arroba)[ \t]+(?={TAIL}))"
    rf"|(?P<written>(?<=[A-Za-z0-9])[ \t]+at[ \t]+(?=(?:[A-Za-z0-9-]+\.)+(?:{pii._LAST})\b))"
    r"|(?P<like>(?<=[0-9])[OoIl](?=[0-9])|(?<![A-Za-z0-9])[OoIl](?=[0-9]{2})|(?<=[0-9]{2})[OoIl](?![A-Za-z0-9]))"
    rf"|(?P<dot>{BOXED}|(?<=[A-Za-z0-9]){SPOKEN}(?=(?:[A-Za-z0-9-]+{SPOKEN})*(?:{pii._LAST})\b|[A-Za-z0-9_-]+(?:{SPOKEN}[A-Za-z0-9_-]+)*[ \t]+(?:at|arroba)[ \t]+{TAIL}|(?:{WORD}|[0-9]))|&#0*46;)"
    rf"|(?P<plus>\bplus[ \t]+(?=(?:{WORD}|[0-9])\b))"
    rf"|(?P<digits>\b(?:{WORD})(?:[ \t,_-]{{1,3}}(?:{WORD}|[0-9]))*\b(?![A-Za-z]))",
    re.IGNORECASE,
)
NAMED = re.compile(r"(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9%+-]*[0-9._])[A-Za-z0-9._%+-]*[A-Za-z0-9]$")


def plainly_rewritten(text):
    tape, done = pii._Tape(), 0
    for m in PLAIN_RULES.finditer(text):
        if m.lastgroup == "written" and not NAMED.search(text[: m.start()]):
            continue
        tape.put(text[done : m.start()], done, m.start(), True)
        if m.lastgroup == "digits":
            for d in re.finditer(f"{WORD}|[0-9]", m[0], re.IGNORECASE):
                tape.put(pii.DIGITS.get(d[0].lower(), d[0]), m.start() + d.start(), m.start() + d.end(), False)
        else:
            new = ("0" if m[0] in "Oo" else "1") if m.lastgroup == "like" else {"written": "@", "gone": "", "at": "@", "dot": ".", "plus": "+"}[m.lastgroup]
            tape.put(new, m.start(), m.end(), False)
        done = m.end()
    tape.put(text[done:], done, len(text), True)
    return tape


def test_pii_finds_what_the_plain_rules_find(monkeypatch):
    rng = random.Random(11)
    pick = rng.choice
    label = lambda: pick(["mail", "firma", "x9", "one", "acme-co", "b"])
    dot = lambda: pick([".", " dot ", "[dot]", " ( punkt ) ", "\tpunto\t", "<.>"])
    at = lambda: pick(["@", " at ", " (at) ", "[ at ]", "\tarroba\t", "&#64;", "＠"])
    mail = lambda: pick(["jane.doe", "j0e", "jane dot doe", "kim", "a_b"]) + at() + "".join(label() + dot() for _ in range(rng.randint(1, 3))) + pick(["com", "de", "io", "museum"])
    digit = lambda: pick(["1", "4", "one", "SEVEN", "fünf", "l", "0"])
    number = lambda: pick(["+", "plus ", "", ""]) + "".join(digit() + pick([" ", " ", "-", "", ", ", "_"]) for _ in range(rng.randint(1, 18)))
    ip = lambda: pick([".", " dot ", "[dot]"]).join(pick(["192", "one six", "7", "256", "10"]) for _ in range(4))
    prose = lambda: pick(["look at the dot matrix", "one or two", "meet at noon.", "(at) last", "a dot", "", "at home dot com"])
    made = [pick([" ", ", ", "\n"]).join(pick([mail, number, ip, prose])() for _ in range(rng.randint(1, 4))) for _ in range(8000)]
    got = [pii.find_pii(t) for t in made]
    monkeypatch.setattr(pii, "rewrite", plainly_rewritten)
    wrong = [t for t, found in zip(made, got) if pii.find_pii(t) != found]
    assert sum(base != both for base, both in got) > 2000 and not wrong, (len(wrong), [(t, dict(zip(made, got))[t][1], pii.find_pii(t)[1]) for t in wrong[:3]])


@pytest.mark.parametrize("part", ["a dot ", "one ", " ", "a@", "[at] x", "x at ", "( ", "plus ", "1.", "&#"])
def test_pii_time_grows_with_the_text(part):
    import time

    took = []
    for n in (60_000, 240_000):
        began = time.process_time()
        pii.find_pii((part * n)[:n])
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0] + 0.5


def test_pii_clean_and_masked(spark):
    assert not any(map(any, pii.find_pii("look at the dot matrix. one or two, un deux. Meet at noon")[1].values()))
    rows = documents(spark, ["to a@b.co or +1 (017) 555-7713.", None, "", "plain"])
    got = {r["doc_id"]: r for r in pii.detect_pii(rows.withColumn("base", F.lit(1)), redact=True).select("doc_id", "lang", "pii.*").collect()}
    assert got[0]["redacted"] == "to [EMAIL] or [PHONE]." and got[1]["redacted"] is None and got[3]["redacted"] == "plain" and got[0]["lang"] == "en"
    assert [tuple(s) for s in got[0]["spans"]] == [("email", 3, 9), ("phone", 13, 30)] and got[2]["base"] == []


def test_langid(spark):
    rng = random.Random(5)
    make = lambda ws, n: " ".join(rng.choice(ws) for _ in range(n))
    en, fr, ru = "the and that with this have from they".split(), "les des est une dans pour avec vous".split(), "это что как для его она они все".split()
    rows = [(i, make(ws, 40), lang) for i, (ws, lang) in enumerate([(en, "en"), (fr, "fr"), (ru, "ru")] * 20)]
    model = langid.fit(spark.createDataFrame([*rows, (99, None, "en"), (100, "x", None)], "doc_id bigint, text string, lang string"))
    mixed = make(en, 30) + "\n" + make(fr, 12) + " " + make(ru, 6)
    texts = [make(fr, 20), make(ru, 5), mixed, None, "", "123 !!", "The", make(en, 8000)]
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, texts, lang=None), model).select("doc_id", "score", "language.*").toDF("doc_id", "own", "lang_pred", "score", "lang_spans").collect()}
    assert all(r["own"] == "q" for r in got.values())
    assert [got[i]["lang_pred"] for i in range(8)] == ["fr", "ru", "en", "und", "und", "und", "en", "en"]
    assert got[0]["score"] == 1 and got[3]["score"] == 0 and 0.5 < got[2]["score"] < 1
    spans = [(s["lang"], mixed[s["start"] : s["end"]].strip()) for s in got[2]["lang_spans"]]
    assert [s[0] for s in spans] == ["en", "fr", "ru"] and len(spans[1][1].split()) == 12
    none = langid.fit(documents(spark, []).where("false"))
    assert {r["language"]["lang_pred"] for r in langid.identify(documents(spark, ["a"]), none).collect()} == {"und"}


def test_viterbi_is_exact():
    rng = np.random.default_rng(0)
    sizes = np.array([6, 5, 3, 1, 0])
    scores = rng.normal(size=(15, 3)).astype(np.float32) * 2
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    got = langid.viterbi(scores, starts, sizes, 1.5)
    for a, n in zip(starts, sizes):
        cost = lambda path, a=a: sum(scores[a + i, s] for i, s in enumerate(path)) - 1.5 * sum(x != y for x, y in zip(path, path[1:]))
        if n:
            assert cost(got[a : a + n]) == pytest.approx(max(map(cost, itertools.product(range(3), repeat=int(n)))), abs=1e-4)


def test_viterbi_of_many_languages():
    scores = np.full((3, 300), -9, np.float32)
    scores[:, 299] = 0
    assert langid.viterbi(scores, np.array([0]), np.array([3])).tolist() == [299] * 3


def test_chat_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", r"[\INST] <\\s> [NEXT]", "", "a\n[ROLE]x[TEXT]", "<</s>", "日本 🙂"]
    rows = [(1, t, role, x) for t, (role, x) in enumerate(itertools.product(["user", "assistant", "system", "tool[TEXT]"], tricky))]
    rows += [(2, 1, "assistant", "b"), (2, 0, "assistant", "a"), (2, 2, "user", None), (2, None, None, "n"), (3, 0, "user", "x"), (3, 0, "user", "x"), (None, 0, "user", "k")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1)).withColumn("blocks", F.lit(2))
    made = chat.format_conversations(table)
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r, x) for _, _, r, x in own]
        assert got[conv]["loss_text"] == "".join(x for _, _, r, x in own if r == "assistant")
    nobody = chat.format_conversations(spark.createDataFrame([(None, i, "user", str(i)) for i in range(5)], "conv_id bigint, turn bigint, role string, text string"))
    assert sorted(r["formatted"] for r in nobody.collect()) == [f"<s>[INST]{i}[/INST]" for i in range(5)]
    assert got[2]["formatted"] == "<s>[ROLE][TEXT]n[/ROLE][BOT]a[NEXT]b</s>[INST][/INST]"
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    many = [*texts, "It's I'LL don't <|endoftext|> x", "a b c d", "İstanbul ΑΣ ﬁ ½ ª", "é" * 300]
    got = packing.pack_documents(documents(spark, many), path, capacity=64).collect()
    ids = {i: tk.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(many)}
    pieces_of, windows = {}, {}
    for r in got:
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces_of.setdefault(r["doc_id"], []).append((r["start"], r["length"], array.array("I", r["ids"]).tolist()))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, own in ids.items():
        assert sum((p[2] for p in sorted(pieces_of[i])), []) == own
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(documents(spark, []), path).count() == 0


def test_packing_with_another_tokenizer(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    texts = ["Hello World, it is 2024", "  two  spaces\n", "É", None]
    want = {i: Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert {r["doc_id"]: array.array("I", r["ids"]).tolist() for r in packing.pack_documents(documents(spark, texts), path).collect()} == want


def test_best_fit_decreasing():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 21, 300)
    window, offset = packing.best_fit_decreasing(lengths, 20)
    room, want = [], {}
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        fits = [(r, w) for w, r in enumerate(room) if r >= lengths[i]]
        w = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(20)
        want[i] = 20 - room[w]
        room[w] -= lengths[i]
    assert window.max() + 1 == len(room) and Counter(np.bincount(window, weights=lengths).tolist()) == Counter(20.0 - r for r in room)


def test_top_k(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.5, 0.25, 0.5, 2.0, 0.1]) for _ in range(6)]) for i in range(60)]
    rows += [(i, [0.5] * 6) for i in range(60, 90)] + [(90, None), (91, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (92, [float("nan")] * 6), (93, [float("inf")] * 6), (94, []), (200, [1.0, 2.0]), (201, [3.0, 1.0])]
    # Repeated rows and keys, a row without a key, components whose scores are beyond a long.
    rows += [(60, [0.5] * 6), rows[20], (20, [2.0] * 6), (None, [1.0] * 6), (300, [1e30] * 6), (301, [-1e30] * 6)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("dim", F.lit(1)).withColumn("v", F.lit("b"))
    most = 2**63 - 1
    valid = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for n, (q, asked) in enumerate(valid):
        if q % 20 == 0 or q == 201:
            scored = sorted((-max(-most, min(most, sum(a * b for a, b in zip(asked, v)))), i) for m, (i, v) in enumerate(valid) if m != n and len(v) == len(asked))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:7])]
    for lists, block in ((2, 16), (3, 4)):
        got = topk.top_k_inner(table, table.where("vec_id % 20 = 0 OR vec_id = 201"), k=7, lists=lists, block_queries=block)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k_inner(table.limit(0), table.limit(0)).count() == topk.top_k_inner(table.limit(0), table).count() == topk.top_k_inner(table, table.limit(0)).count() == 0


def test_top_k_resolves_few_scores(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    counts = []
    topk.top_k_inner(rows, rows.where("vec_id % 100 = 0"), counts=counts)
    (found,) = counts
    assert found["first"] < found["last"] < found["pairs"] / 5 and found["fetched"] <= found["last"]


def test_top_k_of_a_common_vector(spark):
    """A third of all rows are one vector, and so are a third of the queries: no pairs within the group are made."""
    rows = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(0.5), F.lit(0.5))).otherwise(F.array(F.rand(1), F.rand(2))).cast("array<float>").alias("embedding"))
    counts = []
    got = topk.top_k_inner(rows, rows.where("vec_id % 30 = 0"), k=5, counts=counts)
    assert counts[0]["pairs"] == 2001 and {r["n"] for r in got.groupBy("query_id").count().withColumnRenamed("count", "n").collect()} == {5}


def wrapped(text, n):
    words = text.split()
    return "\n".join("# " + " ".join(words[i : i + n]) for i in range(0, len(words), n))


def test_licenses(spark):
    code = "\n".join(f"def f{i}(x): return x + {i}" for i in range(60))
    mit, gpl, bsd = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["GPL-3.0"][1], licenses.TEMPLATES["BSD-3-Clause"][0]
    texts = [
        "x\nReleased under the MIT License.\ny", "Licensed under CC BY-NC 4.0.", "licensed  UNDER the apache license version 2.0", "Permission is nothing", None, "", "\n\n",
        "No licence here\nAll rights reserved.\nReleased under the MIT License.", "word " * 4000 + "\nThis work is licensed under the GNU General Public License, version 3.", "école released under the mit license",
        code + "\n" + wrapped(mit, 12) + "\n\n" + code, wrapped(gpl, 9) + "\n" + code, "Copyright (c) 2001 X\n\n" + wrapped(bsd, 14) + "\n" + code, wrapped(gpl.replace("program", "thing"), 30), code + "\n" + wrapped(gpl, 9)[:60],
        "This work is licensed under a Creative Commons\nAttribution 4.0 International License.\n" + code, "Licensed under the Apache\nLicense, Version 2.0.\n" + code, "This work is licensed under the GNU General Public License, version 3.",
    ]
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(documents(spark, texts)).collect()}

    def words(t):
        return re.sub("[^a-z0-9]+", " ", t.lower()).split()

    def grams(w):
        return {(a, b) for a, b in zip(w, w[1:])}

    library = [(n, grams(words(t)), words(t)) for n, ts in licenses.TEMPLATES.items() for t in ts]
    for i, t in enumerate(texts):
        lines = [words(x) for x in (t or "").split("\n")]
        units = [(0, words(t or ""), None)] * (len(lines) > 1) + [(k, x, None) for k, x in enumerate(lines, 1)]
        for k, line in enumerate(lines):
            for own, (_, _, full) in enumerate(library):
                if len(full) >= licenses.RUN_WORDS and grams(line) & set(list(zip(full, full[1:]))[: licenses.OPENING]):
                    run, end = [], k
                    for j in range(k, len(lines)):
                        run, end = run + lines[j], j if lines[j] else end
                        if len(run) >= len(full):
                            break
                    if end > k:
                        units.append((k + 1, run, own))
        dice = lambda x, g: 2 * len(grams(x) & g) / (len(grams(x)) + len(g))
        want = sorted((u, n, round(dice(x, g), 9)) for u, x, own in units for j, (n, g, _) in enumerate(library) if own in (None, j) and grams(x) and dice(x, g) >= 0.8)
        want = [m for m in want if m[2] == max(o[2] for o in want if o[0] == m[0])]  # the best of a unit
        assert sorted((m["unit"], m["license"], round(m["dice"], 9)) for m in rows[i]["matches"]) == want, i
    assert [rows[i]["best_license"] for i in (0, 1, 2, 7, 8)] == ["MIT", "CC-BY-NC-4.0", "Apache-2.0", "Proprietary", "GPL-3.0"] and rows[4]["n_matches"] == 0
    assert [rows[i]["best_license"] for i in (10, 11, 12, 14)] == ["MIT", "GPL-3.0", "BSD-3-Clause", None]
    assert [rows[i]["licenses"] for i in (15, 16, 17)] == ["CC-BY-4.0", "Apache-2.0", "GPL-3.0"]


def png(width=3):
    chunk = lambda n, d: len(d).to_bytes(4, "big") + n + d + zlib.crc32(n + d).to_bytes(4, "big")
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", width.to_bytes(4, "big") + b"\0\0\0\1\x08\0\0\0\0") + chunk(b"IDAT", zlib.compress(b"\0" * (width + 1))) + chunk(b"IEND", b"")


def test_media_sniffing(spark):
    import gzip

    wav, zipped = media.as_wav("inside"), gzip.compress(b"hello" * 50)
    bmp = b"BM" + (54 + 4).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (1).to_bytes(4, "little") * 2 + b"\1\0\x18\0" + b"\0" * 24 + b"abcd"
    gif = b"GIF89a\1\0\1\0\x80\0\0" + b"\0" * 6 + b",\0\0\0\0\1\0\1\0\0\x02\x02D\x01\0;"
    jpeg = b"\xff\xd8\xff\xe0\0\x04ab" + b"\xff\xc0\0\x03a" + b"\xff\xda\0\x03a" + b"data\xff\xd9"
    blob = b"BM junk RIFF" + png() + b"BM" + zipped + gif + b"x" + bmp + jpeg + wav + b"\x89PNG\r\n\x1a\n"
    found = media.sniff(blob)
    assert [f.kind for f in found] == ["image/png", "application/gzip", "image/gif", "image/bmp", "image/jpeg", "audio/wav"]
    assert [blob[f.start : f.start + f.length] for f in found] == [png(), zipped, gif, bmp, jpeg, wav]
    broken = png()[:-5] + b"?" + png()[-4:]
    rows = spark.createDataFrame([(1, wav, "image/png"), (2, broken, "image/png"), (3, None, "x/y"), (4, b"", None), (5, blob, None)], "k int, m binary, d string")
    got = {r["k"]: r for r in media.sniff_media(rows, "k", "m", "d").collect()}
    held = media.as_wav("BM GIF8 BM")
    (one,) = media.sniff_media(spark.createDataFrame([(1, held, "x/y", 5)], "k int, m binary, d string, actual int"), "k", "m", "d", keep=("actual",)).select("proposed", "inside").collect()
    assert one["proposed"] == {"image/bmp": 2, "image/gif": 1} and one["inside"] == []
    assert [got[i]["actual"] for i in range(1, 6)] == ["audio/wav", "image/png", "x/y", None, "image/png"]
    assert bytes(got[1]["found"][0]["data"]).rstrip(b"\xff") == b"inside" and got[2]["found"] == [] and len(got[5]["found"]) == 6


def test_media_store_round_trip(spark, texts):
    tricky = [*texts, "RIFF....WAVE BM GIF89a", "\x00\x1f\x8b"]
    seen = media.sniff_media(media.store_as_media(documents(spark, tricky)), "doc_id", "media", "declared", keep=("n_bytes",))
    for r in seen.collect():
        raw = (tricky[r["doc_id"]] or "").encode()
        data = bytes(r["found"][0]["data"])
        assert r["actual"] == "audio/wav" and r["n_bytes"] == len(raw) and data == raw + b"\xff" * (len(data) - len(raw)) and len(data) % 576 == 0 and 0 < len(data) - len(raw) + (len(raw) > 0) * 576 <= 1152


def plain_segmentations(v, text):
    raw, out = (" " + text).encode(), {}

    def go(i, ids, w):
        if i == len(raw):
            out[tuple(ids)] = w
            return
        size = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
        node, single = 0, False
        for j in range(i, len(raw)):
            if (p := v.piece[node, raw[j]]) >= 0:
                single |= j + 1 - i == size
                go(j + 1, [*ids, int(p)], w + v.weight[p])
            if (node := v.next[node, raw[j]]) < 0:
                break
        if not single:
            go(i + size, [*ids, *map(int, v.byte[list(raw[i : i + size])])], w + size * v.byte_weight)

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: w - total for k, w in out.items()}


@pytest.mark.parametrize("text", ["the cat", "", "a", "of in", "é日🙂x", "x\ny", "a  b", "x \n    y"])
def test_pieces_follow_the_distribution(text):
    v = pieces.vocabulary(tokenizer_path("piece_bpe_32k.model"), 0.3)
    want, n = plain_segmentations(v, text), 3000
    drawn = pieces.segmentations(v, [text] * n, [xxhash.xxh64_intdigest(str(i)) for i in range(n)], 3)
    first = Counter()
    for samples in drawn:
        ids = [tuple(map(int, s[0])) for s in samples]
        assert len(set(ids)) == len(ids) == min(3, len(want))
        assert all(abs(s[1] - want[i]) < 1e-9 and s[2] <= 1e-12 and v.decode(s[0]).decode() == text for i, s in zip(ids, samples))
        first[ids[0]] += 1
    for i, w in want.items():
        p = math.exp(w)
        assert abs(first[i] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9
    # Inclusion chances weigh the samples: the weighted probabilities add up to 1 on average.
    assert np.mean([sum(math.exp(s[1] - s[2]) for s in samples) for samples in drawn]) == pytest.approx(1, abs=0.1)


def test_pieces_hold_the_models_own_segmentation():
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_path("piece_bpe_32k.model")
    v, text = pieces.vocabulary(path, 0.3), "if x:\n        y  = 1"
    own = tuple(SentencePieceProcessor(model_file=path).encode(text))
    assert any(b"  " in v.bytes[i] for i in own) and own in plain_segmentations(v, text)
    atoms = v.atoms.findall(" " + text)
    assert "".join(atoms) == " " + text and atoms == [" if", " x:", "\n", "        y", "  =", " 1"]


def test_pieces_table(spark, texts):
    path = tokenizer_path("piece_bpe_32k.model")
    a = pieces.sample_pieces(documents(spark, texts), path).collect()
    b = pieces.sample_pieces(documents(spark, texts).repartition(7), path).collect()
    key = lambda r: (r["doc_id"], r["sample"], bytes(r["ids"]), r["n_pieces"], round(r["log_prob"], 6))
    assert sorted(map(key, a)) == sorted(map(key, b)) and all(r["restored"] for r in a) and {r["doc_id"] for r in a} == set(range(len(texts)))
    out = pieces.decode_pieces(pieces.sample_pieces(documents(spark, texts), path), path).collect()
    assert all(r["text"] == (texts[r["doc_id"]] or "") for r in out)
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    assert all(model.decode(array.array("I", r["ids"]).tolist()) == (texts[r["doc_id"]] or "") for r in a if "  " not in (texts[r["doc_id"]] or ""))
