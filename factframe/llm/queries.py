"""The queries of this package, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .chat import CONTROL, format_conversations, read_back
from .common import drop_folder, scratch_folder, table
from .langid import fit, held_out, identify
from .leaks import find_leaks
from .licenses import openings, scan_licenses, templates
from .media import MAGIC, sniff_media, store_as_media
from .packing import pack_documents
from .pieces import sample_pieces
from .pii import KINDS, detect_pii
from .ranking import rank_documents
from .simhash import near_duplicates
from .substrings import drop_repeats
from .topk import top_k_inner


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = sample_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return drawn.select("doc_id", "sample", "n_pieces", F.crc32("ids").alias("ids_crc32"), "log_prob", "log_inclusion", "restored")


#: A conversation whose texts hold control strings.
TRICKY = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    read = read_back(format_conversations(rows.unionByName(tricky)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP6_SQL = rf"""
WITH r AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, NULL, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, NULL, 1, 'assistant', '{TRICKY}'),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text) AS k FROM r),
e AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id, alone ORDER BY k) <> role, true) AS opens,
    length(regexp_replace(text, '(<|\[)(\\*){CONTROL}', '\1\\\2\3', 'g')) AS n,
    length(regexp_replace(role, '(<|\[)(\\*){CONTROL}', '\1\\\2\3', 'g')) AS n_role FROM o)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(n + CASE WHEN NOT opens THEN 6 WHEN role IN ('system', 'assistant') THEN CASE role WHEN 'system' THEN 11 ELSE 9 END
    WHEN role = 'user' THEN 13 ELSE 19 + n_role END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id, alone
"""


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = sniff_media(store_as_media(table(spark, sf_dir, "documents")), "doc_id", "media", "declared", keep=("n_bytes",))
    payload = F.col("found")[0]["data"]
    listed = lambda c: F.array_join(F.transform(c, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["length"].cast("string"))), ",")
    proposed = F.array_join(F.transform(F.array(*map(F.lit, sorted(MAGIC))), lambda m: F.concat_ws("=", m, F.coalesce(F.try_element_at("proposed", m), F.lit(0)).cast("string"))), ",")
    return seen.select(
        "doc_id",
        "n_bytes",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -32, 32)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", "declared", "actual", listed("found"), proposed, listed("inside")).alias("feature"),
    )


def _le32(x: str) -> str:
    """Hex digits of a number as four little-endian bytes."""
    return "||".join(f"printf('%02x', (({x}) >> {8 * i}) & 255)" for i in range(4))


#: A CRC-32 of up to 32 bytes, bit by bit: the reflected polynomial 0xEDB88320.
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, {0}), lambda c, b: list_reduce(list_prepend(xor(c, b::BIGINT), range(8)::BIGINT[]), lambda v, _: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"
#: Signatures that UTF-8 text may hold; the others begin with bytes that it can't.
_TEXTUAL = {"audio/wav": "RIFF", "image/gif": "GIF8", "image/bmp": "BM"}
_PROPOSED = " || ',' || ".join(f"'{kind}=' || " + (f"((length(t) - length(replace(t, '{_TEXTUAL[kind]}', ''))) // {len(_TEXTUAL[kind])})" if kind in _TEXTUAL else "0") for kind in sorted(MAGIC))
#: Of the texts' own media there are none in the tables, as text alone is no sound file of these kinds.
OP10_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT *, CASE WHEN n = 0 THEN 576 ELSE (n + 575) // 576 * 576 END AS size FROM d),
h AS (SELECT *, lower(hex(encode(t))) || repeat('ff', (size - n)::BIGINT) AS payload FROM p),
m AS (SELECT *, '52494646' || {_le32('36 + size')} || '57415645666d7420' || {_le32('16')} || '0100' || '0100' || {_le32('8000')} || {_le32('8000')} || '0100' || '0800' || '64617461' || {_le32('size')} || payload AS media FROM h)
SELECT doc_id, n::BIGINT AS n_bytes, size::BIGINT AS payload_bytes, sha256(from_hex(payload)) AS payload_sha256,
  {_CRC.format("list_transform(range(32), lambda i: ('0x' || payload[(2 * (size - 32 + i) + 1)::BIGINT:(2 * (size - 32 + i) + 2)::BIGINT])::BIGINT)")}::BIGINT AS tail_crc32,
  (size + 44)::BIGINT AS media_bytes, sha256(from_hex(media)) AS media_sha256,
  'application/octet-stream;audio/wav;audio/wav:0:' || (size + 44) || ';' || {_PROPOSED} || ';' AS feature
FROM m
"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii.*")
    return found.select("doc_id", *map(_count, KINDS), F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain finds of op4_pii, which SQL can express: their counts and digest."""
    return op4_pii(spark, sf_dir).drop("spans")


# Matches are set between two control characters, and places follow from what lies between those.
_PLACES = """list_transform(range(2, len({0}) + 1, 2), lambda i: {{'k': '{1}', 'a': coalesce(list_sum(list_transform({0}[1:i - 1], lambda x: length(x))), 0)::BIGINT, 't': {0}[i]}})"""
_DIGITS = "regexp_replace(x.t, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN (length({_DIGITS}) - i) % 2 = 0 THEN {_DIGITS}[i]::INT ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][{_DIGITS}[i]::INT + 1] END)) % 10 = 0"
_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(x.t, '.'), lambda p: length(ltrim(p, '0')) > 3 OR ('0' || ltrim(p, '0'))::BIGINT > 255)) = 0"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
}


def _pii_base_sql() -> str:
    split = ", ".join(f"string_split(regexp_replace(coalesce(text, ''), '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS {kind}" for kind, (pattern, _) in _KINDS.items())
    found = ", ".join(f"list_filter({_PLACES.format(kind, kind)}, lambda x: {ok}) AS {kind}" for kind, (_, ok) in _KINDS.items())
    return f"""WITH s AS (SELECT doc_id, {split} FROM documents), f AS (SELECT doc_id, {found} FROM s)
SELECT doc_id, {', '.join(f'len({k})::BIGINT AS n_{k}' for k in _KINDS)}, sha256(array_to_string(list_transform(list_concat({', '.join(_KINDS)}), lambda x: x.k || ':' || x.a || ':' || (x.a + length(x.t))), ',')) AS base_sha256 FROM f"""


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k_inner(rows, rows.where("vec_id % 100 = 0"))


OP8_SQL = """
WITH c AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM c q JOIN c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    found = identify(docs.select("doc_id", "text", "held_out"), fit(docs.where(~F.col("held_out"))))
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score")

def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_matches", "licenses", "best_license", F.round("best_dice", 6).alias("best_dice"))


def _op2_sql() -> str:
    texts = lambda grams: "['" + "', '".join(grams) + "']" if grams else "[]::VARCHAR[]"
    rows = ", ".join(f"({i}, '{name}', {texts(grams)}, {n}, {texts(start)})" for i, ((name, grams), (n, start)) in enumerate(zip(templates(), openings())))
    grams = "list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])"
    return rf"""
WITH t(id, license, grams, n_words, opening) AS (VALUES {rows}),
l AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
u AS (
  SELECT r, doc_id, unnest(lines) AS text, unnest(range(1, len(lines) + 1)) AS unit FROM l
  UNION ALL SELECT r, doc_id, text, 0 FROM l WHERE len(lines) > 1),
w AS (SELECT r, doc_id, unit, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') AS words FROM u),
c AS (SELECT *, sum(len(words)) OVER (PARTITION BY r ORDER BY unit) AS upto FROM w WHERE unit > 0),
d AS (SELECT r, list(unit ORDER BY unit) AS units, list(upto ORDER BY unit) AS ends, flatten(list(words ORDER BY unit)) AS words FROM c WHERE len(words) > 0 GROUP BY r),
s AS (
  SELECT c.r, c.doc_id, c.unit, t.id, c.upto - len(c.words) AS a, d.words, list_filter(list_zip(d.units, d.ends), lambda p: p[2] >= least(c.upto - len(c.words) + t.n_words, len(d.words)))[1] AS stop
  FROM c JOIN t ON len(c.words) > 1 AND len(t.opening) > 0 AND list_has_any({grams.format('c.words')}, t.opening) JOIN d ON d.r = c.r),
g AS (
  SELECT r, doc_id, unit, -1 AS own_id, list_distinct({grams.format('words')}) AS grams FROM w WHERE len(words) > 1
  UNION ALL SELECT r, doc_id, unit, id, list_distinct({grams.format('own')}) FROM (SELECT *, words[a + 1:stop[2]] AS own FROM s WHERE stop[1] > unit)),
m AS (
  SELECT r, unit, license, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
  FROM g JOIN t ON len(g.grams) BETWEEN len(t.grams) * 0.8 / 1.2 AND len(t.grams) * 1.2 / 0.8 AND own_id IN (-1, id)),
b AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
    arg_min(license, (-dice, unit, license)) AS best_license, round(max(dice), 6) AS best_dice
  FROM (SELECT * FROM m WHERE dice >= 0.8 QUALIFY dice = max(dice) OVER (PARTITION BY r, unit)) GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses, best_license, best_dice
FROM l LEFT JOIN b USING (r)
"""


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
p AS (SELECT r, doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w WHERE len(words) >= 13),
h AS (SELECT r, doc_id, i, sha256(array_to_string(words[i:i + 12], ' ')) AS k FROM p),
f AS (SELECT k, min(doc_id) AS least FROM h WHERE doc_id IS NOT NULL GROUP BY k),
c AS (SELECT r, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM h JOIN f USING (k) WHERE least < doc_id GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN c USING (r)
"""


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _terms(text: str) -> str:
    """A list of a text's terms, A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS terms FROM documents),
c AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms)) AS n_terms FROM d),
i AS (SELECT row_number() OVER () AS i, item_id, {_terms('text')} AS terms FROM benchmark),
it AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM it) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM f, c),
s AS (
  SELECT i, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + ((75 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM it JOIN p USING (term) JOIN w USING (term), c WHERE doc_id IS NOT NULL GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) <= 10
"""


def op12_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select("doc_id", "leaks.*")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS words FROM documents),
i AS (SELECT item_id, {_terms('text')} AS words, least(len(words), 10) AS n FROM benchmark WHERE len({_terms('text')}) > 0),
k AS (SELECT DISTINCT n, array_to_string(words[a:a + n - 1], ' ') AS k, item_id FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS a FROM i)),
p AS (SELECT r, n, a, array_to_string(words[a:a + n - 1], ' ') AS k FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM k))),
h AS (SELECT p.r, p.n, p.a, k.item_id FROM p JOIN k USING (n, k)),
w AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(a, a + n)) AS word FROM h) GROUP BY 1),
t AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT r, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN w USING (r) LEFT JOIN t USING (r)
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests instead of the groups themselves, as those are several times the texts' size."""
    folder = scratch_folder(spark, "alignment")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), folder=folder, shown=digest)
    out = found.withColumnRenamed("groups", "groups_sha256").checkpoint()
    drop_folder(spark, folder)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pieces": op1_pieces,
    "op2_licenses": op2_licenses,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_langid": op5_langid,
    "op6_chat": op6_chat,
    "op7_packing": op7_packing,
    "op8_topk": op8_topk,
    "op9_substrings": op9_substrings,
    "op10_media": op10_media,
    "op11_ranking": op11_ranking,
    "op12_leaks": op12_leaks,
    "op13_alignment": op13_alignment,
    "pii_base": pii_base,
}

ORACLES: dict[str, str] = {
    "op2_licenses": _op2_sql(),
    "op6_chat": OP6_SQL,
    "op8_topk": OP8_SQL,
    "op9_substrings": OP9_SQL,
    "op10_media": OP10_SQL,
    "op11_ranking": OP11_SQL,
    "op12_leaks": OP12_SQL,
    "pii_base": _pii_base_sql(),
}
