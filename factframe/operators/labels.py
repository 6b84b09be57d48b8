"""Labels that name the same thing, and other names of entities in texts."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the aliases that one automaton, and one reading of the texts, takes.
ALIAS_CHARS = 2_000_000
_FOUND = "array<struct<alias: string, at: bigint>>"


def words(label: Column) -> Column:
    """The distinct words of a label, lower-cased, in order; null has none."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(F.coalesce(label, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")))


def _word_sets(labels: DataFrame, label: str) -> DataFrame:
    return labels.select(words(F.col(label)).alias("words")).where(F.size("words") > 0).distinct()


def _within(small: DataFrame, large: DataFrame) -> DataFrame:
    """(small, large): word sets of one side all of whose words are in one of the other.

    A set goes to the sets that hold its rarest word, a word that no other
    set has being rarest of all and making no pairs, and is checked there.
    """
    holders = large.select(F.col("words").alias("large"), F.explode("words").alias("word"))
    counts = holders.groupBy("word").agg(F.count("*").alias("n"))
    each = small.select(F.col("words").alias("small"), F.explode("words").alias("word")).join(counts, "word", "left")
    rare = each.groupBy("small").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("word"), F.count_if(F.col("n").isNull()).alias("unknown"))
    return rare.where("unknown = 0").join(holders, "word").where(F.size(F.array_except("small", "large")) == 0).select("small", "large")


def matching(left: DataFrame, right: DataFrame, own: str, other: str) -> DataFrame:
    """(own, other): pairs of distinct labels of two tables that match: all words of one are among the other's.

    Words are runs of a-z and 0-9 of the lower-cased label; a label without
    any matches nothing. Labels meet over an index of words, by the rarest of
    each, in both directions, and labels of equal words are one entry of it.
    """
    a, b = _word_sets(left, own), _word_sets(right, other)
    pairs = _within(a, b).select(F.col("small").alias("a"), F.col("large").alias("b"))
    more = _within(b, a).where(F.size("small") < F.size("large")).select(F.col("large").alias("a"), F.col("small").alias("b"))
    named = lambda rows, label, to: rows.where(F.col(label).isNotNull()).select(words(F.col(label)).alias(to), F.col(label)).distinct()
    return pairs.unionByName(more).join(named(left, own, "a"), "a").join(named(right, other, "b"), "b").select(own, other)


def mentioned(texts: DataFrame, text: str, aliases: DataFrame, entity: str = "entity", alias: str = "alias") -> DataFrame:
    """texts with (entity, alias, at) of each alias that they hold, `at` being the place, from 1, of its first occurrence.

    aliases: (entity, alias), a table; texts are lower-cased and aliases are
    searched as they are, anywhere, overlapping ones too. Distinct aliases of
    up to ALIAS_CHARS make one Aho-Corasick automaton, with which a text is
    read once; more are dealt into as many parts as it takes, and the texts
    read once for each. Null and empty aliases are nowhere; an alias of
    several entities is found once and gives a row for each of them.
    """
    known = aliases.where(F.length(alias) > 0).select(F.col(entity).alias("entity"), F.col(alias).alias("alias")).distinct()
    names = known.select("alias").distinct()
    size = names.agg(F.sum(F.length("alias"))).first()[0] or 0
    parts = max(1, -(-size // ALIAS_CHARS))
    found = None
    for n in range(parts):
        some = names if parts == 1 else names.where(F.pmod(F.xxhash64("alias"), F.lit(parts)) == n)
        part = texts.withColumn("m", F.explode(_first_places(texts, text, [r[0] for r in some.collect()]))).select(*texts.columns, "m.*")
        found = part if found is None else found.unionByName(part)
    return found.join(known, "alias").select(*texts.columns, "entity", "alias", "at")


class _Names:
    def __init__(self, names: list[str]):
        self.names, self.made = names, None

    def automaton(self) -> ahocorasick.Automaton | None:
        """Made once in each worker."""
        if self.made is None and self.names:
            self.made = ahocorasick.Automaton()
            for name in self.names:
                self.made.add_word(name, name)
            self.made.make_automaton()
        return self.made


def _first_places(texts: DataFrame, text: str, names: list[str]) -> Column:
    shared = texts.sparkSession.sparkContext.broadcast(_Names(names))

    @F.arrow_udf(_FOUND)
    def look(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = shared.value.automaton()
        kind = pa.list_(pa.struct([("alias", pa.string()), ("at", pa.int64())]))
        for part in parts:
            rows = []
            for value in part:
                first: dict[str, int] = {}
                if automaton is not None and value.is_valid:
                    for end, name in automaton.iter(value.as_py()):
                        first.setdefault(name, end - len(name) + 2)
                rows.append([{"alias": name, "at": at} for name, at in first.items()])
            yield pa.array(rows, kind)

    return look(F.lower(text))
