"""Titles against the text seen on a frame."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(plain(text), " "), lambda w: w != ""))


def status(title: Column, lines: Column) -> Column:
    """visible: a line holds the title; candidate: a line of three words or more shares half the title's; else none."""
    own = words(title)
    held = F.exists(lines, lambda line: F.contains(plain(line), plain(title)))
    near = F.exists(lines, lambda line: (F.size(words(line)) >= 3) & (2 * F.size(F.array_intersect(own, words(line))) >= F.size(own)))
    return F.when(F.size(own) == 0, "none").when(held, "visible").when(near, "candidate").otherwise("none")


def preferred(title: Column, lines: Column) -> Column:
    """The longest seen line for a title that is only a candidate, the first of equals; else the title."""
    longest = F.element_at(F.array_sort(F.transform(lines, lambda line, i: F.struct((-F.length(line)).alias("n"), i.alias("i"), line.alias("line")))), 1)["line"]
    return F.when((status(title, lines) == "candidate"), longest).otherwise(title)


def years(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b((?:19|20)[0-9]{2})\b"), F.lit(1))))


def resolved(original: Column, automatic: Column) -> Column:
    """The original title, unless both name years and not the same ones."""
    clash = (F.size(years(original)) > 0) & (F.size(years(automatic)) > 0) & (years(original) != years(automatic))
    return F.when(clash, automatic).otherwise(original)


def value_label(value: Column, unit: Column) -> Column:
    """A value with its unit, dollars in front; whole numbers without a point."""
    number = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(F.round(value, 2).cast("string"))
    return F.when(unit == "$", F.concat(F.lit("$"), number)).otherwise(F.concat(number, F.coalesce(unit, F.lit(""))))
