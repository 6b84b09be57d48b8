"""Column functions over labels, numbers in text, units and times."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number words and their values: fixed values.
NUMBER_WORDS = {
    **{w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())},
    **{w: 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)},
}
#: Units in the order in which they are looked for: the pattern that shows them in a lower-case text, and a number's suffix that does. Fixed values.
UNITS = [
    ("%", "%|percent", None), ("$", r"\$|dollar|usd", None), ("miles", "mile", None), ("km", r"\bkm\b", None), ("day", "day", None), ("years", "year", None),
    ("million", "million", "m"), ("billion", "billion", "bn"), ("thousand", "thousand", "k"),
]


#: The forms of units that may follow a figure: fixed values.
UNIT_FORMS = {
    "%": ["%", "percent"], "$": ["$", "usd", "dollar", "dollars"], "miles": ["mile", "miles"], "km": ["km"], "day": ["day", "days"], "years": ["year", "years"],
    "million": ["million", "m"], "billion": ["billion", "bn"], "thousand": ["thousand", "k"],
}


def one_of(words: Iterable[str]) -> str:
    """A pattern of alternatives, a longer one before those that it begins with."""
    return "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))


#: A figure: digits, then threes of them behind commas, then a fraction.
FIGURE = "-?[0-9]+" + "(?:,[0-9]{3})*" + "(?:[.][0-9]+)?"
#: A figure that goes on no word or number, as group 1, and the unit right behind it as group 2.
NUMBER = f"(?:^|[^\\w.])({FIGURE})(\\s*(?:{one_of(f for forms in UNIT_FORMS.values() for f in forms)}))?"


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def slug(x: Column, none: str = "unknown") -> Column:
    """Lower-case letters and digits joined by dashes; `none` where nothing is left."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), F.lit("-")), F.lit("")), F.lit(none))


def numeric_value(x: Column) -> Column:
    """The first number of a text; without one, its first number in words; null without any."""
    digits = F.nullif(F.regexp_replace(F.regexp_extract(x, NUMBER, 1), ",", ""), F.lit("")).try_cast("double")
    # Words and what lies between them, in turn; the first that is a number counts, and one below ten that follows it.
    pieces = F.regexp_extract_all(F.lower(x), F.lit(r"\w+|\W+"), F.lit(0))
    table = F.create_map(*[F.lit(v) for w, n in NUMBER_WORDS.items() for v in (w, float(n))])
    worth = lambda at: F.try_element_at(table, F.get(pieces, at))
    at = F.array_position(F.transform(pieces, lambda p: F.try_element_at(table, p).isNotNull()), F.lit(True)).cast("int") - 1
    more = F.when(F.get(pieces, at + 1).rlike(r"^[-\s]+$") & (worth(at + 2) < 10), worth(at + 2))
    return F.coalesce(digits, F.when(at >= 0, worth(at) + F.coalesce(more, F.lit(0.0))))


def infer_unit(*texts: Column) -> Column:
    """The first unit that the first of the texts shows which shows any; null without one.

    A text is lowered once and searched once for all units; the order in UNITS decides between those found.
    """

    def shown(x: Column) -> Column:
        low = F.lower(x)
        suffix = F.trim(F.regexp_extract(low, NUMBER, 2))
        holds = lambda u: low.rlike(u[1]) | (suffix == u[2]) if u[2] else low.rlike(u[1])
        first = reduce(lambda out, u: out.when(holds(u), u[0]), UNITS[1:], F.when(holds(UNITS[0]), UNITS[0][0]))
        return F.when(low.rlike("|".join(u[1] for u in UNITS)) | suffix.isin([u[2] for u in UNITS if u[2]]), first)

    return F.coalesce(*map(shown, texts))


def tick_value(x: Column) -> Column:
    """An axis label as a number, k, m and b scaling it; null where it is none."""
    plain = F.lower(F.regexp_replace(F.trim(x), r"[$€£,\s]", ""))
    scale = F.create_map(*[F.lit(v) for v in ("", 1.0, "%", 1.0, "k", 1e3, "m", 1e6, "b", 1e9)])
    parts = r"^([-+]?[0-9]+(?:\.[0-9]+)?)([kmb%]?)$"
    return F.when(plain.rlike(parts), F.regexp_extract(plain, parts, 1).cast("double") * F.element_at(scale, F.regexp_extract(plain, parts, 2)))


def parse_time(x: Column) -> Column:
    """Seconds of `s`, `m:s` and `h:m:s`; null for anything else, fractions alone included."""
    text = F.trim(x)
    parts = F.split(text, ":")
    part = lambda i: F.get(parts, i).try_cast("double")
    return (
        F.when(text.rlike("^[0-9]+$"), text.try_cast("double"))
        .when(F.size(parts) == 2, part(0) * 60 + part(1))
        .when(F.size(parts) == 3, part(0) * 3600 + part(1) * 60 + part(2))
    )


def format_time(seconds: Column) -> Column:
    """HH:MM:SS of whole seconds, half to even; empty for null."""
    s = F.rint(seconds).cast("long")
    return F.coalesce(F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60), F.lit(""))


def stamp(seconds: Column, mark: str = ",") -> Column:
    """HH:MM:SS,mmm of non-negative seconds, for subtitles."""
    ms = F.round(F.greatest(seconds, F.lit(0.0)) * 1000).cast("long")
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(ms / 3600000), F.floor(ms % 3600000 / 60000), F.floor(ms % 60000 / 1000), ms % 1000)


def video_id(url: Column) -> Column:
    """The path of a short link, else the v parameter, else the last part of the path."""
    short = F.regexp_extract(url, r"youtu\.be/([^?&/]+)", 1)
    return F.coalesce(F.nullif(short, F.lit("")), F.nullif(F.regexp_extract(url, r"[?&]v=([^&#]+)", 1), F.lit("")), F.regexp_extract(url, r"([^/?#]+)/?(?:[?#].*)?$", 1))


def clamp(x: Column, low: float = 0.0, high: float = 1.0, default: float = 0.0) -> Column:
    return F.least(F.greatest(F.coalesce(x, F.lit(default)), F.lit(low)), F.lit(high))


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x1, y1, x2, y2); 0 where neither has an area."""
    across = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    down = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    both = area(a) + area(b) - across * down
    return F.when(both > 0, across * down / both).otherwise(0.0)


def labels_match(a: Column, b: Column) -> Column:
    """Whether the words of one label are all among the other's."""
    words = lambda x: F.array_distinct(F.filter(F.split(F.lower(x), "[^a-z0-9]+"), lambda w: w != ""))
    return (F.size(F.array_except(words(a), words(b))) == 0) | (F.size(F.array_except(words(b), words(a))) == 0)


def year_in(text: Column) -> Column:
    """The first four digits of a text that read like a year of 1900 to 2099."""
    return F.nullif(F.regexp_extract(text, "(?:19|20)[0-9]{2}", 0), F.lit("")).try_cast("int")


def fiscal_label(year: Column) -> Column:
    """A fiscal year by its first year, as 2007-08."""
    return F.format_string("%d-%02d", year, (year + 1) % 100)


def xml_escaped(text: Column) -> Column:
    """Text for XML content and attributes."""
    for plain, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        text = F.replace(text, F.lit(plain), F.lit(name))
    return text


def data_uri(content: Column, kind: str) -> Column:
    """Bytes as a base64 data URI."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))


def png_size(content: Column) -> Column:
    """(width, height) from the header of a PNG; null for anything else."""
    number = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int")
    is_png = F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A"
    return F.when(is_png & (F.octet_length(content) >= 24), F.struct(number(17).alias("width"), number(21).alias("height")))


def without_suffix(text: Column, suffixes: list[str]) -> Column:
    """Text without the first of the suffixes that it ends in, and without blanks before that."""
    return F.trim(F.regexp_replace(text, r"(?i)\s*(?:" + "|".join(suffixes) + r")\s*$", ""))


def kept(flag: Column) -> Column:
    """A flag that keeps a row unless it says no."""
    return F.coalesce(flag, F.lit(True))


def any_filled(*columns: Column) -> Column:
    """Whether any of the columns is neither null nor empty."""
    return reduce(lambda a, b: a | b, [F.coalesce(c.cast("string") != "", F.lit(False)) for c in columns])


def guarded(path: Column, *parts: str) -> Column:
    """A path, which raises an error if one of its parts is among those given."""
    bad = F.arrays_overlap(F.split(path, r"[/\\\\]"), F.array(*map(F.lit, parts)))
    return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.concat(F.lit("not a visual source: "), path)).cast("string")).otherwise(path)


#: Chart families: a type and its processor. Fixed values.
FAMILIES = {
    "bar": "bar", "combined": "bar", "line": "line", "area": "line", "timeline": "line", "pie": "pie", "donut": "pie",
    "map": "map", "pictograph": "pictograph", "treemap": "treemap", "scatter": "scatter", "sankey": "sankey",
}


def dispatch(declared: Column, recovered: Column) -> Column:
    """(processor, declared_type, consistent): a recovered type of a known family decides, else the declared one."""
    plain = lambda x: F.lower(F.trim(F.coalesce(x, F.lit(""))))
    table = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])
    family = lambda x: F.coalesce(F.try_element_at(table, plain(x)), F.lit("unknown"))
    processor = F.when(family(recovered) != "unknown", family(recovered)).otherwise(family(declared))
    same = (processor == "unknown") | (plain(recovered) == "") | (family(declared) == processor)
    return F.struct(processor.alias("processor"), plain(declared).alias("declared_type"), same.alias("consistent"))
