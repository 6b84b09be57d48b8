"""Personal data in texts, disguised or not, as spans of the original characters."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back


KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Runs of these characters are tried from their first one only, which spares time and loses no match.
_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+-]){_MAIL.pattern}")
# A run of digits is a match's start or holds none, so the look-behind only spares time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Digit words of four languages: fixed values.
DIGITS = {
    **{w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())},
    **{w: str(i) for i, w in enumerate("cero uno dos tres cuatro cinco seis siete ocho nueve".split())},
    **{w: str(i) for i, w in enumerate("zéro un deux trois quatre cinq six sept huit neuf".split())},
    **{w: str(i) for i, w in enumerate("null eins zwei drei vier fünf sechs sieben acht neun".split())},
    "oh": "0",
}
#: Letters of other scripts that look like Latin ones, and what they look like: fixed values.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТУХЅІЈаеорсухіјѕԁһԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρυ",
        "ABEKMHOPCTYXSIJaeopcyxijsdhqw" + "ABEZHIKMNOPTYXaovpu",
        strict=True,
    )
)


def _one_to_one() -> dict[int, str]:
    """Characters to the one ASCII character each stands for: lookalikes, full-width and mathematical forms, digits of any script."""
    out = {ord(a): b for a, b in LOOKALIKES.items()}
    for start, end in ((0xFF01, 0xFF5F), (0x1D400, 0x1D800), (0x2070, 0x208A), (0x2460, 0x2469), (0x2024, 0x2025), (0xFE52, 0xFE70)):
        for c in range(start, end):
            plain = unicodedata.normalize("NFKC", chr(c))
            if len(plain) == 1 and plain != chr(c) and "!" <= plain <= "~":
                out[c] = plain
    for c in range(0x660, 0x11000):
        if unicodedata.category(chr(c)) == "Nd" and not 0xFF00 <= c <= 0xFFFF:
            out[c] = str(unicodedata.digit(chr(c)))
    out |= {c: "-" for c in (0x2010, 0x2011, 0x2012, 0x2013, 0x2212)}
    out |= {c: "." for c in (0x3002, 0xFF61)}
    return out


_PLAIN = _one_to_one()
_ODD = re.compile("[" + "".join(map(re.escape, map(chr, sorted(_PLAIN)))) + "]")

_WORD = "|".join(sorted(map(re.escape, DIGITS), key=lambda w: (-len(w), w)))
_SEP = r"[ \t,_-]{1,3}"
_DOTS = "dot|punkt|punto|point"
#: Last labels that let a spoken dot count as one: fixed values, with the two-letter country codes most in use.
_LAST = "com|org|net|edu|gov|info|biz|io|ai|co|uk|de|fr|es|eu|us|ca|ch|it|nl|be|pt|pl|ru|cn|jp|in|br|mx|test|example"

# Where a disguise may be. Each pattern starts at a character that a run of blanks can't hold, so a text is scanned once.
_GONE = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]+")
_BOXED = re.compile(rf"[\[({{<][ \t]*+(?:(?P<at>at|@|arroba|klammeraffe)|(?P<dot>{_DOTS}|\.))[ \t]*+[\])}}>]", re.IGNORECASE)
_ENTITY = re.compile(r"&(?:(?P<at>#0*+64;|#x0*+40;|commat;)|(?P<dot>#0*+46;|#x0*+2e;|period;))", re.IGNORECASE)
_SPOKEN = re.compile(rf"(?<=[A-Za-z0-9])[ \t]++(?:(?P<at>at|arroba)|(?P<dot>{_DOTS}))(?=[ \t])", re.IGNORECASE)
_PLUS = re.compile(rf"\bplus[ \t]++(?=(?:{_WORD}|[0-9])\b)", re.IGNORECASE)
_LIKE = re.compile(r"(?<=[0-9])[OoIl](?=[0-9])|(?<![A-Za-z0-9])[OoIl](?=[0-9]{2})|(?<=[0-9]{2})[OoIl](?![A-Za-z0-9])", re.IGNORECASE)
_SAID = re.compile(rf"\b(?:{_WORD})(?:{_SEP}(?:{_WORD}|[0-9]))*\b(?![A-Za-z])", re.IGNORECASE)
_DIGIT_WORD = re.compile(rf"{_WORD}|[0-9]", re.IGNORECASE)
_BLANKS = re.compile(r"[ \t]*+")

# What may stand between two of them.
_LABEL = re.compile("[A-Za-z0-9-]+")
_LABELS_OF = re.compile("[A-Za-z0-9.-]")
_MAILBOX = re.compile("[A-Za-z0-9_-]+")
_LABELS = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
_ENDS = re.compile(rf"(?:{_LAST})\b", re.IGNORECASE)
#: Any country's label, and a domain that has a last label already.
_COUNTRY = re.compile(r"[A-Za-z]{2}\b")
_ENDED = re.compile(rf"\.(?:{_LAST})\Z", re.IGNORECASE)
#: No domain is longer.
_DOMAIN_CHARS = 253
_WRITTEN = re.compile(rf"(?:[A-Za-z0-9-]++\.)+(?:{_LAST})\b", re.IGNORECASE)
#: A word before a plain `at` and a written domain that reads like a mailbox, not like prose: it holds a digit, dot or underscore.
_NAMED = re.compile(r"[A-Za-z0-9%+-]*[0-9._][A-Za-z0-9._%+-]*")
#: The article of French and Spanish, after a whole find and before a word: no digit of it.
_ARTICLE = re.compile(r"[ \t]+un(?=[ \t]+[^\W\d_])", re.IGNORECASE)


def _latin(text: str) -> bool:
    """Whether all characters are below 256: quicker to see than what the others are."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Mark(NamedTuple):
    """A place that may be rewritten; start and end include the blanks that go with it."""

    start: int
    end: int
    kind: str  # gone, at, dot, plus, like, said
    sure: bool  # whatever stands round it
    first: int  # where it begins without blanks


def _places(text: str) -> list[_Mark]:
    """All marks of a text, leftmost first; of two that overlap the earlier. Blanks may belong to two of them."""
    found: list[tuple[int, int, str, bool, bool]] = []  # first, last, kind, sure, with blanks
    if not text.isascii() and ("\xad" in text or not _latin(text)):
        found += [(*m.span(), "gone", True, False) for m in _GONE.finditer(text)]
    if any(b in text for b in "[({<"):
        found += [(*m.span(), m.lastgroup, True, True) for m in _BOXED.finditer(text)]
    if "&" in text:
        found += [(*m.span(), m.lastgroup, True, False) for m in _ENTITY.finditer(text)]
    found += [(m.start(m.lastgroup), m.end(), m.lastgroup, False, True) for m in _SPOKEN.finditer(text)]
    found += [(*m.span(), "plus", True, False) for m in _PLUS.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [(*m.span(), "like", True, False) for m in _LIKE.finditer(text)]
    found += [(*m.span(), "said", False, False) for m in _SAID.finditer(text)]
    found.sort(key=lambda f: f[0])
    marks, free = [], 0
    for first, last, kind, sure, blanks in found:
        if first < free:
            continue
        start, end = first, last
        if blanks:
            while start and text[start - 1] in " \t":
                start -= 1
            end = _BLANKS.match(text, last).end()
        marks.append(_Mark(start, end, kind, sure, first))
        free = last
    return marks


def _marks(text: str) -> list[_Mark]:
    """The marks that are disguises: one pass from the right for what follows, one from the left for digit words.

    A spoken dot counts before a last label, which may be any two letters
    where a sign or a certain `at` stands before the domain; between the labels of a spoken
    domain or mailbox, and before a digit. A spoken `at` counts before a
    domain with a disguised dot, or, after a mailbox, before a written one.
    Digit words count beside a digit, a digit word or another disguise.
    """
    marks = _places(text)
    n = len(marks)
    keep = [m.sure for m in marks]
    # Whether a dot's domain follows an @ or an at that is sure.
    certain, p = [False] * n, -1
    for i, m in enumerate(marks):
        if m.kind == "dot":
            certain[i] = _after_at(text, m.start, marks[p] if p >= 0 and (certain[p] or marks[p].kind == "at" and marks[p].sure) else None)
        if m.kind in ("at", "dot"):
            p = i
    # Of the next at or dot, j: whether it is a dot whose labels lead to a last label by spoken dots; one that ends a
    # domain; an at before a domain with a disguised dot; a spoken dot of a mailbox before such an at.
    j, ends, tail, domain, mailbox = n, False, False, False, False
    for i in range(n - 1, -1, -1):
        m = marks[i]
        if m.kind not in ("at", "dot"):
            continue
        stop = marks[j].start if j < n else len(text)
        if m.kind == "dot":
            last = not m.sure and bool(_ENDS.match(text, m.end) or certain[i] and _COUNTRY.match(text, m.end))
            box = (domain and not marks[j].sure or mailbox) and bool(_MAILBOX.fullmatch(text, m.end, stop))
            up = last or not m.sure and ends and not marks[j].sure and bool(_LABEL.fullmatch(text, m.end, stop))
            tail = last or m.sure and bool(_LABEL.match(text, m.end)) or tail and bool(_LABELS.fullmatch(text, m.end, stop))
            keep[i] = m.sure or up or box or bool(_DIGIT_WORD.match(text, m.end))
            ends, mailbox, domain = up, box and not m.sure, False
        else:
            domain = tail and bool(_LABELS.fullmatch(text, m.end, stop))
            keep[i] = m.sure or domain or text[m.first : m.first + 2].lower() == "at" and bool(_WRITTEN.match(text, m.end)) and _named(text, m.start)
            ends, tail, mailbox = False, False, False
        j = i
    for i, m in enumerate(marks):
        if m.kind == "said":
            before, after = marks[i - 1] if i else None, marks[i + 1] if i + 1 < n else None
            touches = before is not None and keep[i - 1] and before.end == m.start or after is not None and keep[i + 1] and after.start == m.end
            keep[i] = touches or _beside_number(text, m, before, after)
    return [m for m, k in zip(marks, keep) if k]


def _after_at(text: str, end: int, before: _Mark | None) -> bool:
    """Whether the labels that end here follow a mailbox and its @, or the mark given, and lack a last label."""
    start, least = end, max(0, end - _DOMAIN_CHARS)
    while start > least and _LABELS_OF.match(text, start - 1):
        start -= 1
    if start == end or _ENDED.search(text, start, end):
        return False
    return start > 1 and text[start - 1] == "@" and bool(_LOCAL.match(text, start - 2)) or before is not None and before.end == start


def _named(text: str, end: int) -> bool:
    """Whether the word that ends here reads like a mailbox."""
    start = end
    while start and _LOCAL.match(text, start - 1):
        start -= 1
    return bool(_NAMED.fullmatch(text, start, end)) and text[end - 1].isalnum()


def _beside_number(text: str, m: _Mark, before: _Mark | None, after: _Mark | None) -> bool:
    """Whether a run has two digit words, or the next letter or digit on a side is a digit or a digit word's."""
    if not text[m.start : m.end].isalpha():
        return True
    i = m.start - 1
    while i >= 0 and not text[i].isalnum():
        i -= 1
    if i >= 0 and (text[i].isdigit() or before is not None and before.kind == "said" and i < before.end):
        return True
    i = m.end
    while i < len(text) and not text[i].isalnum():
        i += 1
    return i < len(text) and (text[i].isdigit() or after is not None and after.kind == "said" and i >= after.start)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """The plain finds of each kind, leftmost and not overlapping within a kind; failing ones are dropped."""
    emails: list[Span] = []
    if "@" in text:
        found = _EMAIL.search(text)
        while found:
            emails.append(found.span())
            # A match may begin right behind another, in the middle of a run of such characters.
            found = _MAIL.match(text, found.end()) or _EMAIL.search(text, found.end())
    if not any(d in text for d in "0123456789"):
        return {"email": emails, "ip": [], "card": [], "phone": []}
    ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    cards = [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d)]
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15] if "+" in text else []
    return {"email": emails, "ip": ips, "card": cards, "phone": phones}


class _Tape:
    """A rewritten text with the source span of each of its pieces."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.at: list[int] = []  # where each piece starts in the result
        self.source: list[tuple[int, int, bool]] = []  # its source span; whether it is a copy
        self.size = 0

    def put(self, piece: str, start: int, end: int, copy: bool) -> None:
        if piece:
            self.parts.append(piece)
            self.at.append(self.size)
            self.source.append((start, end, copy))
            self.size += len(piece)

    def back(self, span: Span) -> tuple[int, int, bool]:
        """The source span of a span of the result; whether all of it is one copy."""
        i, j = bisect_right(self.at, span[0]) - 1, bisect_right(self.at, span[1] - 1) - 1
        (start, _, copied), (last, end, copied_too) = self.source[i], self.source[j]
        start += (span[0] - self.at[i]) * copied
        end = last + span[1] - self.at[j] if copied_too else end
        return start, end, i == j and copied


def rewrite(text: str) -> _Tape | None:
    """Undo at and dot disguises and spelled digits; lookalikes must be undone before. None where there is nothing to undo."""
    marks = _marks(text)
    if not marks:
        return None
    tape, done = _Tape(), 0
    for m in marks:
        start = max(m.start, done)
        tape.put(text[done:start], done, start, True)
        if m.kind == "said":
            for d in _DIGIT_WORD.finditer(text, m.start, m.end):
                tape.put(DIGITS.get(d[0].lower(), d[0]), d.start(), d.end(), False)
        elif m.kind == "like":
            tape.put("0" if text[m.start] in "Oo" else "1", m.start, m.end, False)
        else:
            tape.put({"gone": "", "at": "@", "dot": ".", "plus": "+"}[m.kind], start, m.end, False)
        done = m.end
    tape.put(text[done:], done, len(text), True)
    return tape


def _trimmed(text: str, start: int, end: int) -> Span:
    while start < end and text[start] in " \t":
        start += 1
    while end > start and text[end - 1] in " \t":
        end -= 1
    return start, end


def _past_article(text: str, end: int) -> int:
    found = _ARTICLE.match(text, end)
    return found.end() if found else end


def find_pii(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base, all) spans by kind, in code points, ends exclusive.

    base: plain finds. all: those, and finds in the text after the
    transducers (lookalike characters, then zero-width characters, at and dot
    disguises and digit words), mapped back to the characters they came from.
    A mapped find inside a base span of its kind adds nothing.
    """
    text = text or ""
    base = base_spans(text)
    plain = text if text.isascii() or _latin(text) or not _ODD.search(text) else text.translate(_PLAIN)
    tape = rewrite(plain)
    if plain is text and tape is None:
        return base, base
    found = base_spans("".join(tape.parts) if tape else plain)
    both = {}
    for kind in KINDS:
        spans, starts = set(base[kind]), [a for a, _ in base[kind]]
        for span in found[kind]:
            start, end = _trimmed(text, *(tape.back(span)[:2] if tape else span))
            at = bisect_right(starts, start) - 1
            a, b = base[kind][at] if at >= 0 else (0, 0)
            inside = start >= a and end <= b or start == a and end == _past_article(text, b)
            if start < end and not inside:
                spans.add((start, end))
        both[kind] = sorted(spans)
    return base, both


def detect_pii(docs: DataFrame, text: str = "text", to: str = "pii", redact: bool = False) -> DataFrame:
    """docs with `to`, a struct (base, spans, redacted).

    base and spans are arrays of (kind, start, end), by kind in the order of
    KINDS, then start; code points, ends exclusive. redacted, null unless
    asked for, has each run of overlapping spans replaced by the kind of its
    first, as [EMAIL]. Null texts count as empty and stay null in redacted;
    texts of any length are read whole, in time in proportion to it; repeated
    rows are found in each row; an empty table gives no rows. All columns of
    docs stay as they are; `to` must be none of them.
    """
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField("base", span), T.StructField("spans", span), T.StructField("redacted", T.StringType())])

    @F.pandas_udf(schema)
    def look(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            rows = []
            for value in part:
                base, both = find_pii(value)
                flat = [[{"kind": k, "start": a, "end": b} for k in KINDS for a, b in found[k]] for found in (base, both)]
                rows.append((*flat, masked(value, both) if redact else None))
            yield pd.DataFrame(rows, columns=["base", "spans", "redacted"])
        give_back()

    return docs.select("*", look(F.col(text)).alias(to))


def masked(text: str | None, spans: dict[str, list[Span]]) -> str | None:
    if text is None or not any(spans.values()):
        return text
    out, done = [], 0
    for start, end, kind in sorted((a, -b, k) for k in KINDS for a, b in spans[k]):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, -end)
    return "".join(out) + text[done:]
