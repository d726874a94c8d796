"""Personal data in disguise: an offset-preserving transducer normalises a text, detectors run on the result, and
the spans found there are mapped back to the characters of the source."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like Latin ones, each above its double.
_ALIKE = str.maketrans(
    "аеорсухіјѕԁԛԝһҮАВЕКМНОРСТХІЈЅ" "αονρτικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdqwhYABEKMHOPCTXIJS" "aovptikABEZHIKMNOPTYX",
)
# Digits spelled in English.
_DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
# Endings by which "x at y.z" is told from prose, and words before its at that are prose all the same.
_ENDINGS = "com|org|net|edu|gov|info|biz|io|dev|app|co|eu|uk|us|ca|au|de|fr|es|it|nl|ch|at|be|se|pl|pt|br|mx|jp|cn|in|ru"
_PROSE_AT = frozenset(
    """look looks looked looking us me you it them him her here there found find available online more info information
    visit see site website page blog store shop is are was were be been am read learn live hosted posted published listed
    join meet located sold seen and or start starts work works worked working stay buy not only""".split()
)
# Frequent words, none of them an ending, behind which "y dot z" is prose.
_PROSE = (
    "a|an|the|this|that|these|those|he|she|we|they|them|their|its|his|her|our|your|of|on|or|if|up|go|and|but|for|not|nor|"
    "was|were|are|has|had|have|will|would|could|should|can|with|from|into|than|then|there|when|where|while|what|which|"
    "who|why|well|also|just|very|after|before|because|only|some|even|still|again|too|yet|over|however|please|thanks"
)
# Other signs for at and full stop, and characters without width.
_AT_SIGNS, _STOPS, _NO_WIDTH = "﹫＠", "․﹒．。｡", "\u00ad\u200b\u200c\u200d\u2060\ufeff"


class Span(NamedTuple):
    kind: str
    start: int
    end: int


_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with a domain behind it, and the characters of the local part before it; linear in the text."""
    free = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            free = m.end()


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def detect(text: str) -> list[Span]:
    """The base rules: leftmost non-overlapping matches of each kind, those that fail their test dropped."""
    found = []
    if "@" in text:
        found += [Span("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append(Span("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _only_digits(m[0])) <= 19 and _luhn(digits):
            found.append(Span("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_only_digits(m[0])) <= 15:
                found.append(Span("phone", m.start(), m.end()))
    return found


_DIGIT = "|".join(_DIGITS)
_GAP = r"[ \t-]{1,3}"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_SPELLED_DOT = r"(?:[ \t](?i:dot)[ \t]|[ \t]{0,3}[\[({<][ \t]{0,3}(?i:dot|\.)[ \t]{0,3}[\])}>][ \t]{0,3})"
#: What makes a spelled at part of an address: a domain with a spelled dot, real ones mixed in, and any ending that is
#: not prose; or, behind a word that is not prose, one with real dots alone and a known ending.
_DOTTED = (
    rf"{_LABEL}(?:\.{_LABEL}){{0,8}}{_SPELLED_DOT}(?:{_LABEL}(?:\.|{_SPELLED_DOT})){{0,8}}(?!(?i:{_PROSE})\b)[A-Za-z]{{2,24}}(?![A-Za-z0-9])"
)
_SITE = rf"{_LABEL}(?:\.{_LABEL}){{0,8}}\.(?i:{_ENDINGS})(?![A-Za-z0-9-]|\.[A-Za-z0-9])"
#: What the transducer rewrites, in order of preference. A spelled number has two digits or more, or stands beside
#: a spelled dot, a digit or a plus.
_RULES = re.compile(
    rf"""(?P<spelled>(?i:\b(?:{_DIGIT})(?:{_GAP}(?:{_DIGIT}))+\b
        |\b(?:{_DIGIT})(?=[ \t]dot[ \t])|(?<=[ \t]dot[ \t])(?:{_DIGIT})\b
        |\b(?:{_DIGIT})(?={_GAP}[0-9])|(?:(?<=[0-9][ \t-])|(?<=[0-9][ \t-]{{2}})|(?<=[0-9][ \t-]{{3}}))(?:{_DIGIT})\b
        |(?:(?<=\+)|(?<=\+[ \t])|(?<=\bplus[ \t]))(?:{_DIGIT})\b))
    |(?P<at>[ \t]{{0,3}}[\[({{<][ \t]{{0,3}}(?i:at)[ \t]{{0,3}}[\])}}>][ \t]{{0,3}})
    |(?P<dot>[ \t]{{0,3}}[\[({{<][ \t]{{0,3}}(?i:dot|\.)[ \t]{{0,3}}[\])}}>][ \t]{{0,3}})
    |(?P<address>[ \t](?i:at)[ \t](?={_DOTTED}))
    |(?P<site>[ \t](?i:at)[ \t](?={_SITE}))
    |(?P<plain>(?<=[A-Za-z0-9])[ \t](?i:dot)[ \t](?=[A-Za-z0-9])
        (?!(?i:{_PROSE})\b(?!\.[A-Za-z0-9]|@|{_SPELLED_DOT}|[ \t]?[\[({{<]|[ \t](?i:at)[ \t])))
    |(?P<plus>\b(?i:plus)[ \t](?=(?i:{_DIGIT}|[0-9])))
    |(?P<width>[{_NO_WIDTH}]+)
    |(?P<sign>[{_AT_SIGNS}{_STOPS}])
    |(?P<alike>[\u0370-\u03ff\u0400-\u052f\uff01-\uff5e])""",
    re.VERBOSE,
)
#: No rule applies to a text in which this finds nothing; far cheaper than trying every rule at every character.
_HINT = re.compile(
    rf"[{_NO_WIDTH}{_AT_SIGNS}{_STOPS}\u0370-\u03ff\u0400-\u052f\uff01-\uff5e]"
    rf"|[\[({{<][ \t]{{0,3}}(?i:at|dot|\.)[ \t]{{0,3}}[\])}}>]|[ \t](?i:dot)[ \t]|[ \t](?i:at)[ \t]{_LABEL}\.[A-Za-z0-9]"
    rf"|\b(?i:{_DIGIT}){_GAP}(?i:{_DIGIT}|[0-9])|[0-9]{_GAP}(?i:{_DIGIT})\b|\+[ \t]?(?i:{_DIGIT})\b"
    rf"|\b(?i:plus)[ \t](?i:{_DIGIT}|[0-9])"
)


_WORD_BEFORE = re.compile(r"[A-Za-z0-9._%+-]+$")


def _single(char: str) -> str:
    if char in _AT_SIGNS:
        return "@"
    if char in _STOPS:
        return "."
    if "\uff01" <= char <= "\uff5e":  # full-width forms stand in the order of ASCII
        return chr(ord(char) - 0xFEE0)
    return char.translate(_ALIKE)


#: How a segment of a normalised text came about.
COPIED, CHARACTERS, WORDS = 0, 1, 2


class Normalised(NamedTuple):
    """A normalised text and, segment by segment, where it comes from."""

    text: str
    starts: list[int]
    sources: list[tuple[int, int, int]]

    def source(self, start: int, end: int) -> tuple[int, int, int]:
        """The source span of a normalised one, and the most that was rewritten in it: nothing, characters or
        words. A rewritten segment counts whole; copied characters map one to one."""
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        a, _, changed = self.sources[first]
        begin = a if changed else a + start - self.starts[first]
        a, b, changed = self.sources[last]
        finish = b if changed else a + end - self.starts[last]
        return begin, finish, max(s[2] for s in self.sources[first : last + 1])


def normalise(text: str) -> Normalised | None:
    """The text with disguises undone, or None if it has none."""
    if not _HINT.search(text):
        return None
    parts, starts, sources, at, length, changed = [], [], [], 0, 0, False

    def put(piece: str, a: int, b: int, rewritten: int) -> None:
        nonlocal length
        if piece:
            parts.append(piece)
            starts.append(length)
            sources.append((a, b, rewritten))
            length += len(piece)

    for m in _RULES.finditer(text):
        kind, piece = m.lastgroup, m[0]
        if kind == "spelled":
            new = "".join(_DIGITS[w] for w in re.split(_GAP, piece.lower()))
        elif kind == "site" and (before := _WORD_BEFORE.search(text, max(0, m.start() - 64), m.start())) and before[0].lower() in _PROSE_AT:
            continue
        elif kind in ("at", "address", "site"):
            new = "@"
        elif kind in ("dot", "plain"):
            new = "."
        elif kind == "plus":
            new = "+"
        elif kind == "width":
            new = ""
        else:
            new = _single(piece)
            if new == piece:
                continue
        put(text[at : m.start()], at, m.start(), COPIED)
        put(new, m.start(), m.end(), CHARACTERS if kind in ("width", "sign", "alike") else WORDS)
        at, changed = m.end(), True
    if not changed:
        return None
    put(text[at:], at, len(text), COPIED)
    return Normalised("".join(parts), starts, sources)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    return start, end


def find(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans and those that only the normalised text shows.

    These overlap no base span of their kind, but for one that they wholly hold (a mail address whose first letters
    or words only are disguised). A disguised span starts and ends at characters of the source; where characters without width were dropped
    inside of it, it covers them.
    """
    base = detect(text)
    plain = normalise(text)
    if plain is None:
        return base, []
    added = []
    for kind, start, end in detect(plain.text):
        a, b, rewritten = plain.source(start, end)
        dropped = b - a != end - start
        a, b = _trimmed(text, a, b)

        def clear(s: Span) -> bool:
            inside = a <= s.start and s.end <= b and b - a > s.end - s.start
            return s.kind != kind or s.end <= a or s.start >= b or inside

        if (rewritten or dropped) and all(map(clear, base)):
            added.append(Span(kind, a, b))
    return base, added


def _order(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s.start, KINDS.index(s.kind), s.end))


_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
FOUND = T.StructType([T.StructField("base", _SPANS), T.StructField("spans", _SPANS)])


@F.pandas_udf(FOUND)
def _found(texts: pd.Series) -> pd.DataFrame:
    base, every = [], []
    for text in texts:
        plain, added = find(text) if isinstance(text, str) else ([], [])
        base.append([s._asdict() for s in _order(plain)])
        every.append([s._asdict() for s in _order(plain + added)])
    return pd.DataFrame({"base": base, "spans": every})


def find_pii(docs: DataFrame, into: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``into``: ``base`` and all ``spans``, each (kind, start, end) in code points.

    No shuffle. A null or empty text has no spans, repeated rows are judged alike, other columns are kept, a
    column of the name ``into`` is replaced.
    """
    return docs.withColumn(into, _found(F.col("text")))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in order."""
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark = F.when(span["start"] >= state["at"], F.concat(F.lit("<"), span["kind"], F.lit(">"))).otherwise("")
        return F.struct(
            F.concat(state["out"], gap, mark).alias("out"), F.greatest(state["at"], span["end"]).alias("at")
        )

    done = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind; rows and columns as they are."""
    name = "_pii"
    while name in docs.columns:
        name = f"_{name}"
    found = find_pii(docs, name).withColumn("text", masked(F.col("text"), F.col(name)["spans"]))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
