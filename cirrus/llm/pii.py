"""Personal data, also where it is disguised; spans refer to the source text.

Identifiers are first found in the text as it is.  Then a chain of transducers
rewrites homoglyphs, invisible characters, spelled digits and at/dot disguises
while it keeps, for every character it makes, the source span it came from.
What is found in the rewritten text and was changed on the way is mapped back
and added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import id_text

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, kind, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits can only match from its start, so the rest of it is not tried.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches: a match can only begin where the run of local
    characters before an @ begins, or where the last match ended."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, 0, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def find(text: str) -> list[Span]:
    """Spans in the text as it is, by start and kind; failing matches are dropped."""
    out: list[Span] = []
    if "@" in text:
        out += _emails(text)
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


class Mapped:
    """A rewritten text; character i came from source[starts[i]:ends[i]]."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> None:
        self.text = text
        self.starts = np.arange(len(text)) if starts is None else starts
        self.ends = np.arange(1, len(text) + 1) if ends is None else ends

    def rewritten(self, pattern: re.Pattern, make: Callable[[re.Match], str | None]) -> "Mapped":
        """Replace each match by what ``make`` gives (None: leave it); every
        character made comes from the whole of the match, evenly shared."""
        texts, starts, ends, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = make(m)
            if new is None:
                continue
            a, b = m.span()
            texts += [self.text[done:a], new]
            at = a + np.arange(len(new) + 1) * (b - a) // max(1, len(new))
            starts += [self.starts[done:a], self.starts[at[:-1]]]
            ends += [self.ends[done:a], self.ends[np.maximum(at[1:], at[:-1] + 1) - 1]]
            done = b
        if not texts:
            return self
        return Mapped(
            "".join([*texts, self.text[done:]]),
            np.concatenate([*starts, self.starts[done:]]),
            np.concatenate([*ends, self.ends[done:]]),
        )


# Letters of other scripts that look like Latin ones, and signs
# that look like @, full stop, plus and hyphen.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I",
    "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "α": "a", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "﹫": "@", "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "−": "-", "﹣": "-", "﹢": "+",
}
# Characters that show nothing.
INVISIBLE = "­​‌‍‎‏⁠⁡⁢⁣⁤﻿"
# Spelled digits, and words that repeat the digit after them.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
}
REPEATS = {"double": 2, "triple": 3}
# Endings that a spelled-out or spaced-out domain must have.
ENDINGS = "com net org edu gov mil info biz io co dev app ai uk de fr es eu ca au jp br nl ch example test".split()


def _lookalike(c: str) -> str:
    """ASCII for a look-alike, full-width form or digit of another script."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    return c


_ODD = re.compile("[" + re.escape("".join(LOOKALIKES) + INVISIBLE) + "！-～]|[^\\W\\x00-\\x7f](?<=\\d)")
_WORD = "|".join(DIGIT_WORDS)
_SPELLED = re.compile(
    rf"(?:\bplus[\s-]+)?(?<![A-Za-z0-9])(?:(?:{'|'.join(REPEATS)})[\s-]+)?(?:{_WORD}|[0-9]+)"
    rf"(?:(?:[\s,-]{{1,2}}|\s+dot\s+)(?:(?:{'|'.join(REPEATS)})[\s-]+)?(?:{_WORD}|[0-9]+)(?![A-Za-z]))*(?![A-Za-z])",
    re.I,
)
_TOKEN = re.compile(rf"plus|dot|{'|'.join(REPEATS)}|{_WORD}|[0-9]+", re.I)
_ANY_WORD = re.compile(rf"\b(?:{_WORD})\b", re.I)
_TLD = "|".join(ENDINGS)
# A run of blanks is entered at its start only, and chains are read whole, so that every pattern is linear.
_DOT_MARK = re.compile(r"(?:(?<!\s)\s+)?[(\[{<]\s*(?:dot|punkt|point|punto|\.)\s*[)\]}>]\s*", re.I)
_DOT_WORD = re.compile(r"(?<=[A-Za-z0-9])\s+(?:dot|\.)\s+", re.I)
_LABELS = re.compile(r"(?<![A-Za-z0-9-])[A-Za-z0-9-]++(?:(?:\s+dot\s+|\s*\.\s*)[A-Za-z0-9-]++)*+", re.I)
_LABEL = re.compile(rf"(?:^|\s+dot\s+|\s*\.\s*)((?:{_TLD})\b)?[A-Za-z0-9-]*+", re.I)
_LOCAL_DOT = re.compile(r"(?<=[A-Za-z0-9])\s+dot\s+", re.I)
_LOCALS = re.compile(r"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]++(?:\s+dot\s+[A-Za-z0-9_%+-]++)*+", re.I)
_NUMBER_DOT = re.compile(r"(?<=[0-9])\s*(?:\bdot\b|\s\.)\s*(?=[0-9])", re.I)
_AT_MARK = re.compile(r"(?:(?<!\s)\s+)?[(\[{<]\s*(?:at|arroba|@)\s*[)\]}>]\s*", re.I)
_AT_SIGN = re.compile(r"(?<=[A-Za-z0-9])(?:\s+@\s*|\s*@\s+)(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")


_AT_WORD = re.compile(rf"(?<=[A-Za-z0-9])\s+at\s+(?=([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:{_TLD})\b))", re.I)


def _bare_at(m: "Mapped") -> Callable[[re.Match], str | None]:
    """@ for a bare "at", but only before a domain that was itself disguised."""

    def make(x: re.Match) -> str | None:
        a, b = x.span(1)
        return "@" if int(m.ends[b - 1]) - int(m.starts[a]) != b - a else None

    return make


def _dots(borders: list[tuple[int, int]]) -> Callable[[re.Match], str | None]:
    """A dot for a match inside one of the stretches (start, end), which ascend."""
    at = 0

    def make(x: re.Match) -> str | None:
        nonlocal at
        while at < len(borders) and borders[at][1] < x.end():
            at += 1
        return "." if at < len(borders) and borders[at][0] <= x.start() else None

    return make


def _domains(text: str) -> list[tuple[int, int]]:
    """From the start of each chain of labels to the start of its last known ending."""
    out = []
    for chain in _LABELS.finditer(text):
        last = [x.start(1) for x in _LABEL.finditer(chain.group()) if x.group(1)]
        if last and last[-1] > 0:
            out.append((chain.start(), chain.start() + last[-1]))
    return out


def _local_parts(text: str) -> list[tuple[int, int]]:
    """Chains of words joined by "dot" that end at an @."""
    return [x.span() for x in _LOCALS.finditer(text) if text[x.end() : x.end() + 1] == "@"]


def _digits(m: re.Match) -> str | None:
    """Digits of a run with at least three spelled ones."""
    if len(_ANY_WORD.findall(m.group())) < 3:
        return None
    out, times = "", 1
    for t in _TOKEN.findall(m.group()):
        t = t.lower()
        if t == "plus":
            out += "+"
        elif t == "dot":
            out += "."
        elif t in REPEATS:
            times = REPEATS[t]
        else:
            out += DIGIT_WORDS.get(t, t) * times
            times = 1
    return out


def rewrite(text: str) -> Mapped:
    """The text after all transducers; the same text if none applies."""
    m = Mapped(text)
    if not text.isascii():
        m = m.rewritten(_ODD, _one_sign)
    low = m.text.lower()
    if sum(map(low.count, DIGIT_WORDS)) >= 3 and _ANY_WORD.search(low):
        m = m.rewritten(_SPELLED, _digits)
    dotted = "dot" in low or " ." in low or any(x in low for x in ("punkt", "punto", "point", "[.", "(.", "{.", "<."))
    if dotted:
        m = m.rewritten(_DOT_MARK, lambda _: ".")
        m = m.rewritten(_DOT_WORD, _dots(_domains(m.text))).rewritten(_NUMBER_DOT, lambda _: ".")
        m = m.rewritten(_AT_WORD, _bare_at(m))
    if "@" in low or _AT_MARK.search(low):
        m = m.rewritten(_AT_MARK, lambda _: "@").rewritten(_AT_SIGN, lambda _: "@")
    if dotted and "@" in m.text:
        m = m.rewritten(_LOCAL_DOT, _dots(_local_parts(m.text)))
    return m


def _one_sign(m: re.Match) -> str:
    c = m.group()
    if c in INVISIBLE:
        return ""
    made = _lookalike(c)
    return str(int(c)) if made == c and c.isdecimal() else made


def find_disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only show after rewriting, as spans of ``text``."""
    m = rewrite(text)
    if m.text is text or m.text == text:
        return []
    known, out = set(base), set()
    for s, kind, e in find(m.text):
        a, b = int(m.starts[s]), int(m.ends[e - 1])
        if text[a:b] != m.text[s:e] and (a, kind, b) not in known:
            out.add((a, kind, b))
    return sorted(out)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base counts), base_sha256, spans.

    Every whole text is searched; a null text counts as empty (no spans).
    Offsets are code points of the source, ends exclusive.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, t in zip(b["doc_id"], b["text"]):
                base = find(t)
                more = find_disguised(t, base)
                n = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                sha = hashlib.sha256(spans_text(base).encode()).hexdigest()
                out.append((doc_id, *n, sha, spans_text(sorted([*base, *more]))))
            yield pd.DataFrame(out, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select(id_text(), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        search,
        f"doc_id string, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string",
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
