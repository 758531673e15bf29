"""Personal data in whole texts, also in disguise, with spans in source characters.

Base identifiers (email, ip, card, phone) are what plain patterns find. A text with signs of a
disguise is then rewritten by a chain of transducers: look-alike, full-width and styled signs to
ASCII, invisible signs away, bracketed or spelled "at" and "dot" to signs, runs of spelled digits
to digits. Each keeps for every sign it writes the stretch of source characters it stands for, so
what the same patterns find in the result maps back to the source. Such spans are added if they
touch no base span of their kind.

Signs of identifiers and of disguises are found on whole batches at once, by array operations and
a linear-time matcher; only the stretches and texts found so are looked at one by one.

Defined cases: a null text is an empty one (``redacted`` keeps it null); repeated rows and texts
are searched each; empty tables give no rows; other columns are kept by ``found`` and
``redacted``, the first of which adds ``pii_base`` and ``pii_spans`` (columns of these names are
replaced).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

# Patterns take linear time: a run of one kind of signs is entered at its begin alone and never given
# back (what follows can't begin with its signs), so no other match is found or lost.
_LOCAL_BYTES = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + b"._%+-"
DOMAIN = re.compile(rb"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
IP = re.compile(rb"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

_EMAIL_BYTE = np.zeros(256, bool)
_EMAIL_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"._%+-@"]] = True
_IP_BYTE = np.zeros(256, bool)
_IP_BYTE[[*range(48, 58), 0x2E]] = True


def luhn(digits: np.ndarray) -> bool:
    doubled = digits[-2::-2].astype(int) * 2
    return int(digits[-1::-2].sum() + (doubled - 9 * (doubled > 9)).sum()) % 10 == 0


def _runs(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, marks: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, start, end) of the longest runs of ``kind`` bytes around the marks, inside texts."""
    if not len(marks):
        return
    gaps = np.flatnonzero(~kind[data])
    text = np.searchsorted(offsets, marks, "right") - 1
    at = np.searchsorted(gaps, marks)
    start = np.maximum(np.where(at > 0, gaps[np.maximum(at - 1, 0)] + 1 if len(gaps) else 0, 0), offsets[text])
    end = np.minimum(np.where(at < len(gaps), gaps[np.minimum(at, len(gaps) - 1)] if len(gaps) else len(data), len(data)), offsets[text + 1])
    _, first = np.unique(start, return_index=True)
    yield from zip(text[first].tolist(), start[first].tolist(), end[first].tolist(), strict=True)


def _emails(run: bytes) -> Iterator[tuple[int, int]]:
    """Addresses in a run: the longest local part before each at sign, after the address before."""
    begin, at = 0, run.find(b"@")
    while at >= 0:
        start = begin + len(run[begin:at].rstrip(_LOCAL_BYTES))
        m = DOMAIN.match(run, at + 1) if start < at else None
        if m:
            yield start, m.end()
        begin = m.end() if m else at + 1
        at = run.find(b"@", begin)


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[list[Span]]:
    """For each text its base identifiers, in bytes from the text's begin."""
    out: list[list[Span]] = [[] for _ in range(len(offsets) - 1)]
    if not len(data):
        return out
    raw = data.tobytes()
    digit = (data >= 48) & (data <= 57)

    for text, a, b in _runs(data, offsets, _EMAIL_BYTE, np.flatnonzero(data == 0x40)):
        out[text] += [(0, a + start - offsets[text], a + end - offsets[text]) for start, end in _emails(raw[a:b])]

    dots = np.flatnonzero(data == 0x2E)
    dots = dots[(dots > 0) & (dots < len(data) - 1)]
    dots = dots[digit[dots - 1] & digit[dots + 1]]
    for text, a, b in _runs(data, offsets, _IP_BYTE, dots):
        for m in IP.finditer(raw[a:b]):
            if all(len(x.lstrip(b"0")) <= 3 and int(x.lstrip(b"0") or b"0") <= 255 for x in m[0].split(b".")):
                out[text].append((1, a + m.start() - offsets[text], a + m.end() - offsets[text]))

    # digits with at most one blank or hyphen between them: each longest chain is one match
    place = np.flatnonzero(digit)
    if len(place):
        gap = np.diff(place)
        middle = data[np.minimum(place[:-1] + 1, len(data) - 1)]
        joined = (gap == 1) | ((gap == 2) & ((middle == 0x20) | (middle == 0x2D)))
        owner = np.searchsorted(offsets, place, "right") - 1
        joined &= owner[1:] == owner[:-1]
        first = np.flatnonzero(np.append(True, ~joined))
        size = np.diff(np.append(first, len(place)))
        for i, n in zip(first[(size >= 16) & (size <= 19)].tolist(), size[(size >= 16) & (size <= 19)].tolist(), strict=True):
            if luhn(data[place[i : i + n]] - 48):
                text = owner[i]
                out[text].append((2, int(place[i] - offsets[text]), int(place[i + n - 1] + 1 - offsets[text])))

    plus = np.flatnonzero(data == 0x2B)
    plus = plus[plus < len(data) - 1]
    plus = plus[digit[plus + 1]]
    for p, text in zip(plus.tolist(), (np.searchsorted(offsets, plus, "right") - 1).tolist(), strict=True):
        m = PHONE.match(raw, p, offsets[text + 1])
        if m and 8 <= sum(48 <= c <= 57 for c in m[0]) <= 15:
            out[text].append((3, p - offsets[text], m.end() - offsets[text]))
    return [[(int(k), int(a), int(b)) for k, a, b in spans] for spans in out]


# -- transducers -----------------------------------------------------------------------------

#: Letters that look like Latin ones (fixed values).
LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "һ": "h", "ԁ": "d", "ɡ": "g", "ո": "n", "ԛ": "q", "ԝ": "w", "ѵ": "v", "к": "k", "м": "m", "т": "t",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "З": "3",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "ε": "e", "τ": "t", "γ": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ⅼ": "l", "∙": ".", "․": ".", "·": ".", "•": ".",
}
DIGITS = {
    **{w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())},
    **{w: str(i) for i, w in enumerate("null eins zwei drei vier fünf sechs sieben acht neun".split())},
    **{w: str(i) for i, w in enumerate("zéro un deux trois quatre cinq six sept huit neuf".split())},
    **{w: str(i) for i, w in enumerate("cero uno dos tres cuatro cinco seis siete ocho nueve".split())},
    "oh": "0",
}
TIMES = {"double": 2, "triple": 3}
AT = "at|arroba|arobase|ät"
DOT = "dot|punto|punkt|point|period"

_WORD = "|".join(sorted((re.escape(w) for w in DIGITS), key=len, reverse=True))
_GAP = r"[\s,;/·_-]{1,3}"
_ITEM = rf"(?:(?:double|triple){_GAP})?(?:{_WORD}|[0-9]++)"
#: Seven digits or more of which one or more are spelled, after an optional plus.
SPELLED = re.compile(rf"(?<![^\W_])(?:(?:\+\s*|plus{_GAP}))?{_ITEM}(?:(?:{_GAP}|{_GAP}?(?:{DOT}){_GAP}|[().]){{1}}{_ITEM}){{3,}}(?![^\W_])", re.I)
INVISIBLE = re.compile("[­​-‏⁠-⁤﻿]+")
#: Blanks from the begin of their run, or none.
_BLANKS = r"(?:(?<!\s)\s++)?"
BRACKET_AT = re.compile(rf"{_BLANKS}[\[({{<]\s*+(?:{AT}|@)\s*+[\])}}>]\s*+", re.I)
BRACKET_DOT = re.compile(rf"{_BLANKS}[\[({{<]\s*+(?:{DOT}|\.)\s*+[\])}}>]\s*+", re.I)
_LABEL = r"[A-Za-z0-9-]++"
_LOCAL = r"[A-Za-z0-9._%+-]++"
SPELLED_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?<![^\W_]){_LOCAL}(?:\s++(?:{DOT})\s++{_LOCAL}){{0,3}}(?:\s++(?:{AT})\s++|\s*+@\s*+){_LABEL}(?:(?:\s++(?:{DOT})\s++|\s*+\.\s*+){_LABEL}){{1,4}}", re.I
)
_SPELLED_AT = re.compile(rf"(?<!\s)\s++(?:{AT})\s++|{_BLANKS}@\s*+", re.I)
_SPELLED_DOT = re.compile(rf"(?<!\s)\s++(?:{DOT})\s++|{_BLANKS}\.\s*+", re.I)
_HAS_SPELLED_DOT = re.compile(rf"\s(?:{DOT})\s", re.I)
_TOKEN = re.compile(rf"(?P<times>(?:double|triple){_GAP})?(?P<digit>{_WORD}|[0-9]+)|(?P<plus>\+\s*|plus{_GAP})|(?P<dot>(?:{_GAP})?(?:{DOT}){_GAP}|\.)|(?P<gap>.)", re.I | re.S)

def _sign_table() -> dict[int, str]:
    """One ASCII sign for each sign that is a compatibility form or a look-alike of it."""
    table = {ord(k): v for k, v in LOOK_ALIKE.items()}
    for low, high in ((0x2070, 0x209D), (0x2460, 0x2500), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)):
        for i in range(low, high):
            plain = unicodedata.normalize("NFKC", chr(i))
            plain = LOOK_ALIKE.get(plain, plain)
            if len(plain) == 1 and plain.isascii():
                table[i] = plain
    for zero in (0x0660, 0x06F0, 0x0966):
        table |= {zero + d: str(d) for d in range(10)}
    return table | dict.fromkeys(range(0x2010, 0x2016), "-")


_SIGN_TABLE = _sign_table()


def _class(signs: list[int]) -> str:
    """The signs as ranges inside a character class."""
    signs = np.unique(signs)
    cut = np.flatnonzero(np.diff(signs) != 1)
    ends = zip(signs[np.append(0, cut + 1)].tolist(), signs[np.append(cut, len(signs) - 1)].tolist(), strict=True)
    return "".join(rf"\x{{{a:04X}}}-\x{{{b:04X}}}" for a, b in ends)


_BETWEEN = rf"(?:{_GAP}|(?:{_GAP})?(?:{DOT}){_GAP}|[().])"
#: What a disguise can't do without, for a linear-time matcher over all texts.
SIGNS = (
    r"[\x{0370}-\x{052F}\x{0531}-\x{058F}\x{0660}-\x{0669}\x{06F0}-\x{06F9}\x{0966}-\x{096F}\x{00AD}\x{0131}\x{0261}"
    r"\x{200B}-\x{200F}\x{2010}-\x{2015}\x{2024}\x{2060}-\x{2064}\x{2070}-\x{209C}\x{2219}\x{217C}\x{2460}-\x{24FF}"
    r"\x{FEFF}\x{FF01}-\x{FF5E}\x{1D400}-\x{1D7FF}"
    rf"{_class(list(_SIGN_TABLE))}]"
    rf"|[\[({{<]\s*(?:{AT}|@|{DOT}|\.)\s*[\])}}>]"
    rf"|\s(?:{DOT})\s+[A-Za-z0-9]"
    r"|\s@|@\s|@\S+\s\.|@\S+\.\s+[a-z]"
    rf"|(?:{_WORD}){_BETWEEN}(?:(?:double|triple){_GAP})?(?:{_WORD}|[0-9])"
    rf"|[0-9]{_BETWEEN}(?:(?:double|triple){_GAP})?(?:{_WORD})"
    rf"|[0-9](?:{_GAP})?(?:{DOT}){_GAP}[0-9]"
)


class Tape:
    """A text, with the stretch of source characters [starts, ends) behind each of its signs."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def rewrite(self, pattern: re.Pattern, write: Callable[[re.Match], list[tuple[str, int, int]]]) -> None:
        """Replace each match by (sign, start, end) entries, positions relative to this tape."""
        out, starts, ends, last = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = write(m)
            if new is None:
                continue
            out += [self.text[last : m.start()], "".join(s for s, _, _ in new)]
            starts += [self.starts[last : m.start()], [self.starts[a] for _, a, _ in new]]
            ends += [self.ends[last : m.start()], [self.ends[b - 1] for _, _, b in new]]
            last = m.end()
        if out:
            self.text = "".join(out) + self.text[last:]
            self.starts = np.concatenate([*starts, self.starts[last:]]).astype(np.int64)
            self.ends = np.concatenate([*ends, self.ends[last:]]).astype(np.int64)


def _drop(m: re.Match) -> list:
    return []


def _one(sign: str) -> Callable:
    return lambda m: [(sign, m.start(), m.end())]


def _spelled_email(m: re.Match) -> list | None:
    """An address with spelled or spaced signs; a spelled "at" needs a spelled dot as well."""
    text, base = m[0], m.start()
    at = _SPELLED_AT.search(text)
    if "@" not in at[0] and not _HAS_SPELLED_DOT.search(text, at.end() - 1):
        return None
    out, i = [], 0
    while i < len(text):
        hit = _SPELLED_AT.match(text, i) if i == at.start() else _SPELLED_DOT.match(text, i)
        if hit:
            out.append(("@" if i == at.start() else ".", base + i, base + hit.end()))
            i = hit.end()
        else:
            out.append((text[i], base + i, base + i + 1))
            i += 1
    return out


def _spelled_digits(m: re.Match) -> list | None:
    """Digits for a run of spelled ones; a run with none spelled stays."""
    out, spelled, base, before = [], 0, m.start(), 0
    for t in _TOKEN.finditer(m[0]):
        a, b = base + t.start(), base + t.end()
        if t["digit"]:
            word = t["digit"].lower()
            value = DIGITS.get(word, word)
            spelled += word in DIGITS
            times = TIMES[re.match(r"\w+", t["times"])[0].lower()] if t["times"] else 1
            if word in DIGITS:
                out += [(value, a, b)] * times
            else:
                first = base + t.start("digit")
                out += [(d, first + i, first + i + 1) for i, d in enumerate(word)]
        elif t["plus"]:
            out.append(("+", a, b))
        elif t["dot"]:
            out.append((".", a, b))
        before = b
    return out if spelled >= 2 else None


def deobfuscated(text: str) -> Tape:
    tape = Tape(text)
    tape.text = text.translate(_SIGN_TABLE)
    tape.rewrite(INVISIBLE, _drop)
    tape.rewrite(BRACKET_AT, _one("@"))
    tape.rewrite(BRACKET_DOT, _one("."))
    tape.rewrite(SPELLED, _spelled_digits)
    tape.rewrite(SPELLED_EMAIL, _spelled_email)
    return tape


def _in_characters(raw: np.ndarray, spans: list[Span]) -> list[Span]:
    if not spans:
        return []
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return sorted((k, int(before[a]), int(before[b])) for k, a, b in spans)


def _hidden(text: str, base: list[Span]) -> list[Span]:
    """Spans of disguised identifiers that touch no base span of their kind."""
    tape = deobfuscated(text)
    if tape.text == text:
        return []
    data = np.frombuffer(tape.text.encode("utf-8", "replace"), np.uint8)
    spans = _in_characters(data, base_spans(data, np.array([0, len(data)]))[0])
    known = [np.array([(x, y) for k, x, y in base if k == kind]).reshape(-1, 2) for kind in range(len(KINDS))]
    out = []
    for kind, a, b in spans:
        start, end = int(tape.starts[a]), int(tape.ends[b - 1])
        before = int(np.searchsorted(known[kind][:, 0], end)) - 1  # the last one that begins before the end
        if before < 0 or known[kind][before, 1] <= start:
            out.append((kind, start, end))
    return out


def search(batch: pa.RecordBatch, column: str = "text") -> tuple[list[list[Span]], list[list[Span]]]:
    """(base, all) spans of each text, in characters, sorted by kind and start."""
    data, offsets = text_bytes(batch.column(column))
    texts = pc.fill_null(batch.column(column), "")
    signs = pc.match_substring_regex(texts, SIGNS, ignore_case=True).to_pylist()
    base = [
        _in_characters(data[offsets[i] : offsets[i + 1]], spans) if spans else []
        for i, spans in enumerate(base_spans(data, offsets))
    ]
    every = [sorted(b + _hidden(texts[i].as_py(), b)) if signs[i] else b for i, b in enumerate(base)]
    return base, every


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _listed(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in own] for own in spans], _SPAN_TYPE)


def found(docs: DataFrame) -> DataFrame:
    """The documents with pii_base and pii_spans: kind, start, end in characters, end exclusive."""
    own = ["pii_base", "pii_spans"]
    rows = docs.drop(*own)
    schema = rows.withColumns({c: F.array().cast(SPANS) for c in own}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [_listed(spans) for spans in search(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *own])

    return rows.mapInArrow(run, schema)


def _masked(text: str, spans: list[Span]) -> str:
    """Each span, or union of overlapping spans, as its first kind in brackets."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{KINDS[kind].upper()}]"]
        last = max(last, b)
    return "".join(out) + text[last:]


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span in ``text`` masked, and ``n_chars`` (if there) made to fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = search(batch)[1]
            if any(spans):
                place = batch.schema.get_field_index("text")
                texts = batch.column(place)
                new = [_masked(t.as_py(), s) if s else t.as_py() for t, s in zip(texts, spans, strict=True)]
                batch = batch.set_column(place, batch.schema.field(place), pa.array(new, texts.type))
            yield batch

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
