"""Personal data in plain and in disguised spelling, with spans in the source text."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskspark.llm.common import id_and_text, id_kind

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# The patterns of the four kinds. Their runs are possessive or start only where a
# run starts, which changes no match and keeps long runs of digits or letters linear.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters of other scripts that look like a Latin one.
LOOKALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧορν",
    "ABESIJKMHOPCTYXaesijopcyxhdqw" "ABEZHIKMNOPTYXopv", strict=True))
# Characters without width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
# Number words of four languages.
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_digit = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_dot = r"[ \t]+(?:dot|point|punkt|punto)[ \t]+"
DIGIT_RUN = re.compile(rf"(?<!\w){_digit}(?:(?:[ \t]*,[ \t]*|[ \t-]+|{_dot}){_digit})+(?!\w)")
DIGIT_WORD = re.compile(_digit)
PLUS = re.compile(r"(?<!\w)plus[ \t]+(?=[0-9])")
# a word or the sign itself, in brackets of any kind
_sign = r"[ \t]*(at|arroba|dot|punkt|punto|point|@|\.)[ \t]*"
BRACKETED = re.compile(rf"(?:(?<![ \t])[ \t]++)?+(?:\[{_sign}\]|\({_sign}\)|\{{{_sign}\}}|<{_sign}>)[ \t]*")
SIGN_OF = {"at": "@", "arroba": "@", "@": "@"}  # every other bracketed word is a dot
# "name_at_host_dot_tld", with one joining sign throughout; labels of the host hold no such sign
JOINED = re.compile(r"(?<=[a-z0-9.%+])(?P<join>[_-])at(?P=join)(?P<host>[a-z0-9]++(?:(?P=join)dot(?P=join)[a-z0-9]++)+)(?![a-z0-9_-])")
JOINED_DOT = re.compile(r"[_-]dot[_-]")
# "name at host dot tld": plain words count only in this whole shape, or with "@" already there
# (an article after "at" opens no host name: "at the dot com party")
SPOKEN = re.compile(
    r"(?<![a-z0-9._%+-])[a-z0-9._%+-]+(?P<at>[ \t]+at[ \t]+(?!(?:a|an|the|this|that)[ \t])|@)[a-z0-9-]+(?P<rest>(?:(?:\.|[ \t]+dot[ \t]+)[a-z0-9-]+)+)")
SPOKEN_DOT = re.compile(r"[ \t]+dot[ \t]+")
NUMBER_DOT = re.compile(rf"(?<=[0-9]){_dot}(?=[0-9])")


def emails(text: str) -> list[Span]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def ips(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text) if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups())]


def cards(text: str) -> list[Span]:
    found = []
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


def identifiers(text: str) -> dict[str, list[Span]]:
    """Base spans per kind, leftmost and non-overlapping."""
    return {kind: find(text) for kind, find in FINDERS.items()}


@lru_cache(maxsize=100_000)
def plain_character(c: str) -> str:
    """The ASCII character that ``c`` stands for, or ``c`` itself."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if ord(c) < 0x250 or unicodedata.category(c) == "No":
        return c
    folded = unicodedata.normalize("NFKC", c)
    if len(folded) == 1 and "!" <= folded <= "~":
        return folded
    value = unicodedata.decimal(c, None)
    return c if value is None else str(value)


class Aligned:
    """A rewritten text that knows for each character which source range it came from."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1
        self.changed = np.zeros(len(text), bool)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ranges of the present text; of overlapping edits the first holds."""
        texts, starts, ends, changed, done = [], [], [], [], 0
        for a, b, new in sorted(edits):
            if a < done:
                continue
            texts += [self.text[done:a], new]
            starts += [self.starts[done:a], np.full(len(new), self.starts[a])]
            ends += [self.ends[done:a], np.full(len(new), self.ends[b - 1])]
            changed += [self.changed[done:a], np.ones(len(new), bool)]
            done = b
        self.text = "".join([*texts, self.text[done:]])
        self.starts = np.concatenate([*starts, self.starts[done:]]).astype(np.int64)
        self.ends = np.concatenate([*ends, self.ends[done:]]).astype(np.int64)
        self.changed = np.concatenate([*changed, self.changed[done:]]).astype(bool)


def deobfuscate(text: str) -> Aligned | None:
    """The text with disguises undone, or None if it shows none."""
    out = Aligned(text)
    touched = False
    if not text.isascii():
        table = {ord(c): p for c in set(text) if (p := plain_character(c)) != c}
        if table:
            out.text = text.translate(table)
            out.changed = np.fromiter((a != b for a, b in zip(text, out.text, strict=True)), bool, len(text))
            touched = True
        # neighbours of what goes stay marked by the longer source range
        gone = [m.start() for m in re.finditer(f"[{INVISIBLE}]", out.text)]
        if gone:
            out.rewrite([(i, i + 1, "") for i in gone])
            touched = True
    # lower() may change the length beyond ASCII; those characters matter to no pattern below
    def low() -> str:
        s = out.text.lower()
        return s if len(s) == len(out.text) else "".join(c.lower() if c.isascii() else c for c in out.text)

    for step in (_digit_edits, _sign_edits, _spoken_edits, _number_edits):
        edits = step(low())
        if edits:
            out.rewrite(edits)
            touched = True
    return out if touched else None


def _digit_edits(low: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in DIGIT_RUN.finditer(low):
        words = list(DIGIT_WORD.finditer(low, m.start(), m.end()))
        for w, after in zip(words, [*words[1:], None], strict=True):
            # the gap up to the next word goes with this one, unless it says "dot"
            gap = low[w.end() : after.start()] if after else ""
            end = after.start() if after and not gap.strip(" \t,-") else w.end()
            edits.append((w.start(), end, DIGIT_WORDS[w[0]]))
    return edits


def _sign_edits(low: str) -> list[tuple[int, int, str]]:
    edits = [(*m.span(), SIGN_OF.get(next(g for g in m.groups() if g), ".")) for m in BRACKETED.finditer(low)]
    return edits + [(*m.span(), "+") for m in PLUS.finditer(low)] if "plus" in low else edits


def _spoken_edits(low: str) -> list[tuple[int, int, str]]:
    if "dot" not in low:
        return []
    edits = []
    for m in JOINED.finditer(low):
        edits.append((m.start(), m.start("host"), "@"))
        edits += [(*d.span(), ".") for d in JOINED_DOT.finditer(low, m.start("host"), m.end("host"))]
    for m in SPOKEN.finditer(low):
        dots = list(SPOKEN_DOT.finditer(low, m.start("rest"), m.end("rest")))
        if dots:
            edits += [(*d.span(), ".") for d in dots]
            if m["at"] != "@":
                edits.append((*m.span("at"), "@"))
    return edits


def _number_edits(low: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), ".") for m in NUMBER_DOT.finditer(low)]


def disguised(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans, in the source text, of identifiers that only the rewritten text shows."""
    aligned = deobfuscate(text)
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if aligned is None:
        return found
    for kind, spans in identifiers(aligned.text).items():
        for a, b in spans:
            start, end = int(aligned.starts[a]), int(aligned.ends[b - 1])
            hidden = aligned.changed[a:b].any() or end - start != b - a
            met = [(s, e) for s, e in base[kind] if s < end and start < e]
            if hidden and (start, end) not in met and all(start <= s and e <= end for s, e in met):
                found[kind].append((start, end))
    return found


def find_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base, added) spans per kind of one whole text."""
    base = identifiers(text)
    return base, disguised(text, base)


def span_list(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


REPORT_SCHEMA = ("doc_id {id}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                 "spans string, n_added long")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the base counts, the digest of the base spans, all spans, and how many were added.

    Spans are code points of the source text, end exclusive. A disguised identifier is added if
    its rewritten form matches the pattern of its kind, its source range holds a rewritten
    character, and it overlaps no base span of its kind or holds it whole; base spans always stay. Null and empty
    texts have no spans; repeated rows are reported each; null ids stay null; an empty table
    gives no rows; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in range(7)]
            for text in b.column("text").to_pylist():
                base, added = find_spans(text)
                row = [len(base[k]) for k in KINDS]
                row.append(hashlib.sha256(span_list(base).encode()).hexdigest())
                row.append(span_list({k: base[k] + added[k] for k in KINDS}))
                row.append(sum(map(len, added.values())))
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, REPORT_SCHEMA.format(id=id_kind(docs, id_col)))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text with every span, plain or disguised, replaced by its kind in angle brackets."""

    def masked(text: str) -> str:
        base, added = find_spans(text)
        spans = sorted((a, b, k) for found in (base, added) for k in KINDS for a, b in found[k])
        out, done = [], 0
        for a, b, kind in spans:
            if a >= done:
                out += [text[done:a], f"<{kind}>"]
            done = max(done, b)
        return "".join([*out, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(masked, b.column("text").to_pylist()), pa.string())],
                names=["doc_id", "text"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_kind(docs, id_col)}, text string")
