"""Secret scan: sliding-window Shannon entropy per character class, with allow-lists.

Fixed patterns give the base spans. The method adds spans: every candidate string (a
long run of one character class) is scanned by a window whose entropy is kept up to
date from counts as characters enter and leave; where it reaches the class's threshold
the covered characters are suspect, unless an allow-list explains them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of fewer characters would be dropped, and no match can begin inside a longer run.
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of one class: their pattern, the window, the least entropy in bits a character, and what each must hold."""

    name: str
    pattern: re.Pattern
    window: int
    least: float
    holds: tuple[re.Pattern, ...] = ()


#: The narrower class first; a candidate of a wide class that is all of the narrow one is left to it.
#: A short string is a candidate only if it mixes cases and digits.
CLASSES = (
    CharacterClass("hex", re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{24,}(?![0-9A-Za-z])"), 24, 3.0),
    CharacterClass("base64", re.compile(r"[0-9A-Za-z+/_-]{24,}={0,2}"), 24, 3.9),
    CharacterClass("short", re.compile(r"(?<![0-9A-Za-z+/_-])[0-9A-Za-z+/_-]{16,23}(?![0-9A-Za-z+/_=-])"), 16, 3.5, tuple(map(re.compile, ("[0-9]", "[a-z]", "[A-Z]")))),
)

# Words of one case and camel case: after capitals come two small letters at least. A random mix of cases doesn't look so.
_WORDS = "[a-z]*+(?:[A-Z]++[a-z]{2,}+)*+[A-Z]*+"
#: Strings that look random but are public by nature.
ALLOWED = (
    re.compile(r"[0-9+/_=-]*"),  # numbers, rules of dashes
    re.compile(rf"{_WORDS}(?:[/_-]++(?:[0-9]{{1,4}}+|{_WORDS}))*+"),  # words, paths, slugs
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUIDs
)


@dataclass(frozen=True)
class Settings:
    classes: tuple[CharacterClass, ...] = CLASSES
    allowed: tuple[re.Pattern, ...] = ALLOWED
    allowed_strings: frozenset[str] = field(default_factory=frozenset)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Rows ``(start, end, kind number)`` of the fixed patterns, sorted."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def dense_runs(text: str, window: int, least: float) -> Iterator[tuple[int, int]]:
    """Maximal runs covered by windows with an entropy of at least ``least`` bits a character.

    The sum of c*log2(c) over the window's character counts c changes by two terms when
    the window moves by one, so each step is constant work.
    """
    if len(text) < window:
        return
    term = _terms(window)
    counts: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1
    full = math.log2(window)
    for i, ch in enumerate(text):
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= window:
            old = text[i - window]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        if i >= window - 1 and full - total / window >= least - 1e-9:
            if begin >= 0 and i - window + 1 <= end:
                end = i + 1
            else:
                if begin >= 0:
                    yield begin, end
                begin, end = i - window + 1, i + 1
    if begin >= 0:
        yield begin, end


_TERMS: dict[int, list[float]] = {}


def _terms(window: int) -> list[float]:
    if window not in _TERMS:
        _TERMS[window] = [0.0, *(c * math.log2(c) for c in range(1, window + 2))]
    return _TERMS[window]


def entropy_spans(text: str, settings: Settings = Settings()) -> list[tuple[int, int, int]]:
    """Spans that only their entropy gives away."""
    out: list[tuple[int, int, int]] = []
    for number, kind in enumerate(settings.classes):
        for m in kind.pattern.finditer(text):
            found = m[0]
            if found in settings.allowed_strings or any(p.fullmatch(found) for p in settings.allowed):
                continue
            if number and settings.classes[0].pattern.fullmatch(found) or not all(p.search(found) for p in kind.holds):
                continue
            out += [(m.start() + a, m.start() + b, 3) for a, b in dense_runs(found, kind.window, kind.least)]
    return out


def all_spans(text: str, settings: Settings = Settings()) -> tuple[list, list]:
    """Base spans, and base spans with those that the method adds; both by start, then kind."""
    base = base_spans(text)
    more = []
    for s in entropy_spans(text, settings):
        if not any(b[0] < s[1] and s[0] < b[1] for b in base):
            more.append(s)
    return base, sorted({*base, *more}, key=lambda x: (x[0], x[2], x[1]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Secrets of each document: ``(doc_id, spans array<struct<kind, start, stop, base>>)``, in order.

    Positions are code points, the end exclusive. A null or empty text has no spans; rows with
    a null or repeated ``doc_id`` are kept, each by itself; other columns are ignored; an empty
    table gives no rows. A text is read whole, whatever its length.
    """

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            base, both = all_spans(text or "", settings)
            known = set(base)
            rows.append([{"kind": KINDS[k], "start": a, "stop": b, "base": (a, b, k) in known} for a, b, k in both])
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(slim, find, "doc_id long, spans array<struct<kind: string, start: long, stop: long, base: boolean>>", column=1)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``'s rows."""
    shown = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")
    base = F.filter("spans", lambda s: s.base)
    count = lambda k: F.size(F.filter(base, lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *(count(k) for k in KINDS[:3]), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown("spans").alias("spans")
    )


def redacted(text: str | None, settings: Settings = Settings()) -> str | None:
    """The text with each secret replaced by its kind in angle brackets; overlapping spans become one."""
    if not text:
        return text
    spans = all_spans(text, settings)[1]
    if not spans:
        return text
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; ``n_chars``, if there, follows.

    All rows and other columns stay as they are, whatever their names, null and repeated ids too; a null or empty
    text stays so; an empty table gives no rows. A text is read whole, whatever its length.
    """
    texts = docs.columns.index("text")

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.set_column(texts, "text", pa.array([redacted(t, settings) for t in batch.column(texts).to_pylist()], pa.string()))

    out = map_texts(docs, change, docs.schema, column=texts)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
