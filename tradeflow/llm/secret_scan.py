"""Secrets in texts: labelled values, access keys, hex digests, and strings of high Shannon entropy.

Three patterns find the plain cases (``assign``, ``access``, ``hex``). Beside
them every candidate string, a run of characters that keys are made of, is
read through a window of a fixed width for each character class. Counts of the
window's characters are kept while it moves, so its entropy changes by two
terms a step. A window counts if all its characters are in the class, the
class's needs are met (a hex key has digits and letters, say) and its entropy
reaches the class's threshold; windows that touch make one span.

Allow-listed spans are dropped: those inside a UUID, a URL or a file path, a
labelled digest, a run of characters in counting or alphabetic order, and any
string that the caller names. The plain patterns' spans are never dropped; a
window span inside one of them adds nothing and is left out.

Positions count code points, ends are exclusive. Cases: null and empty texts
have no spans; texts are read whole, whatever their length; equal rows give
equal results. Only the id and text columns are read; an empty table has no
rows. The work is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The plain patterns, with the characters that a hit must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run of 32 or more
MIN_VALUE, MIN_ACCESS = 8, 16

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)


class Kind(NamedTuple):
    """A character class: its characters, groups that a window must show one of each of, and the least entropy in bits."""
    name: str
    chars: str
    needs: tuple[str, ...]
    bits: float


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    Kind("window_hex", DIGITS + "abcdef", (DIGITS, "abcdef"), 3.0),
    Kind("window_upper", DIGITS + UPPER, (DIGITS, UPPER), 3.4),
    Kind("window_lower", DIGITS + LOWER, (DIGITS, LOWER), 3.4),
    Kind("window_base64", DIGITS + LOWER + UPPER + "+/_=-", (DIGITS, LOWER, UPPER), 3.7),
)
KINDS = ("assign", "access", "hex") + tuple(c.name for c in CLASSES)

#: What is high in entropy and no secret.
ALLOWED = tuple(re.compile(p) for p in (
    r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9A-Za-z])",
    r"[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]+",
    r"(?<![\w/])(?:\.{0,2}/)(?:[\w.-]+/)+[\w.-]*",
    r"(?:sha(?:1|224|256|384|512)|md5|crc32|integrity)[-:=]\x20?[A-Za-z0-9+/=]+",
))
ORDERED = (DIGITS + UPPER + LOWER, DIGITS + "abcdef", LOWER, UPPER, DIGITS * 4, "abcdef" + DIGITS, LOWER + UPPER + DIGITS,
           UPPER + LOWER + DIGITS)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The plain patterns' hits, leftmost and without overlap for each kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def window_spans(word: str, kind: Kind, width: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of ``word`` whose windows reach the class's entropy. The window's counts are kept: a step changes the sum
    of c*log2(c) by the two characters that enter and leave."""
    if len(word) < width:
        return []
    weight = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]  # c*log2(c)
    most = width * (math.log2(width) - kind.bits) + 1e-9               # H >= bits  <=>  sum <= most
    members = frozenset(kind.chars)
    spans: list[tuple[int, int]] = []
    counts: dict[str, int] = {}
    groups = [0] * len(kind.needs)
    of_group = {c: [i for i, g in enumerate(kind.needs) if c in g] for c in members}
    total, run = 0.0, 0
    for end, c in enumerate(word, 1):
        if c not in members:
            counts.clear()
            groups, total, run = [0] * len(kind.needs), 0.0, 0
            continue
        n = counts.get(c, 0)
        counts[c] = n + 1
        for g in of_group[c]:
            groups[g] += 1
        run += 1
        if run > width:
            old = word[end - 1 - width]
            if old == c:
                total += 0.0
            else:
                total += weight[n + 1] - weight[n]
                m = counts[old]
                total += weight[m - 1] - weight[m]
            counts[old] -= 1
            for g in of_group[old]:
                groups[g] -= 1
        else:
            total += weight[n + 1] - weight[n]
        if run >= width and total <= most and all(groups):
            if spans and spans[-1][1] >= end - width:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((end - width, end))
    return spans


def _in_order(value: str) -> bool:
    """Whether most of the value counts up or down by one place of an alphabet."""
    ups = sum(1 for a, b in zip(value, value[1:]) if any(a + b in s or b + a in s for s in ORDERED))
    return 2 * ups > len(value)


class Scanner:
    """Finds the spans of a text. ``classes``, ``allowed`` patterns and ``literals`` (strings never reported by windows)
    may be replaced."""

    def __init__(self, classes: Sequence[Kind] = CLASSES, allowed=ALLOWED, literals: Sequence[str] = ()):
        self.classes, self.allowed, self.literals = tuple(classes), tuple(allowed), tuple(literals)
        self.rank = {k: i for i, k in enumerate(("assign", "access", "hex", *(c.name for c in self.classes)))}

    def _suppressed(self, text: str):
        """Allow-listed spans, found only when a window span asks for them."""
        spans = [m.span() for p in self.allowed for m in p.finditer(text)]
        for word in self.literals:
            at = text.find(word)
            while word and at >= 0:
                spans.append((at, at + len(word)))
                at = text.find(word, at + 1)
        return spans

    def spans(self, text: str | None) -> tuple[list, list]:
        """(base spans, all spans) as (kind, start, end), by start and then kind as listed."""
        if not text:
            return [], []
        base = base_spans(text)
        more = []
        for m in CANDIDATE.finditer(text):
            taken: list[tuple[int, int]] = []
            for kind in self.classes:  # narrow classes first: a span inside a narrower class's span adds nothing
                known = _Cover(taken)
                new = [(a + m.start(), e + m.start()) for a, e in window_spans(m.group(), kind)]
                new = [s for s in new if not known.holds(*s)]
                taken += new
                more += [(kind.name, *s) for s in new]
        if more:
            known = _Cover([s[1:] for s in base])
            more = [s for s in more if not known.holds(s[1], s[2])]
            allowed = _Cover(self._suppressed(text))
            more = [s for s in more if not allowed.holds(s[1], s[2]) and not _in_order(text[s[1]:s[2]])]
        def order(s):
            return s[1], self.rank[s[0]], s[2]
        return sorted(base, key=order), sorted(base + more, key=order)


class _Cover:
    """Spans, asked whether one of them holds another."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.reach, far = [], -1
        for _, e in self.spans:
            far = max(far, e)
            self.reach.append(far)

    def holds(self, start: int, end: int) -> bool:
        i = bisect.bisect_right(self.spans, (start, 1 << 62)) - 1
        return i >= 0 and self.reach[i] >= end


_SPAN = "struct<kind:string,start:int,end:int>"


def _scan(scanner: Scanner):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, every = [], []
            for text in b.column(1):
                x, y = scanner.spans(text.as_py())
                base.append([dict(zip(("kind", "start", "end"), s)) for s in x])
                every.append([dict(zip(("kind", "start", "end"), s)) for s in y])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, kind), pa.array(every, kind)],
                                             names=["doc_id", "base", "spans"])
    return run


def find_secrets(docs: DataFrame, scanner: Scanner | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base (the plain patterns' spans) and spans (all), as arrays of kind, start, end."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        _scan(scanner or Scanner()), f"doc_id {kind}, base array<{_SPAN}>, spans array<{_SPAN}>")


def redact(docs: DataFrame, scanner: Scanner | None = None, *, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "*") -> DataFrame:
    """doc_id and the text with every span's characters replaced by ``mark``; null texts stay null."""
    scanner, kind = scanner or Scanner(), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                parts, at = [], 0
                for _, start, end in scanner.spans(text)[1]:
                    if end > at:
                        parts += [text[at:max(at, start)], mark * (end - max(at, start))]
                        at = end
                out.append(None if text is None else "".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id {kind}, text string")


def joined(spans: str):
    """A column of spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """The result of :func:`find_secrets` as counts of the plain kinds, a digest of their spans, and all spans as text."""
    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))
