"""Secret scans: strong patterns on their own, weak candidates only as complementary parts.

``base_spans`` finds three kinds of secret that a pattern alone decides. ``linked_spans`` adds
multipart credentials: access identifiers, secrets and endpoints, each a weak candidate by itself,
are interval-joined within a scope, and a candidate counts only when a part of another kind that
completes it stands within the same scope. A scope is a run of lines without a blank one, and
inside it parts join when at most ``REACH`` code points separate them, not counting whole lines of
settings between them, of which there may be any number.

The join is one sweep over the sorted parts of a text, so a text with many parts costs
n log n, and no row leaves its task. Nulls are empty texts, repeated rows give repeated results,
an empty table gives an empty one, and other columns are not read.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from pliego.llm.cluster import bounded_batches

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
#: Runs of their class are maximal, so a shorter one never hides a long enough one.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
HINT = re.compile(r"(?i:passw|secret|token|api_?key)", re.ASCII)

#: Code points between two parts of one credential, at most, without the lines of settings between them.
REACH = 200
#: A line of settings: a name and a value, a comment, a section, or brackets alone.
SETTING = re.compile(r"""^[ \t]*(?:(?:export[ \t]+|[-*][ \t]+)?["']?[\w.$-]+["']?[ \t]*[:=]|#|;|//|\[[^\]\n]*\][ \t\r]*$|[\[\]{}(),]+[ \t\r]*$)""", re.ASCII | re.M)
#: Bits a character that a bare string must have to be a weak secret.
WEAK_SECRET_BITS = 3.5
#: Weak parts. Each names the kind and the group that holds the value.
PARTS = (
    ("id", re.compile(r"""(?:client|account|tenant|access_?key)_?id["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{4,})|(?<![A-Za-z0-9])(?:user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""", re.ASCII | re.I)),
    ("endpoint", re.compile(r"""\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://([^\s"'<>]{3,})|(?<![A-Za-z0-9])(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]+\.[A-Za-z]{2,}|\d{1,3}(?:\.\d{1,3}){3})""", re.ASCII | re.I)),
    ("secret", re.compile(r"""(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{16,}={0,2})(?![A-Za-z0-9+/_=-])|(?<![A-Za-z0-9])(?:pass|pwd|pw|key|credential|auth)["']?\x20*[:=]\x20*["']?([^\s"',;]{6,})""", re.ASCII | re.I)),
)
PART_HINT = re.compile(r"://|[:=]")
#: What completes a weak candidate of each kind.
COMPLEMENTS = {"id": {"secret", "assign", "hex"}, "secret": {"id", "access", "endpoint"}, "endpoint": {"secret", "assign", "hex"}}


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def base_spans(text: str) -> list[Span]:
    found = []
    if HINT.search(text):
        found += [Span(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [Span(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [Span(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _weak_parts(text: str, base: list[Span]) -> list[Span]:
    taken = [(s.start, s.end) for s in sorted(base)]
    starts = [a for a, _ in taken]
    reach = [0]
    for _, b in taken:
        reach.append(max(reach[-1], b))
    found = []
    for kind, pattern in PARTS:
        for m in pattern.finditer(text):
            group = 1 if m[1] is not None else 2
            a, b = m.span(group)
            if reach[bisect.bisect_left(starts, b)] > a:
                continue  # a base span covers it
            value = m[group]
            if kind == "secret" and group == 1 and not (any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value) and entropy(value) >= WEAK_SECRET_BITS):
                continue
            found.append(Span(a, b, kind))
    return found


def linked_spans(text: str, base: list[Span], reach: int = REACH) -> list[tuple[Span, int]]:
    """The weak parts that a complementary part within reach and scope completes, each with the number of kinds that do."""
    if not base and not PART_HINT.search(text):
        return []
    weak = _weak_parts(text, base)
    if not weak:
        return []
    breaks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = lambda s: bisect.bisect_left(breaks, s.start)
    parts = sorted([*weak, *base])
    by: dict[tuple[int, str], list[Span]] = {}
    for s in parts:
        by.setdefault((scope(s), s.kind), []).append(s)
    starts = {k: [s.start for s in v] for k, v in by.items()}
    ends = {k: list(itertools.accumulate((s.end for s in v), max)) for k, v in by.items()}
    # Places as they are without the lines of settings before a part's line, or up to it.
    lines = [0, *(m.end() for m in re.finditer("\n", text)), len(text) + 1]
    settings = {bisect.bisect_right(lines, m.start()) - 1 for m in SETTING.finditer(text)}
    dropped = list(itertools.accumulate((lines[i + 1] - lines[i] if i in settings else 0 for i in range(len(lines) - 1)), initial=0))
    line = lambda s: bisect.bisect_right(lines, s.start) - 1
    from_line = lambda s: s.start - dropped[line(s)]
    after_line = lambda s: s.end - dropped[line(s) + 1]
    line_of = {k: [line(s) for s in v] for k, v in by.items()}
    last = {k: list(itertools.accumulate((after_line(s) for s in v), max)) for k, v in by.items()}
    first = {k: list(itertools.accumulate((from_line(s) for s in reversed(v)), min))[::-1] for k, v in by.items()}
    out = []
    for s in weak:
        near = 0
        for other in COMPLEMENTS[s.kind]:
            k = (scope(s), other)
            if k in by:  # of those that start early enough, does the farthest end reach far enough?
                high = bisect.bisect_right(starts[k], s.end + reach)
                close = high > 0 and ends[k][high - 1] + reach >= s.start
                if not close:  # and of those on earlier lines, and on later ones, without the settings between?
                    low, high = bisect.bisect_left(line_of[k], line(s)), bisect.bisect_right(line_of[k], line(s))
                    close = low > 0 and last[k][low - 1] + reach >= from_line(s) or high < len(first[k]) and first[k][high] <= after_line(s) + reach
                near += close
        if near:
            out.append((Span(s.start, s.end, f"linked_{s.kind}"), near))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, a count for each base kind, the linked parts' count, and the spans of every row of docs."""
    bounded_batches(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                value = value or ""
                base = base_spans(value)
                linked = linked_spans(value, base)
                every = sorted([*base, *(s for s, _ in linked)], key=lambda s: (s.start, s.kind not in KINDS, KINDS.index(s.kind) if s.kind in KINDS else s.kind, s.end))
                n = Counter(s.kind for s in base)
                rows.append((*(n[k] for k in KINDS), len(linked), joined(base), joined(every)))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in range(6)]
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], names=[key, "n_assign", "n_access", "n_hex", "n_linked", "base", "spans"])

    rows = docs.select(key, text)
    return rows.mapInArrow(find, f"`{key}` {rows.schema[key].dataType.simpleString()}, n_assign long, n_access long, n_hex long, n_linked long, base string, spans string")


MASK = "[SECRET]"


def redact_text(text: str, mask: str = MASK) -> str:
    """text with every reported span replaced; spans that overlap are replaced once."""
    base = base_spans(text)
    spans = sorted([*base, *(s for s, _ in linked_spans(text, base))])
    out, at, end = [], 0, 0
    for s in spans:
        if s.start >= end:
            out += [text[at : s.start], mask]
        at = end = max(end, s.end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the secrets of its texts masked; nulls stay null and other columns stay as they are."""
    bounded_batches(docs.sparkSession)
    place = docs.columns.index(text)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [x if x is None else redact_text(x) for x in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(values, batch.schema.field(place).type))

    return docs.mapInArrow(mask, docs.schema)
