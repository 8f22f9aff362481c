"""Benchmark decontamination by template canonicalisation.

Documents and benchmark items become sequences of template tokens: words in lower case (of every
script whose letters take two bytes at most) without edge punctuation, with numbers, units and names replaced by typed placeholders. A hash join of
``WINDOW``-token template windows finds where a document may hold an item; the hits of one item that
stand together in a document, no more than ``GAP`` tokens apart, make a passage. It is contamination when
it covers enough of the item (all of it up to ``WHOLE`` tokens, beyond that ``MIN_WORDS`` tokens or ``MIN_SHARE``)
and its slots are consistent: each value in a slot of the item must stand for one value in the
document, and no two for the same, as in a question asked again with other parameters.

Items of one template whose slots are equal among themselves in the same places are one in the
join, which therefore meets a popular template once a window, not once an item. A passage that words
one of them verbatim is reported for that item, any other for the first of them; n_items tells how many
the template has.

The benchmark side of the join is broadcast in blocks of a bounded number of words. One block is
joined without an action; of more, each is searched and its finds are written before the next is
read, so that driver and executors hold one block at a time, and a benchmark of any size goes
through, one pass over the documents each. No document text is shuffled.

Template windows with fewer than ``LITERALS`` plain words would match anything and are not joined. All
windows are joined on their words in lower case as well, so that a copy in any case is found however
many of its words are numbers, units or names.

Null texts and items hold nothing. Items shorter than a window are looked for as a whole, by their
words in lower case. Repeated rows are judged each; of repeated items the first is reported. Empty
tables give an empty result. Other columns are not read, or kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pliego.llm.cluster import bounded_batches, saved
from pliego.llm.words import LOWER, U64, Words, mix, split_words, text_bytes, text_hashes, windows, word_hashes

WINDOW, LITERALS = 5, 3
#: Words of an item that a passage must cover, as a share, or in number (whichever asks for less); up to WHOLE, all.
MIN_SHARE, MIN_WORDS, WHOLE = 0.6, 13, 8
#: Tokens of a document between two windows of one passage, at most.
GAP = 8
#: Share of slot occurrences that one consistent assignment must explain.
MIN_CONSISTENT = 0.8
#: Words of benchmark items that are broadcast at once, about.
BLOCK = 1_000_000

#: Units that a template treats as one slot.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons "
    "s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents percent hz khz mhz ghz kb mb gb tb w kw mw v kv a ma j kj cal kcal mph kmh kph".split()
)
NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(%|[a-z]{1,3})?$")
EDGE = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
PLAIN, NUM, UNIT, NAME = range(4)
SLOT_TOKEN = mix(np.arange(4, dtype=U64) + U64(0x51A7))

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_DIGIT = np.zeros(256, np.int32)
_DIGIT[0x30:0x3A] = 1
_STOP, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".!?:")] = True
_CLOSE[list(b"\"')]")] = True


def _lower_pairs() -> np.ndarray:
    """The lower case of each code point of two bytes, where that has two bytes as well; else itself."""
    out = np.arange(1 << 11)
    for cp in range(0x80, 1 << 11):
        low = chr(cp).lower()
        if len(low) == 1 and 0x80 <= ord(low) < 1 << 11:
            out[cp] = ord(low)
    return out


_LOWER_PAIRS = _lower_pairs()


def _lowered(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """body with the capitals of one and two bytes in lower case, and which bytes end a capital."""
    low = LOWER[body]
    upper = low != body
    lead = np.flatnonzero((body[:-1] >= 0xC2) & (body[:-1] <= 0xDF))
    cp = (body[lead].astype(np.int64) & 0x1F) << 6 | body[lead + 1] & 0x3F
    other = _LOWER_PAIRS[cp]
    lead, other = lead[other != cp], other[other != cp]
    low[lead], low[lead + 1] = 0xC0 | other >> 6, 0x80 | other & 0x3F
    upper[lead + 1] = True
    return low, upper


def _edges(body: np.ndarray) -> np.ndarray:
    """Bytes of ASCII punctuation, typographic quotes, dashes and dots, guillemets and inverted marks."""
    edge = _PUNCT[body]
    lead = np.flatnonzero((body[:-2] == 0xE2) & (body[1:-1] == 0x80) & (body[2:] >= 0x90) & (body[2:] <= 0xA6))
    for j in range(3):
        edge[lead + j] = True
    lead = np.flatnonzero((body[:-1] == 0xC2) & np.isin(body[1:], np.array([0xA1, 0xAB, 0xBB, 0xBF], np.uint8)))
    for j in range(2):
        edge[lead + j] = True
    return edge


def _plain_hashes(values: list[str]) -> np.ndarray:
    body, at = text_bytes(pa.array(values))
    return text_hashes(body, at)


UNIT_HASHES = np.sort(_plain_hashes(sorted(UNITS)))


class Template(NamedTuple):
    """Template tokens of a batch of texts: hash, hash of the word itself, slot and byte range of each, and each row's first."""

    token: np.ndarray
    literal: np.ndarray
    slot: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def template(body: np.ndarray, at: np.ndarray) -> Template:
    words = split_words(body, at)
    n = len(words.start)
    if not n:
        none = np.zeros(0, np.int64)
        return Template(none.astype(U64), none.astype(U64), none, none, none, words.first)
    low, upper = _lowered(body)
    inner = ~_edges(body)
    inner_at = np.flatnonzero(inner)
    rank = np.concatenate([[0], np.cumsum(inner)])
    empty = rank[words.start] == rank[words.end]
    inner_at = np.append(inner_at, len(body))
    start = np.where(empty, words.start, inner_at[rank[words.start]])
    end = np.where(empty, words.start, inner_at[rank[words.end] - 1] + 1)
    token = word_hashes(low, Words(start, end, words.first))
    slot = np.zeros(n, np.int8)
    place = np.minimum(np.searchsorted(UNIT_HASHES, token), len(UNIT_HASHES) - 1)
    slot[UNIT_HASHES[place] == token] = UNIT
    digits = np.concatenate([[0], np.cumsum(_DIGIT[body])])
    numeric = digits[end] > digits[start]
    capitals = np.concatenate([[0], np.cumsum(upper)])
    letter = np.minimum(start + (body[np.minimum(start, len(body) - 1)] >= 0xC2), len(body) - 1)
    named = upper[letter] & (capitals[end] - capitals[start] == 1) & (end - letter > 1) & ~numeric & (slot == PLAIN)
    last = body[words.end - 1]
    before = body[np.maximum(words.end - 2, words.start)]
    ends = _STOP[last] | _CLOSE[last] & _STOP[before]
    initial = np.zeros(n, bool)
    initial[1:] = ends[:-1]
    initial[words.first[:-1][words.counts() > 0]] = True
    slot[named & ~initial] = NAME
    for i in np.flatnonzero(numeric):
        if NUMBER.match(EDGE.sub("", body[words.start[i] : words.end[i]].tobytes().decode()).lower()):
            slot[i] = NUM
    literal = token
    token = np.where(slot > 0, SLOT_TOKEN[slot], token)
    keep = ~empty
    kept = np.concatenate([[0], np.cumsum(keep)])
    return Template(token[keep], literal[keep], slot[keep], words.start[keep], words.end[keep], kept[words.first])


def template_windows(t: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window hashes, the token at which each starts, and which have enough plain words."""
    value, first = windows(t.token, t.first, WINDOW)
    starts = np.arange(len(value)) + np.repeat(t.first[:-1] - first[:-1], np.diff(first))
    plain = np.concatenate([[0], np.cumsum(t.slot == PLAIN)])
    return value, starts, plain[starts + WINDOW] - plain[starts] >= LITERALS


def literal_windows(t: Template) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of windows of words in lower case, and the token at which each starts."""
    value, first = windows(t.literal, t.first, WINDOW)
    return value, np.arange(len(value)) + np.repeat(t.first[:-1] - first[:-1], np.diff(first))


class Index:
    """Windows of items by their hash."""

    def __init__(self, value: np.ndarray, item: np.ndarray, place: np.ndarray):
        by = np.argsort(value, kind="stable")
        self.value, self.item, self.place = value[by], item[by], place[by]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.value & U64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """token, item and place of each window of the index that a value meets."""
        maybe = np.flatnonzero(self.filter[(value & U64((1 << 20) - 1)).astype(np.int64)])
        low, high = np.searchsorted(self.value, value[maybe], side="left"), np.searchsorted(self.value, value[maybe], side="right")
        n = high - low
        where = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)
        return np.repeat(starts[maybe], n), self.item[where], self.place[where]


def _equalities(values: list) -> list[int]:
    """For each value where it stands first."""
    first: dict = {}
    return [first.setdefault(v, i) for i, v in enumerate(values)]


class Items:
    """A block of benchmark items, as an index of template windows. Items of one template count as one."""

    def __init__(self, ids: list, texts: list[str | None]):
        body, at = text_bytes(pa.array(texts, pa.string()))
        t = template(body, at)
        raw = body.tobytes()
        words = [[_shown(raw, t, i) for i in range(t.first[r], t.first[r + 1])] for r in range(len(ids))]
        slots = [t.slot[t.first[r] : t.first[r + 1]] for r in range(len(ids))]
        groups: dict[tuple, list[int]] = defaultdict(list)
        for r in range(len(ids)):
            if words[r]:
                shape = [(int(k), w if k else None) for k, w in zip(slots[r], words[r], strict=True)]
                # Items that are shorter than a window are only found verbatim, and so are no template.
                own = t.literal if len(words[r]) < WINDOW else t.token
                groups[own[t.first[r] : t.first[r + 1]].tobytes(), tuple(_equalities(shape)) if (slots[r] > PLAIN).any() else ()].append(r)
        one = np.array([rows[0] for rows in groups.values()], np.int64)
        self.ids = [ids[r] for r in one]
        self.n_items = [len(rows) for rows in groups.values()]
        self.length = np.diff(t.first)[one]
        self.words, self.slots = [words[r] for r in one], [slots[r] for r in one]
        self.verbatim = {(g, tuple(words[r])): ids[r] for g, rows in enumerate(groups.values()) if len(rows) > 1 for r in reversed(rows)}
        at_row = t.first[one]
        length = self.length
        where = np.arange(length.sum()) + np.repeat(at_row - (np.cumsum(length) - length), length)
        first = np.concatenate([[0], np.cumsum(length)])
        t = Template(*(x[where] for x in t[:5]), first)
        value, starts, ok = template_windows(t)
        row = np.searchsorted(first, starts, side="right") - 1
        self.templates = Index(value[ok], row[ok], (starts - first[row])[ok])
        self.literals = Index(literal_windows(t)[0], row, starts - first[row])
        self.short = {}
        for n in np.unique(length[length < WINDOW]).tolist():
            rows = np.flatnonzero(length == n)
            part = Template(*(x[(first[rows][:, None] + np.arange(n)).ravel()] for x in t[:5]), np.arange(len(rows) + 1) * n)
            self.short[n] = Index(windows(part.literal, part.first, n)[0], rows, np.zeros(len(rows), np.int64))

    def hits(self, t: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """token, item and place in the item of each joined window."""
        value, starts, ok = template_windows(t)
        found = [self.templates.hits(value[ok], starts[ok]), self.literals.hits(*literal_windows(t))]
        for n, index in self.short.items():
            value, first = windows(t.literal, t.first, n)
            found.append(index.hits(value, np.arange(len(value)) + np.repeat(t.first[:-1] - first[:-1], np.diff(first))))
        token, item, place = (np.concatenate(x) for x in zip(*found, strict=True))
        return token, item, place

    def named(self, item: int, words: list[str]) -> object:
        """The id of the item of this template that reads so, else of the first."""
        return self.verbatim.get((item, tuple(words)), self.ids[item])


def _shown(raw: bytes, t: Template, i: int) -> str:
    return EDGE.sub("", raw[t.start[i] : t.end[i]].decode()).lower()


def needed(length: np.ndarray | int) -> np.ndarray:
    """Tokens of an item of some length that a passage must cover."""
    return np.where(np.asarray(length) <= WHOLE, length, np.maximum(WHOLE, np.ceil(np.minimum(MIN_WORDS, MIN_SHARE * np.asarray(length))))).astype(np.int64)


class Passage(NamedTuple):
    item: int
    covered: int
    share: float
    verbatim: float
    consistent: float
    start: int
    end: int
    id: object
    n_items: int


def consistency(pairs: list[tuple[int, str, str]]) -> float:
    """The share of (slot, item value, document value) that a one-to-one assignment of values explains."""
    if not pairs:
        return 1.0
    count = Counter(pairs)
    used: set[tuple[int, str]] = set()
    given: set[tuple[int, str]] = set()
    good = 0
    for (slot, own, other), n in sorted(count.items(), key=lambda x: (-x[1], x[0])):
        if (slot, own) not in given and (slot, other) not in used:
            given.add((slot, own))
            used.add((slot, other))
            good += n
    return good / len(pairs)


def passages(t: Template, row: int, tokens: list[int], places: list[int], item: int, items: Items, raw: bytes) -> Passage | None:
    """The best passage of one item in one row, from its hits in the order of tokens."""
    length = int(items.length[item])
    n = min(WINDOW, length)
    best = None
    at = 0
    for i in range(1, len(tokens) + 1):
        if i == len(tokens) or tokens[i] - tokens[i - 1] > n + GAP:
            run = list(zip(tokens[at:i], places[at:i], strict=True))
            at = i
            covered: dict[int, int] = {}
            often = Counter(token - place for token, place in run)  # a stray window doesn't displace the passage's own
            for token, place in sorted(run, key=lambda x: (-often[x[0] - x[1]], x)):
                for j in range(n):
                    covered.setdefault(place + j, token + j)
            words = [_shown(raw, t, covered[place]) if place in covered else "" for place in range(length)]
            same = sum(w == own for w, own in zip(words, items.words[item], strict=True))
            pairs = [(int(items.slots[item][place]), items.words[item][place], words[place]) for place in covered if items.slots[item][place] != PLAIN]
            found = Passage(item, len(covered), len(covered) / length, same / len(covered), consistency(pairs), int(t.start[run[0][0]]), int(t.end[min(run[-1][0] + n, int(t.first[row + 1])) - 1]), items.named(item, words), items.n_items[item])
            if best is None or (found.covered, found.consistent) > (best.covered, best.consistent):
                best = found
    return best


def contaminated(p: Passage, length: int) -> bool:
    return p.covered >= needed(length) and p.consistent >= MIN_CONSISTENT and (length >= WINDOW or p.verbatim == 1)


def find(column: pa.Array, items: Items) -> list[list[Passage]]:
    """The contaminating passages of each text."""
    body, at = text_bytes(column)
    out: list[list[Passage]] = [[] for _ in range(len(at) - 1)]
    if not len(body):
        return out
    t = template(body, at)
    token, item, place = items.hits(t)
    if not len(token):
        return out
    row = np.searchsorted(t.first, token, side="right") - 1
    by = np.lexsort((place, token, item, row))
    token, item, place, row = token[by], item[by], place[by], row[by]
    begins = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1])]))
    ends = np.append(begins[1:], len(row))
    # Hits that can't cover enough, even without overlap, are left at once.
    enough = WINDOW * (ends - begins) >= needed(items.length[item[begins]])
    raw = body.tobytes()
    for a, b in zip(begins[enough].tolist(), ends[enough].tolist(), strict=True):
        r, i = int(row[a]), int(item[a])
        p = passages(t, r, token[a:b].tolist(), place[a:b].tolist(), i, items, raw)
        if p and contaminated(p, int(items.length[i])):
            out[r].append(p._replace(start=p.start - int(at[r]), end=p.end - int(at[r])))
    return out


def blocks(benchmark: DataFrame, text: str = "text", item: str = "item_id", size: int = BLOCK) -> Iterator[tuple[bool, Items]]:
    """Whether it is the only one, and the benchmark as indexes of about size words each. Equal items fall into one row, so a block's size follows from the hash."""
    rows = benchmark.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(item).alias("item"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // (6 * size)) or 1
    for b in range(n):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect()
        part.sort(key=lambda r: (r.item is None, r.item or 0, r.text))
        yield n == 1, Items([r.item for r in part], [r.text for r in part])


def _searched(rows: DataFrame, schema, benchmark: DataFrame, item: str, size: int, search) -> Iterator[DataFrame]:
    """rows, as the last result if search gives rows of docs, searched for one block after the other."""
    spark = rows.sparkSession
    bounded_batches(spark)
    for only, items in blocks(benchmark, item=item, size=size):
        shared = spark.sparkContext.broadcast(items)
        found = rows.mapInArrow(search(shared), schema)
        if only:
            yield found
        else:
            found = saved(found)
            shared.destroy()
            yield found
        rows = found if rows.schema == found.schema else rows


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", size: int = BLOCK) -> DataFrame:
    """A row for each document and template found in it: key, item, n_items, covered, share, verbatim, consistent, start and end (bytes)."""
    rows = docs.select(key, text)
    item_type = benchmark.schema[item].dataType.simpleString()
    item_kind = to_arrow_type(benchmark.schema[item].dataType)
    names = [key, item, "covered", "share", "verbatim", "consistent", "start", "end", "n_items"]
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, `{item}` {item_type}, covered long, share double, verbatim double, consistent double, start long, end long, n_items long"

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                found = find(batch.column(1), items)
                row = [r for r, ps in enumerate(found) for _ in ps]
                ps = [p for x in found for p in x]
                values = [[getattr(p, c) for p in ps] for c in names[2:]]
                kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.record_batch([batch.column(0).take(pa.array(row, pa.int64())), pa.array([p.id for p in ps], item_kind), *(pa.array(v, k) for v, k in zip(values, kinds, strict=True))], names=names)

        return run

    return reduce(DataFrame.unionByName, _searched(rows, schema, benchmark, item, size, search))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", size: int = BLOCK) -> DataFrame:
    """The rows of docs that hold no item, with all their columns."""
    place = docs.columns.index(text)

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                yield batch.filter(pa.array([not x for x in find(batch.column(place), items)], pa.bool_()))

        return run

    *_, kept = _searched(docs, docs.schema, benchmark, item, size, search)
    return kept
