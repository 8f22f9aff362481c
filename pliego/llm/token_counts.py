"""Token counts of whole texts by a two-tier lookup that never shuffles a pre-token.

A text is cut before its single spaces, where the library's own pre-tokenizer always ends a pre-token, so that
lengths add up whatever stands between: a pre-token here is a word with what clings to it and the space before
it. Tier one is a compact hash table of frequent pre-tokens and their lengths in tokens, made once and
broadcast; tier two is each worker's own bounded cache, filled by the library's encoder. Both tiers hold
what the library returns, so counts never depend on what is in either. Texts where a space follows
other white space are cut by the library's pattern instead, and go to the library whole where a code point is
in them on which its classes and the matcher's may differ, or a special string.

Nulls count as empty texts, empty texts have no tokens, repeated rows are counted each, an empty
table gives an empty table, and other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import os
import string
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pliego.llm.cluster import bounded_batches, saved

#: Pre-tokens in the broadcast table, in one partition's summary, and in a worker's cache. These
#: bound memory and change no count. A cached pre-token has CACHED_CHARS characters at most.
TABLE_SIZE, SUMMARY_SIZE, CACHE_SIZE, CACHED_CHARS = 1 << 15, 1 << 12, 1 << 20, 64
#: Summaries merged by one task.
FAN_IN = 32
#: A text of more characters than this is cut into stretches of so many, not into one list.
LONG_TEXT = 1 << 20
#: White space before a space.
RUNS = ("  ", "\n ", "\t ", "\r ", "\v ", "\f ")
OTHER_RUNS = regex.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff] ")

#: Code points on which the matcher below and the library's own may disagree on letters, numbers and spaces,
#: as they follow different Unicode versions (a test holds both against each other); a text with one of them goes to the library whole.
OTHER_CODE_POINTS = regex.compile("[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7c0-\ua7ff\uab6c\uab6d\U00010000-\U0001efff\U00020000-\U0010ffff]")


#: Characters after which, and before which, a mark or a line's end is always a pre-token of its own.
WORD_END, MARKS = frozenset(string.ascii_letters + string.digits), frozenset(string.punctuation)
INNER = MARKS | WORD_END


@lru_cache(1)
def encoder_of(path: str, table: tuple) -> Encoder:
    """This worker's encoder, with what it has learned in earlier tasks."""
    return Encoder(path, dict(table))


class Encoder:
    """The library's tokenizer with the two tiers before it."""

    def __init__(self, path: str, table: dict[str, int]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(PATTERN)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = special
        self.lengths = Lengths(self.whole, {})
        self.spaced = Spaced(lambda word: self.whole(" " + word), table, self.lengths)

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pieces(self, text: str) -> Iterator[str]:
        return map(regex.Match.group, self.pattern.finditer(text)) if len(text) > LONG_TEXT else iter(self.pattern.findall(text))

    def count(self, text: str) -> int:
        if any(x in text for x in self.special):
            return self.whole(text)
        if any(x in text for x in RUNS) or not text.isascii() and OTHER_RUNS.search(text):
            if OTHER_CODE_POINTS.search(text):
                return self.whole(text)
            return sum(map(self.lengths.__getitem__, self.pieces(text)))
        stretches = words(text)
        return self.lengths[next(stretches)] + sum(map(self.spaced.__getitem__, stretches)) if text else 0


def words(text: str) -> Iterator[str]:
    """What stands between the spaces of a text."""
    if len(text) <= LONG_TEXT:
        yield from text.split(" ")
        return
    at = 0
    while at >= 0:
        end = text.find(" ", at + LONG_TEXT)
        yield from (text[at:] if end < 0 else text[at:end]).split(" ")
        at = end + 1 if end >= 0 else -1


class Lengths(dict):
    """Tokens of a pre-token: the broadcast table first, then what this worker has met."""

    def __init__(self, encode, table: dict[str, int]):
        super().__init__(table)
        self.encode, self.table = encode, table

    def __missing__(self, piece: str) -> int:
        n = self.encode(piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_SIZE + len(self.table):
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n


class Spaced(Lengths):
    """Tokens of a word after its space. A word that ends in a mark, or a line, adds up from its parts, so that only the word takes room."""

    def __init__(self, encode, table: dict[str, int], bare: Lengths):
        super().__init__(encode, table)
        self.bare = bare

    def __missing__(self, word: str) -> int:
        if word[-1:] in MARKS and word[-2:-1] in WORD_END:
            return self[word[:-1]] + self.bare[word[-1]]
        head, line, tail = word.partition("\n")
        if line and head[-1:] in INNER and tail[:1] in INNER:
            return self[head] + self.bare[line] + self.bare[tail]
        return super().__missing__(word)


def _top(counts: Counter, size: int) -> list[tuple[str, int]]:
    return heapq.nsmallest(size, counts.items(), key=lambda x: (-x[1], x[0]))


def _summary(counts: Counter, size: int) -> pa.RecordBatch:
    top = _top(counts, size)
    return pa.record_batch([pa.array([[k for k, _ in top]], pa.list_(pa.string())), pa.array([[n for _, n in top]], pa.list_(pa.int64()))], names=["piece", "n"])


def frequent_words(texts: DataFrame, size: int = TABLE_SIZE) -> list[str]:
    """Frequent pre-tokens of all texts, without their space, from one bounded summary a partition, merged as a tree."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(words(text or ""))
            if len(counts) > 64 * SUMMARY_SIZE:
                counts = Counter(dict(_top(counts, 16 * SUMMARY_SIZE)))
        yield _summary(Counter({k: n for k, n in counts.items() if len(k) <= CACHED_CHARS}), SUMMARY_SIZE)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for keys, ns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, n in zip(keys, ns, strict=True):
                    counts[k] += n
        yield _summary(counts, 4 * SUMMARY_SIZE)

    schema = "piece array<string>, n array<long>"
    # Bounded summaries go through the scratch folder, FAN_IN to a task: there is no exchange, and no text's pre-token leaves its task.
    summaries = saved(texts.mapInArrow(summarise, schema))
    while (parts := summaries.rdd.getNumPartitions()) > 1 and summaries.count() > FAN_IN:
        summaries = saved(summaries.coalesce(-(-parts // FAN_IN)).mapInArrow(merge, schema))
    counts: Counter = Counter()
    for row in summaries.collect():  # FAN_IN rows at most, each of a bounded size
        for k, n in zip(row.piece, row.n, strict=True):
            counts[k] += n
    return [k for k, _ in _top(counts, size)]


def count_tokens(docs: DataFrame, path: str, max_tokens: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every row of docs."""
    spark = docs.sparkSession
    bounded_batches(spark)
    encoder = Encoder(path, {})
    table = {word: encoder.whole(" " + word) for word in frequent_words(docs.select(text))}
    shared = spark.sparkContext.broadcast(tuple(sorted(table.items())))  # TABLE_SIZE short strings at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, shared.value)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens = [encoder.count(x) for x in texts]
            yield pa.record_batch([batch.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > max_tokens for n in tokens], pa.bool_())], names=[key, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(key, text)
    return rows.mapInArrow(count, f"`{key}` {rows.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
