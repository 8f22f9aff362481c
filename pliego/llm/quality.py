"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio of two multinomials.

The n-grams are the ``GRAM`` consecutive bytes of a text, hashed to ``BUCKETS`` buckets. One
multinomial is fitted to the texts of a trusted target (documents with good labels), one to the raw
corpus (every document); both are smoothed. A document's score is the sum of its n-grams' log
ratios over their number, and it is kept when the score is at or above a fixed threshold and no base
rule fails it. The verdict is a function of the text and the two tables: nothing is drawn at random.

The corpus table counts all documents. The target takes the ``TRUSTED`` labelled documents with
the smallest hashed ids (a bounded fit on labelled rows, as a parameter), so that the id set can
be broadcast and no text is shuffled. Counts are summed inside each task before the one shuffle, of
at most BUCKETS rows a task.

A null text has no words and fails the base rule, as an empty one does; repeated rows count as often
as they stand; without a trusted document every score is 0; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.llm.cluster import bounded_batches
from pliego.llm.words import Words, split_words, text_bytes, windows, word_hashes

GRAM, BUCKETS = 3, 1 << 16
#: Labelled documents in the trusted target, at most.
TRUSTED = 20_000
#: Pseudo-count of a bucket in either multinomial, as a share of one n-gram in each bucket.
SMOOTHING = 1.0
#: Mean log ratio (nats an n-gram) below which a document goes. Of the labelled documents that pass the base rules at
#: the 0.1 scale (3,534), each threshold from -1.0 to -0.05 rejects all 291 bad ones and none of the 3,243 good ones.
THRESHOLD = -0.4
#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOL = np.zeros(256, np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1
_FIRST_BYTE = np.ones(256, np.int64)
_FIRST_BYTE[0x80:0xC0] = 0  # continuation bytes: one code point has one byte that isn't


def gram_buckets(body: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte; the last GRAM - 1 start none."""
    x = body.astype(np.uint32)
    value = x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)
    return (value * np.uint32(2654435761)) >> np.uint32(16)


def _inside(at: np.ndarray, n: int) -> np.ndarray:
    """Which of the n windows lie inside one row."""
    keep = np.ones(n, bool)
    for j in range(1, GRAM):
        edge = at[1:-1] - j
        keep[edge[(edge >= 0) & (edge < n)]] = False
    return keep


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values over the byte range of each row."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def trusted_ids(labels: DataFrame, key: str, size: int = TRUSTED) -> list[int]:
    """Ids whose every label is good, at most size of them, by hashed id."""
    good = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("quality").alias("q")).filter("q = 1")
    return [r[0] for r in good.orderBy(F.xxhash64(key), key).limit(size).select(key).collect()]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", trusted: int = TRUSTED) -> np.ndarray:
    """The log ratio of target to corpus for each bucket."""
    spark = docs.sparkSession
    bounded_batches(spark)
    ids = spark.sparkContext.broadcast(np.array(sorted(trusted_ids(labels, key, trusted)), np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            body, at = text_bytes(batch.column(1))
            if len(body) < GRAM:
                continue
            bucket, keep = gram_buckets(body), _inside(at, len(body) - GRAM + 1)
            corpus += np.bincount(bucket[keep], minlength=BUCKETS)
            good = np.isin(batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False), ids.value) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            if good.any():
                target += np.bincount(bucket[keep & np.repeat(good, np.diff(at))[: len(keep)]], minlength=BUCKETS)
        seen = np.flatnonzero(corpus)
        yield pa.record_batch([pa.array(seen, pa.int32()), pa.array(corpus[seen]), pa.array(target[seen])], names=["bucket", "corpus", "target"])

    counts = docs.select(key, text).mapInArrow(count, "bucket int, corpus long, target long").groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target")).toPandas()
    corpus, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    corpus[counts.bucket], target[counts.bucket] = counts.corpus, counts.target
    if not target.sum():
        return np.zeros(BUCKETS)
    # The target is scaled to the corpus's size and both get the same pseudo-counts, so that a
    # bucket which neither has seen favours neither, and both multinomials have one total.
    scale = corpus.sum() / target.sum()
    return np.log((target + SMOOTHING) * scale / (corpus + SMOOTHING * scale))


def measures(column: pa.Array, ratio: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts and the score of every text."""
    body, at = text_bytes(column)
    words = split_words(body, at)
    hashes = word_hashes(body, words)
    n_words, first = words.counts(), words.first
    in_word = np.zeros(len(body) + 1, np.int64)
    in_word[words.start] += 1
    in_word[words.end[words.end <= len(body)]] -= 1
    in_word = np.cumsum(in_word)[: len(body)]
    out = {"n_words": n_words, "word_chars": row_sums(_FIRST_BYTE[body] * (in_word > 0), at), "n_symbols": row_sums(SYMBOL[body], at)}

    grams, gram_first = windows(hashes, first, 3)
    repeats, duplicates = np.zeros(len(n_words), np.int64), np.zeros(len(n_words), np.int64)
    newline = np.flatnonzero(body == 10)
    # A row has one line more than newlines; one that ends a row starts an empty line of that row.
    rows, row_of = np.arange(len(n_words)), np.searchsorted(at[1:], newline, side="right")
    starts, owner = np.concatenate([at[:-1], newline + 1]), np.concatenate([rows, row_of])
    by = np.lexsort((starts, owner))
    line_start, line_row = starts[by], owner[by]
    ends = np.concatenate([at[1:], newline])
    line_end = ends[np.lexsort((ends, owner))]
    has_word = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    line_start, line_end, line_row = line_start[has_word], line_end[has_word], line_row[has_word]
    line_hash = word_hashes(body, Words(line_start, line_end, np.zeros(1, np.int64)))
    line_first = np.searchsorted(line_row, np.arange(len(n_words) + 1))
    for r in range(len(n_words)):
        a, b = gram_first[r], gram_first[r + 1]
        if b - a > 1:
            _, inverse, counts = np.unique(grams[a:b], return_inverse=True, return_counts=True)
            if len(counts) < b - a:
                often = counts[inverse] > 1
                covered = np.zeros(b - a + 2, bool)
                for j in range(3):
                    covered[j : j + b - a] |= often
                repeats[r] = covered.sum()
        a, b = line_first[r], line_first[r + 1]
        if b - a > 1:
            duplicates[r] = b - a - len(np.unique(line_hash[a:b]))
    out |= {"n_dup_lines": duplicates, "n_repeat_words": repeats}

    n_grams = np.maximum(np.diff(at) - GRAM + 1, 0)
    score = np.zeros(len(n_words))
    if len(body) >= GRAM:
        value = np.zeros(len(body))
        value[: len(body) - GRAM + 1] = np.where(_inside(at, len(body) - GRAM + 1), ratio[gram_buckets(body)], 0.0)
        starts = np.minimum(at[:-1], len(body) - 1)
        score = np.where(n_grams > 0, np.add.reduceat(value, starts) / np.maximum(n_grams, 1), 0.0)
    out["score"] = score
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    return out


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """key, the base counts, score, base_failed and kept of every row of docs."""
    ratio = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text, key))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = measures(batch.column(1), ratio.value)
            kept = ~m["base_failed"] & (m["score"] >= threshold)
            yield pa.record_batch([batch.column(0), *(pa.array(m[c], pa.int64()) for c in longs), pa.array(m["base_failed"]), pa.array(kept), pa.array(m["score"])], names=[key, *longs, "base_failed", "kept", "score"])

    rows = docs.select(key, text)
    return rows.mapInArrow(measure, f"`{key}` {rows.schema[key].dataType.simpleString()}, {', '.join(f'{c} long' for c in longs)}, base_failed boolean, kept boolean, score double")


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    ratio = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text, key))
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = measures(batch.column(place), ratio.value)
            yield batch.filter(pa.array(~m["base_failed"] & (m["score"] >= threshold)))

    return docs.mapInArrow(keep, docs.schema)
