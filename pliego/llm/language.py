"""Language identification as inference of a multilingual mixture.

Fitting counts the character n-grams of every labelled training text by language (hashed to
``BUCKETS`` buckets a language). A text's words then are draws from a mixture of languages: the
likelihood of a word under a language is that of its n-grams, expectation-maximisation estimates the
text's language proportions, and of the nested sets of languages (largest proportion first) the one
with the greatest penalised likelihood is selected: a language stays out unless it raises twice
the log-likelihood by more than ``PENALTY`` times the logarithm of the number of words. Beside the nested
sets, dropping any one language of the chosen set is tried until none is better dropped. The largest
proportion in the selected set names the language. The score is that proportion times the language's
posterior against all others, for evidence that grows as the square root of the number of words.

A batch is worked on in slices of whole texts of ``SLICE`` bytes, one language at a time, so that a worker
holds one number a word and language of a slice. The model is one vector of ``BUCKETS`` a language:
it grows with the number of languages, not with the corpus. More than ``MAX_LANGUAGES`` different values
of lang are no languages but a column that needs cleaning, and an error before a task or the driver holds more.

A text that is null or has no letter is ``und`` with score 0; so is every text where nothing could be
learned. Ties go to the first language by code point. Repeated rows are repeated draws in fitting and
rows of their own in results. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.llm.cluster import bounded_batches
from pliego.llm.words import LOWER, U64, mix, split_words, text_bytes

#: Orders of the n-grams (bytes), and buckets they are hashed to.
ORDERS, BUCKETS = (2, 3, 4), 1 << 15
SMOOTHING = 0.5
#: Values of lang that a model may have: 0.6 GB of counts in a task, and half that in the model, at most.
MAX_LANGUAGES = 2500
#: Bytes of the texts whose words are worked on together; a longer text is a slice of its own.
SLICE = 1 << 20
#: Log-likelihood of one n-gram below the best language's, at most: one odd gram decides nothing.
FLOOR = 4.0
#: Words a text's sums are made of, at most rounds of EM and the change that ends it.
ROUNDS, CHANGE = 30, 1e-3
PENALTY = 3.0
#: Groups of tasks whose counts are added up before all are.
STEP = 64
#: Weight of a word's n-gram likelihoods, which overlap and so are not independent.
TEMPER = 1 / len(ORDERS)


def is_held_out(key: Column, mod: int = 4, rest: int = 2) -> Column:
    """Whether crc32 of the key as text leaves rest; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod == rest


def gram_buckets(body: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, byte position) of the n-grams of each order that lie in one row. White space is one symbol, A-Z are lower case, digits and ASCII marks are left out."""
    text = np.where(_BREAK[body], np.uint8(32), LOWER[body]).astype(U64)
    row_end = np.repeat(at[1:], np.diff(at))
    for n in ORDERS:
        if len(body) < n:
            return
        value = np.full(len(body) - n + 1, U64(n))
        for j in range(n):
            value = value << U64(8) | text[j : len(body) - n + 1 + j]
        where = np.flatnonzero((np.arange(len(value)) + n <= row_end[: len(value)]) & ~((text[: len(value)] == 32) & (text[n - 1 :] == 32)))
        yield (mix(value[where]) >> U64(64 - 15)).astype(np.int64), where


_BREAK = np.zeros(256, bool)
_BREAK[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _checked(languages: int) -> None:
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")


def fit(docs: DataFrame, text: str, lang: str, training: Column) -> tuple[list[str], np.ndarray]:
    """The languages, and each bucket's log-likelihood under each of them, from all training rows."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for one in set(langs):
                body, at = text_bytes(batch.column(0).filter(pa.array(langs == one)))
                total = counts.setdefault(one, np.zeros(BUCKETS, np.int64))
                _checked(len(counts))
                for bucket, _ in gram_buckets(body, at):
                    total += np.bincount(bucket, minlength=BUCKETS)
        yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array([n.tobytes() for n in counts.values()], pa.binary())], names=["lang", "counts"])

    def add_up(table: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS, np.int64)
        for counts in table["counts"].to_pylist():
            total += np.frombuffer(counts, np.int64)
        return pa.table({"lang": table["lang"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    rows = docs.filter(training & F.col(lang).isNotNull()).select(text, lang)
    # A row a task and language, added up in two steps: no language's rows meet in one task at first.
    parts = rows.mapInArrow(count, "lang string, counts binary")
    for by in (["lang", F.spark_partition_id() % STEP], ["lang"]):
        parts = parts.groupBy(*by).applyInArrow(add_up, "lang string, counts binary")
    found = []
    for r in parts.toLocalIterator():
        found.append((r.lang, r.counts))
        _checked(len(found))
    found.sort(key=lambda x: x[0])
    langs = [x for x, _ in found]
    counts = np.array([np.frombuffer(n, np.int64) for _, n in found], np.float64).reshape(len(langs), BUCKETS)
    total = counts.sum(1, keepdims=True)
    likelihood = np.log((counts + SMOOTHING) / (total + SMOOTHING * BUCKETS)) if langs else counts
    if langs:
        likelihood = np.maximum(likelihood, likelihood.max(0) - FLOOR)
    return langs, likelihood.astype(np.float32)


def mixture(words: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions, and the log-likelihood, that EM finds for words(word, language) of log-likelihoods."""
    top = words.max(1, keepdims=True)
    given = np.exp(words - top)
    share = np.full(words.shape[1], 1 / words.shape[1])
    for _ in range(ROUNDS):
        joint = given * share
        now = (joint / joint.sum(1, keepdims=True)).mean(0)
        moved = np.abs(now - share).max()
        share = now
        if moved < CHANGE:
            break
    return share, float(np.log((given * share).sum(1)).sum() + top.sum())


def select(words: np.ndarray) -> tuple[np.ndarray, float]:
    """The proportions of the selected set of languages, 0 for the others; and the score."""
    alone = words.sum(0, dtype=np.float64)
    best = int(alone.argmax())
    chosen = np.zeros(words.shape[1])
    chosen[best] = 1.0
    # No set can do better than each word under its own best language.
    penalty = PENALTY * np.log(max(2, len(words)))
    if 2 * (words.max(1).sum(dtype=np.float64) - alone[best]) > penalty:
        share, _ = mixture(words)
        order = np.argsort(-share, kind="stable")
        value = 2 * alone[best]

        def better(some: np.ndarray) -> bool:
            nonlocal value, chosen
            part, fit_n = mixture(words[:, some])
            if 2 * fit_n - (len(some) - 1) * penalty <= value:
                return False
            value = 2 * fit_n - (len(some) - 1) * penalty
            chosen = np.zeros(words.shape[1])
            chosen[some] = part
            return True

        for n in range(2, len(order) + 1):
            if share[order[n - 1]] < 1 / (2 * len(words)):
                break
            better(order[:n])
        now = np.flatnonzero(chosen)
        while len(now) > 2 and any(better(np.delete(now, i)) for i in range(len(now))):
            now = np.flatnonzero(chosen)
    top = int(chosen.argmax())
    # Evidence of the words that the language claims: overlapping grams and words aren't independent.
    doubt = np.exp(np.minimum(0.0, (alone - alone[top]) / np.sqrt(len(words)))) if np.count_nonzero(chosen) == 1 else np.eye(len(chosen))[top]
    return chosen, float(chosen[top] / doubt.sum())


def infer(column: pa.Array, likelihood: np.ndarray) -> list[tuple[np.ndarray, float] | None]:
    """The language proportions and the score of each text; None where there is no letter."""
    size = np.concatenate([[0], np.cumsum(np.diff(text_bytes(column)[1]))])
    out: list[tuple[np.ndarray, float] | None] = []
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(size, size[a] + SLICE, side="right")) - 1)
        out += _infer(column.slice(a, b - a), likelihood)
        a = b
    return out


def _infer(column: pa.Array, likelihood: np.ndarray) -> list[tuple[np.ndarray, float] | None]:
    body, at = text_bytes(column)
    if not len(body):
        return [None] * (len(at) - 1)
    letters = np.add.reduceat(np.append(_LETTER[body], False).astype(np.int64), at[:-1]) * (np.diff(at) > 0)
    words = split_words(body, at)
    n_words = len(words.start)
    sums = np.zeros((n_words, len(likelihood)), np.float32)
    # The n-grams that start in a word, or in the space before it, are that word's.
    owner = np.minimum(np.searchsorted(words.start, np.arange(len(body)) + 1, side="right") - 1 + IS_SPACE_INT[body], max(0, n_words - 1))
    edges = np.searchsorted(owner, np.arange(n_words + 1))
    edges[0] = 0
    grams = list(gram_buckets(body, at))
    total = np.empty(len(body) + 1)
    for x in range(len(likelihood)):
        total[:] = 0
        for bucket, where in grams:
            total[where + 1] += likelihood[x][bucket]
        np.cumsum(total, out=total)
        sums[:, x] = (total[edges[1:]] - total[edges[:-1]]) * TEMPER
    out: list[tuple[np.ndarray, float] | None] = []
    for r in range(len(at) - 1):
        a, b = words.first[r], words.first[r + 1]
        has = letters[r] > 0 or b > a and any(map(str.isalpha, column[r].as_py()))
        out.append(select(sums[a:b]) if has and b > a else None)
    return out


IS_SPACE_INT = np.zeros(256, np.int64)
IS_SPACE_INT[[0x20, 9, 10, 11, 12, 13]] = 1


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """key, held_out, lang_pred, score and languages (the selected set with proportions) of every row of docs."""
    held_out = is_held_out(F.col(key))
    langs, likelihood = fit(docs, text, lang, ~held_out)
    model = docs.sparkSession.sparkContext.broadcast((langs, likelihood))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, likelihood = model.value
        for batch in batches:
            found = infer(batch.column(2), likelihood) if langs else [None] * batch.num_rows
            names = [langs[int(f[0].argmax())] if f else "und" for f in found]
            scores = [min(1.0, f[1]) if f else 0.0 for f in found]
            sets = [",".join(f"{langs[i]}:{f[0][i]:.3f}" for i in np.argsort(-f[0], kind="stable") if f[0][i] > 0) if f else "" for f in found]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string())], names=[key, "held_out", "lang_pred", "score", "languages"])

    rows = docs.select(F.col(key), held_out.alias("held_out"), F.col(text))
    return rows.mapInArrow(predict, f"`{key}` {rows.schema[key].dataType.simpleString()}, held_out boolean, lang_pred string, score double, languages string")
