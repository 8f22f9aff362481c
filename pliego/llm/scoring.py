"""Scoring by prediction by partial matching, beside an add-one word model.

The byte model has the contexts of orders 0 to ``ORDER``. Escape probabilities follow PPM's method C (an
escape counts as often as the context has distinct symbols), and symbols that a longer context has
already offered are excluded below it. A text ends with an end symbol, and starts after ``ORDER`` of
them: probabilities of all texts sum to one.

Every context of the training rows counts, however rare. They lie in ranges by a hash of their two
nearest bytes, so that a range holds all contexts of orders 2 and more that a descent through it
meets; the counts of byte pairs (65,536 at most) give the two orders below and are broadcast. Texts
are dealt into chunks of about ``CHUNK`` characters. A chunk asks each range once for its distinct
grams (ORDER bytes and a symbol), gets back the log-probability of each after the whole descent
(escapes, exclusions, the uniform order -1), and adds them up for each of its texts.
``Trie`` is the same model over any choice of contexts in one process, and ``score_adaptive`` the
same learning as it reads, for one text at a time.

The word model counts every training token. Words above 1/``HEAD`` of all tokens (at most HEAD of
them) are broadcast; the others' counts meet the texts that hold them in packed rows, one for each
task and hash range, so no word of a text is a shuffled row and nothing of the corpus is collected.

Texts in A-Z are lowered for both models. Nulls count as empty texts, which consist of an end alone.
Equal texts are one in the second exchange, however often they stand; the rows of one that many documents
share are dealt over tasks when they meet its answer. Empty tables give empty
results. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.llm.cluster import bounded_batches, salted_join, saved
from pliego.llm.words import LOWER, U64, split_words, text_bytes, text_hashes, windows, word_hashes

#: Bytes of context; the end symbol, no byte of UTF-8.
ORDER, END = 4, 0xFF
#: Words whose counts are broadcast, at most.
HEAD = 1 << 19
#: Tokens of the corpus for each range of the exchanges, about; n-grams and words a task holds.
RANGE_TOKENS, HELD = 4_000_000, 3_000_000
#: Texts for each range in which the words' answers are added up.
RANGE_TEXTS = 20_000
#: Characters of the texts that ask for their grams together, about.
CHUNK = 2_500_000
#: Grams of the training rows in one range for each task that answers its questions: a frequent pair of bytes has several.
PART_GRAMS = 100_000_000
#: Hash of the end token: no word's, as a word's hash comes from its bytes.
END_TOKEN = 0x7E57_E4D0_0BAD_F00D


def is_held_out(key: Column, mod: int = 7, rest: int = 2) -> Column:
    """Whether crc32 of the key as text leaves rest; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod == rest


def padded(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowered rows, each after ORDER end symbols and before one; where each row's first symbol is, and the total."""
    n, size = np.diff(at), len(at) - 1
    out = np.full(len(body) + size * (ORDER + 1), END, np.uint8)
    shift = np.arange(1, size + 1) * ORDER + np.arange(size)
    out[np.arange(len(body)) + np.repeat(shift, n)] = LOWER[body]
    return out, np.append(at[:-1] + shift, len(out) + ORDER)


def symbols_at(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of the symbols to predict: each row's bytes and its end."""
    n = np.diff(at) + 1
    begin = np.cumsum(n) - n
    return np.arange(n.sum()) + np.repeat(first[:-1] - begin, n)


def _unique_counts(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.add.reduceat(counts, begins) if len(begins) else counts[:0]


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (((keys * U64(0x9E3779B97F4A7C15)) >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def gram_range(grams: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each gram, by the two nearest bytes of its context."""
    return range_of(grams >> U64(8) & U64(0xFFFF), ranges)


def grams_of(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram of each symbol to predict, and where each row's begin."""
    text, first = padded(body, at)
    place = symbols_at(at, first)
    value = np.zeros(len(place), U64)
    for j in range(ORDER, -1, -1):
        value = value << U64(8) | text[place - j]
    return value, np.append(0, np.cumsum(np.diff(at) + 1))


class Tally:
    """Counts of 64-bit keys, summed when many are held."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        part = _unique_counts(keys, counts)
        self.parts.append(part)
        self.held += len(part[0])
        if self.held > HELD:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) != 1:
            self.parts = [_unique_counts(np.concatenate([k for k, _ in self.parts]), np.concatenate([n for _, n in self.parts]))] if self.parts else [(np.zeros(0, U64), np.zeros(0, np.int64))]
        self.held = len(self.parts[0][0])
        return self.parts[0]


_COUNTS = "kind int, range int, keys binary, counts binary"


def _count_rows(kind: int, keys: np.ndarray, counts: np.ndarray, place: np.ndarray, ranges: int) -> pa.RecordBatch:
    by = np.argsort(place, kind="stable")
    at = np.searchsorted(place[by], np.arange(ranges + 1))
    used = np.flatnonzero(np.diff(at))
    return pa.record_batch([pa.array([kind] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array([keys[by[at[r] : at[r + 1]]].tobytes() for r in used], pa.binary()), pa.array([counts[by[at[r] : at[r + 1]]].astype(np.int64).tobytes() for r in used], pa.binary())], names=["kind", "range", "keys", "counts"])


WORDS_KIND, GRAMS_KIND = 0, 1


def corpus_counts(texts: DataFrame, ranges: int) -> DataFrame:
    """Counts of all tokens and of all (ORDER + 1)-grams, packed by hash range of the word or of the context's nearest bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = Tally(), Tally()
        rows = 0
        for batch in batches:
            body, at = text_bytes(batch.column(0))
            rows += len(at) - 1
            words.add(word_hashes(body, split_words(body, at), lower=True))
            grams.add(grams_of(body, at)[0])
        if rows:
            words.add(np.array([END_TOKEN], U64), np.array([rows]))
        keys, n = words.merge()
        yield _count_rows(WORDS_KIND, keys, n, range_of(keys, ranges), ranges)
        keys, n = grams.merge()
        yield _count_rows(GRAMS_KIND, keys, n, gram_range(keys, ranges), ranges)

    def add_up(table: pa.Table) -> pa.Table:
        keys, n = _unique_counts(np.concatenate([np.frombuffer(x, U64) for x in table["keys"].to_pylist()]), np.concatenate([np.frombuffer(x, np.int64) for x in table["counts"].to_pylist()]))
        return pa.table({"kind": table["kind"][:1], "range": table["range"][:1], "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary()), "distinct": pa.array([len(keys)], pa.int64()), "total": pa.array([int(n.sum())], pa.int64())})

    return texts.mapInArrow(count, _COUNTS).groupBy("kind", "range").applyInArrow(add_up, _COUNTS + ", distinct long, total long")


def _unpacked(counts: DataFrame, kind: int, least: float) -> DataFrame:
    """(key, n) of the packed counts of one kind that reach least."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, values = np.frombuffer(k, np.int64), np.frombuffer(n, np.int64)
                ok = values >= least
                yield pa.record_batch([pa.array(keys[ok]), pa.array(values[ok])], names=["key", "n"])

    return counts.filter(f"kind = {kind}").select("keys", "counts").mapInArrow(unpack, "key long, n long")


def pair_counts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(gram, n) of order 1, in the driver: 65,536 at most."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pair, times = _unique_counts(np.frombuffer(k, U64) & U64(0xFFFF), np.frombuffer(n, np.int64))
                yield pa.record_batch([pa.array(pair.view(np.int64)), pa.array(times)], names=["pair", "n"])

    found = counts.filter(f"kind = {GRAMS_KIND}").select("keys", "counts").mapInArrow(add_up, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    return _unique_counts(found.pair.to_numpy(np.int64).view(U64), found.n.to_numpy(np.int64))


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in a sorted table, and whether it does."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class Contexts:
    """All contexts of a range: those of orders 2 and more from its grams, those below from the counts of pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]):
        tables = [_unique_counts(pairs[0] & U64(255), pairs[1]), pairs]
        tables += [_unique_counts(keys & U64((1 << 8 * (order + 1)) - 1), counts) for order in range(2, ORDER + 1)]
        self.orders = []
        for order, (gram, n) in enumerate(tables):
            context = gram >> U64(8)
            begins = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(gram) else np.zeros(0, np.int64)
            # Counts in the shorter context of the symbols that this one offers, and excludes there.
            above, total = n, n[:0]
            if order and len(gram):
                above = tables[order - 1][1][np.searchsorted(tables[order - 1][0], gram & U64((1 << 8 * order) - 1))]
            if len(gram):
                total, above = np.add.reduceat(n, begins), np.add.reduceat(above, begins)
            # A last entry of zeros is that of contexts not known.
            self.orders.append((gram, n, context[begins], *(np.append(x, 0) for x in (total, np.diff(np.append(begins, len(gram))), above))))

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's symbol after its context."""
        value, done = np.zeros(len(grams)), np.zeros(len(grams), bool)
        gone, lost = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        for order in range(ORDER, -1, -1):
            gram, n, context, total, distinct, above = self.orders[order]
            part = grams & U64((1 << 8 * (order + 1)) - 1)
            at, known = _found(context, part >> U64(8))
            at = np.where(known, at, len(context))
            left = distinct[at] - gone
            # Without symbols to escape to, the left ones share the whole.
            whole = total[at] - lost + np.where(distinct[at] < 256, left, 0)
            place, hit = _found(gram, part)
            hit &= ~done
            value[hit] += np.log10(n[place[hit]] / whole[hit])
            done |= hit
            escape = ~done & (left > 0)
            value[escape] += np.log10(left[escape] / whole[escape])
            gone, lost = distinct[at], above[at]
        value[~done] -= np.log10(256 - gone[~done])
        return value


class Values:
    """Values of 64-bit keys, by a table of slots first and by bisection for the keys that share one."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        by = np.argsort(keys)
        self.keys, self.values = keys[by], values[by]
        self.shift = U64(64 - max(10, (8 * len(keys)).bit_length()))
        self.slots = np.zeros(1 << 64 - int(self.shift), np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * U64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(keys)]
        miss = np.flatnonzero(self.keys[at] != keys)
        at[miss] = np.searchsorted(self.keys, keys[miss])
        return self.values[at]


class Trie:
    """Contexts as numbered nodes. extend[node, byte] is the node of the context one byte longer (0: none);
    log10[node, symbol] the log-probability of a symbol whose longest known context is the node."""

    def __init__(self, counts: dict[int, tuple[np.ndarray, np.ndarray]]):
        nodes: list[dict[int, int]] = [{0: 0}]
        size = 1
        for order in range(1, max(counts) + 1):
            contexts = np.unique(counts[order][0] >> U64(8)).tolist()
            # A context's shorter one is kept with it, as it holds at least as many bytes.
            nodes.append({c: size + i for i, c in enumerate(contexts)})
            size += len(contexts)
        self.extend = np.zeros((size, 256), np.int32)
        seen = np.zeros((size, 256), np.int64)
        for order in range(len(nodes)):
            gram, n = counts[order]
            if len(gram):
                node = np.array([nodes[order][c] for c in (gram >> U64(8)).tolist()]) if order else np.zeros(len(gram), np.int64)
                seen[node, (gram & U64(255)).astype(np.int64)] = n
            for c, i in nodes[order].items() if order else ():
                self.extend[nodes[order - 1][c & (1 << 8 * (order - 1)) - 1], c >> 8 * (order - 1)] = i
        parent = np.zeros(size, np.int64)
        for order in range(1, len(nodes)):
            for c, i in nodes[order].items():
                parent[i] = nodes[order - 1][c & (1 << 8 * (order - 1)) - 1]
        self.log10 = self._logs(seen, parent)

    @staticmethod
    def _logs(seen: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Nodes come after their parents, so that one pass finds every descent."""
        size = len(seen)
        # below[i, s]: probability of s after an escape out of node i, its symbols excluded.
        below = np.zeros((size, 256), np.float32)
        out = np.zeros((size, 256), np.float32)
        for i in range(size):
            known = seen[i] > 0
            if i == 0:
                below[0] = np.where(known, 0.0, 1 / max(1, (~known).sum()))
            else:
                left = np.where(known, 0, seen[parent[i]])
                rest = np.where(known, 0.0, below[parent[i]].astype(np.float64))
                distinct = (left > 0).sum()
                # Without symbols to escape to, the left ones share the whole.
                below[i] = rest if not distinct else left / left.sum() if not rest.any() else (left + rest * distinct) / (left.sum() + distinct)
            total, distinct = seen[i].sum(), known.sum()
            own = below[i] if not distinct else seen[i] / total if distinct == 256 else (seen[i] + below[i].astype(np.float64) * distinct) / (total + distinct)
            out[i] = np.log10(np.maximum(own, 1e-37))
        return out

    def score(self, body: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 of each row's probability."""
        text, first = padded(body, at)
        place = symbols_at(at, first)
        n = np.diff(at) + 1
        value = np.empty(len(place), np.float32)
        step = 1 << 20
        flat, table = self.extend.ravel(), self.log10.ravel()
        for a in range(0, len(place), step):
            here = place[a : a + step]
            node = np.zeros(len(here), np.int64)
            alive = np.arange(len(here))
            for j in range(1, ORDER + 1):
                longer = flat[node[alive] * 256 + text[here[alive] - j]]
                alive = alive[longer > 0]
                node[alive] = longer[longer > 0]
            value[a : a + step] = table[node * 256 + text[here]]
        return np.add.reduceat(value.astype(np.float64), np.cumsum(n) - n) if len(n) else np.zeros(0)


def score_adaptive(text: bytes, order: int = ORDER) -> float:
    """log10 of the probability of one text under a model that starts empty and learns as it reads."""
    seen: dict[bytes, dict[int, int]] = defaultdict(dict)
    data = bytes(LOWER[np.frombuffer(text, np.uint8)]) + bytes([END])
    total = 0.0
    for i, symbol in enumerate(data):
        excluded: set[int] = set()
        contexts = [data[max(0, i - n) : i] for n in range(min(order, i), -1, -1)]
        found = False
        for c in contexts:
            left = {s: n for s, n in seen[c].items() if s not in excluded}
            if left:
                whole = sum(left.values()) + len(left)
                if symbol in left:
                    total += np.log10(left[symbol] / whole)
                    found = True
                    break
                total += np.log10(len(left) / whole)
                excluded |= set(left)
        if not found:
            total -= np.log10(256 - len(excluded))
        for c in contexts:
            seen[c][symbol] = seen[c].get(symbol, 0) + 1
    return float(total)


_ASKED = "range int, texts binary, firsts binary, keys binary, times binary"


def _asked(parts: list[tuple[np.ndarray, np.ndarray]], ranges: int) -> pa.RecordBatch:
    """For each range: its texts, where each text's words begin, the words, and how often each stands in the text."""
    text, word = np.concatenate([t for t, _ in parts]), np.concatenate([w for _, w in parts])
    place = range_of(word, ranges)
    by = np.lexsort((word, text, place))
    text, word, place = text[by], word[by], place[by]
    begins = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (word[1:] != word[:-1])]))
    times = np.diff(np.append(begins, len(word))).astype(np.uint32)
    text, word, place = text[begins], word[begins], place[begins]
    at = np.searchsorted(place, np.arange(ranges + 1))
    rows = []
    for r in np.flatnonzero(np.diff(at)):
        some = slice(at[r], at[r + 1])
        t = text[some]
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        rows.append((int(r), t[first].tobytes(), first.astype(np.int32).tobytes(), word[some].tobytes(), times[some].tobytes()))
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], names=["range", "texts", "firsts", "keys", "times"])


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", head: int = HEAD, chunk: int = CHUNK) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(key).alias("key"), is_held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    training = rows.filter(~F.col("held_out")).select("text")
    length, ends, n_texts = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.when(~F.col("held_out"), 1)), F.count("*")).first()
    text_ranges = max(1, n_texts // RANGE_TEXTS)
    ranges = max(1, -(-length // (5 * RANGE_TOKENS)))
    counts = saved(corpus_counts(training, ranges))
    totals = {r.kind: r for r in counts.groupBy("kind").agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total")).collect()}
    n_train, n_distinct = (totals[WORDS_KIND].total, totals[WORDS_KIND].distinct) if totals else (0, 0)
    floor = np.log10(n_train + n_distinct + 1)

    frequent = _unpacked(counts, WORDS_KIND, max(1.0, n_train / head)).toPandas()
    head_keys = frequent.key.to_numpy(np.int64).view(U64)
    by = np.argsort(head_keys)
    head_keys, head_counts = head_keys[by], frequent.n.to_numpy(np.int64)[by]
    whole_vocabulary = len(head_keys) == n_distinct
    model = spark.sparkContext.broadcast((head_keys, head_counts))
    pairs = spark.sparkContext.broadcast(pair_counts(counts))
    # Every chunk asks for the frequent pairs of bytes: their ranges' questions are dealt over parts, and their
    # contexts go to each. Ranges hold a pair each at the least, so that there are 65,536 rows at most.
    n_parts = (F.floor(F.col("total") / PART_GRAMS) + 1).cast("int")
    dealt_ranges = counts.filter(f"kind = {GRAMS_KIND} and total >= {PART_GRAMS}").select("range", n_parts.alias("parts")).collect()
    parts = spark.sparkContext.broadcast({r["range"]: r.parts for r in dealt_ranges})

    def known_head(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        head_keys, head_counts = model.value
        if not len(head_keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(head_keys, hashes), len(head_keys) - 1)
        hit = head_keys[at] == hashes
        return np.where(hit, head_counts[at], 0), hit

    def ask_grams(texts: pa.Table) -> pa.Table:
        """The distinct grams of a chunk's texts, packed by range."""
        asked = Tally()
        for text in texts["text"].chunks:
            asked.add(grams_of(*text_bytes(text))[0])
        keys, _ = asked.merge()
        place = gram_range(keys, ranges)
        by = np.argsort(place, kind="stable")
        at = np.searchsorted(place[by], np.arange(ranges + 1))
        used = np.flatnonzero(np.diff(at))
        chunk = texts["chunk"][0].as_py()
        part = pa.array([chunk % parts.value.get(r, 1) for r in used.tolist()], pa.int32())
        return pa.table({"range": pa.array(used, pa.int32()), "part": part, "chunk": pa.array([chunk] * len(used), pa.int64()), "grams": pa.array([keys[by[at[r] : at[r + 1]]].tobytes() for r in used], pa.binary())})

    def answer_grams(_key, asked: pa.Table, known: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, U64) for x in asked["grams"].to_pylist()]
        counted = [(np.frombuffer(k, U64), np.frombuffer(n, np.int64)) for k, n in zip(known["keys"].to_pylist(), known["counts"].to_pylist(), strict=True)] or [(np.zeros(0, U64), np.zeros(0, np.int64))]
        values = []
        if parts:
            grams = np.unique(np.concatenate(parts))
            value = Contexts(*counted[0], pairs.value).log10(grams)
            values = [value[np.searchsorted(grams, p)].tobytes() for p in parts]
        return pa.table({"chunk": asked["chunk"], "grams": asked["grams"], "logs": pa.array(values, pa.binary())})

    def first_part(_chunk, texts: pa.Table, answers: pa.Table) -> pa.Table:
        whole = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in answers[c].to_pylist()])
        value = Values(whole("grams", U64), whole("logs", np.float64))
        out = []
        for batch in texts.select(["key", "held_out", "text"]).to_batches():
            body, at = text_bytes(batch.column(2))
            words = split_words(body, at)
            count, hit = known_head(word_hashes(body, words, lower=True))
            edge = words.first
            logs = np.concatenate([[0.0], np.cumsum(np.where(hit, np.log10(count + 1), 0.0))])
            known = np.concatenate([[0], np.cumsum(count > 0)])
            n = words.counts() + 1
            base = logs[edge[1:]] - logs[edge[:-1]] + np.log10(ends + 1) - n * floor
            grams, begins = grams_of(body, at)
            score = np.add.reduceat(value[grams], begins[:-1]) if len(n) else np.zeros(0)
            out.append(pa.record_batch([batch.column(0), batch.column(1), pa.array(text_hashes(body, at, lower=True).view(np.int64)), pa.array(n, pa.int64()), pa.array(known[edge[1:]] - known[edge[:-1]] + int(ends > 0), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())], names=["key", "held_out", "text_key", "n_tokens", "known", "base", "score"]))
        return pa.Table.from_batches(out)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of each text that the broadcast table doesn't hold, packed by hash range."""
        seen: set[int] = set()
        parts, held = [], 0
        for batch in batches:
            body, at = text_bytes(batch.column(0))
            words = split_words(body, at)
            hashes = word_hashes(body, words, lower=True)
            text_key = text_hashes(body, at, lower=True)
            new = np.array([k not in seen and not seen.add(k) for k in text_key.tolist()], bool)
            _, hit = known_head(hashes)
            row = words.row()
            some = ~hit & new[row]
            parts.append((text_key[row[some]], hashes[some]))
            held += int(some.sum())
            if held > HELD:
                yield _asked(parts, ranges)
                parts, held = [], 0
        if held:
            yield _asked(parts, ranges)

    def answer(_key, asked: pa.Table, known: pa.Table) -> pa.Table:
        words, n = (np.frombuffer(known["keys"][0].as_py(), U64), np.frombuffer(known["counts"][0].as_py(), np.int64)) if len(known) else (np.zeros(0, U64), np.zeros(0, np.int64))
        texts, logs, found = [], [], []
        for t, f, k, m in zip(*(asked[c].to_pylist() for c in ("texts", "firsts", "keys", "times")), strict=True):
            t, f, k, m = np.frombuffer(t, np.int64), np.frombuffer(f, np.int32).astype(np.int64), np.frombuffer(k, U64), np.frombuffer(m, np.uint32).astype(np.int64)
            at = np.minimum(np.searchsorted(words, k), max(0, len(words) - 1))
            c = np.where(words[at] == k, n[at], 0) if len(words) else np.zeros(len(k), np.int64)
            texts.append(t)
            logs.append(np.add.reduceat(m * np.log10(c + 1.0), f))
            found.append(np.add.reduceat(m * (c > 0), f))
        if not texts:
            return pa.table({c: pa.array([], k) for c, k in zip(("text_range", "texts", "logs", "found"), (pa.int32(), *[pa.binary()] * 3), strict=True)})
        key, log, hits = np.concatenate(texts), np.concatenate(logs), np.concatenate(found).astype(np.int64)
        _, once = np.unique(key, return_index=True)  # a text that two tasks hold is asked for twice
        key, log, hits = key[once], log[once], hits[once]
        place = range_of(key.view(U64), text_ranges)
        by = np.argsort(place, kind="stable")
        at = np.searchsorted(place[by], np.arange(text_ranges + 1))
        used = np.flatnonzero(np.diff(at))
        packed = [pa.array([x[by[at[r] : at[r + 1]]].tobytes() for r in used], pa.binary()) for x in (key, log, hits)]
        return pa.table({"text_range": pa.array(used, pa.int32()), "texts": packed[0], "logs": packed[1], "found": packed[2]})

    def add_up(answers: pa.Table) -> pa.Table:
        whole = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in answers[c].to_pylist()])
        key, log, hits = whole("texts", np.int64), whole("logs", np.float64), whole("found", np.int64)
        by = np.argsort(key, kind="stable")
        key = key[by]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return pa.table({"text_key": key[begins], "logs": np.add.reduceat(log[by], begins), "found": np.add.reduceat(hits[by], begins)})

    chunks = max(1, -(-length // chunk))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(chunks)))
    asked_grams = dealt.groupBy("chunk").applyInArrow(ask_grams, "range int, part int, chunk long, grams binary")
    contexts = counts.filter(f"kind = {GRAMS_KIND}").select("range", "keys", "counts", F.explode(F.sequence(F.lit(0), n_parts - 1)).alias("part"))
    answers = asked_grams.groupBy("range", "part").cogroup(contexts.groupBy("range", "part")).applyInArrow(answer_grams, "chunk long, grams binary, logs binary")
    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(first_part, f"key {rows.schema['key'].dataType.simpleString()}, held_out boolean, text_key long, n_tokens long, known long, base double, score double")
    if not whole_vocabulary and n_train:
        asked = rows.select("text").mapInArrow(ask, _ASKED)
        vocabulary = counts.filter(f"kind = {WORDS_KIND}").select("range", "keys", "counts")
        rest = asked.groupBy("range").cogroup(vocabulary.groupBy("range")).applyInArrow(answer, "text_range int, texts binary, logs binary, found binary")
        rest = rest.groupBy("text_range").applyInArrow(add_up, "text_key long, logs double, found long")
        out = salted_join(out, rest, "text_key")
    else:
        out = out.withColumn("logs", F.lit(0.0)).withColumn("found", F.lit(0).cast("long"))
    return out.select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"), "score"
    )
