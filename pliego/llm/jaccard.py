"""Exact n-gram Jaccard self-join by PartEnum signatures, and the components of its links.

A document's set holds its distinct word shingles. Two sets link when their Jaccard similarity is
at least ``SIMILARITY`` (4/5, compared in integers). The join never forms a pair that no signature
suggests, and never misses a pair that links:

* Sets are put into bands of sizes. A pair belongs to the larger set's band; each set signs for
  its own band and, where the next one can hold a partner 5/4 its size, for that one too.
* In a band of sizes below R, linked sets differ in at most k = 2(R-1)/9 shingles. The shingle
  domain is cut into n1 partitions of three parts. If n1 is large enough, some partition holds at
  most one of the k differences, and then two of its three parts agree: each pair of parts of each
  partition is one signature. (PartEnum with n2 = 3 and one difference a partition.)
* Empty projections are not signed. That is safe for a set with more than k/2 partitions of which
  at least two parts are not empty; any other set also signs its prefix (the 1/5 of its shingles
  with the smallest hashes, and one more), which two such sets share if they link.

Words, shingles and sets go by 64-bit hashes: two that share one count as equal. Sets with equal
shingles are one node, so copies never meet in pairs. Signatures travel packed, a row for each task
and range of signatures; one that many sets of a task share is collapsed there to a single forwarded
entry. Beyond ``ONCE`` times ``COARSE`` ranges they are dealt in two exchanges, to ``COARSE`` of them first,
so that a packed row keeps its size.
A packed row names its sets by ``TAG_BITS`` bits of their hashes, in order and as differences. A tag of
several sets stands for all of them, and they form a bucket of their own, so that no pair is lost by it.

Sets that share a signature form a bucket. In rounds, each set is compared inside its buckets with the
first sets of another component that a parity sketch can't rule out (the sketches' distance never
exceeds the sets'), the few that remain are checked on their whole sets, and components are merged, until
no bucket holds an unchecked pair of two components. A search stops at its first finds, so the work is
linear in a bucket whose sets are alike; and no pair that could link is left out.

No task holds more than about ``BUCKET`` sets of a bucket. The sets of a larger one all meet its first;
that alone settles a group of near copies. Where several components are left (texts around one
boilerplate, say), the sets are dealt again by their prefix in the order of rarity, in which shared
shingles come last; and what is too large even so is compared block by block, each pair of blocks in a
task of its own.

Nulls and texts without words have empty sets and link with nothing. A text of fewer words than a
shingle has its whole sequence as one. Repeated rows get the same component. An empty table gives an
empty one. Other columns are not read; in ``keep_one`` they stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pliego.llm.cluster import bounded_batches, dropped, salted_join, saved
from pliego.llm.words import U64, mix, split_words, text_bytes, windows, word_hashes

WORDS = 5
#: Similarity 4/5: 100 * shared >= 80 * all.
SIMILARITY = (80, 100)
#: Ratio of a band's ends, and partitions beyond the fewest that the bound asks for.
BAND_RATIO, SLACK = 1.5, 1.15
#: Signatures that a task holds before it packs them, and in a reducer's range, about.
FLUSH, RANGE = 1_500_000, 1_500_000
#: Sets of one task that share a signature before they are collapsed to one forwarded entry.
HOT = 64
#: Ranges that the first of two exchanges deals to. The second costs more disk than smaller rows do, up to ONCE times as many.
COARSE, ONCE = 2048, 4
#: Bits of a set's hash that travel with its signatures, 32 at most.
TAG_BITS = 32
#: Sets of a bucket that one task compares, about.
BUCKET = 20_000
#: Sets from which the order of rarity is drawn, and its shingles: they decide on speed alone.
SAMPLED, COMMON = 20_000, 500_000
#: Keys of needed sets that are broadcast, of 8 bytes each; beyond it, both sides are shuffled.
NEEDED = 500_000
#: Others that a set tries in one bucket grow by this from round to round, so that one which many
#: near misses surround is settled in a number of rounds that is the logarithm of their number.
GROWTH = 6


def sets_of(column: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z in lower case."""
    body, at = text_bytes(column)
    words = split_words(body, at)
    hashes = word_hashes(body, words, lower=True)
    grams, first = windows(hashes, words.first, n)
    out = [np.unique(grams[first[r] : first[r + 1]]) for r in range(len(at) - 1)]
    for r in np.flatnonzero((words.counts() > 0) & (words.counts() < n)):
        value = np.array([words.counts()[r]], U64)
        for h in hashes[words.first[r] : words.first[r + 1]]:
            value = mix(value * U64(0x9FB21C651E98DF25) + h)
        out[r] = value
    return out


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return int(mix(mix(s * U64(0xA24BAED4963EE407)).sum(keepdims=True) + U64(len(s))).view(np.int64)[0])


def sketch(s: np.ndarray) -> bytes:
    """Parities of the set's elements in a power of two of bins, at least twice as many as elements."""
    bits = max(64, 1 << math.ceil(math.log2(2 * max(1, len(s)))))
    bins = (mix(s + U64(0x1F83D9ABFB41BD6B)) & U64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(bins, minlength=bits) & 1, bitorder="little").tobytes()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILARITY[1] * shared >= SIMILARITY[0] * (len(a) + len(b) - shared)


@lru_cache(None)
def band_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * BAND_RATIO)))
    return np.array(starts)


@lru_cache(4096)
def band(t: int) -> tuple[int, int, np.ndarray]:
    """k, n1 and the inner bounds of the 3 * n1 parts of band t."""
    k = 2 * (int(band_starts()[t + 1]) - 1) // 9
    n1 = math.ceil(SLACK * (k + 1) / 2)
    return k, n1, np.array([(i << 64) // (3 * n1) for i in range(1, 3 * n1)], U64)


def signatures(s: np.ndarray) -> np.ndarray:
    """Every signature of a sorted set."""
    out = []
    low, high = np.searchsorted(band_starts(), [len(s), len(s) * 5 // 4], side="right") - 1
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(s * U64(0xE7037ED1A0B428DB)))])
    for t in range(int(low), int(high) + 1):
        k, n1, bounds = band(t)
        if not k:
            continue
        cut = np.concatenate([[0], np.searchsorted(s, bounds), [len(s)]])
        size = np.diff(cut).reshape(n1, 3)
        part = (total[cut[1:]] - total[cut[:-1]]).reshape(n1, 3)
        seed = mix(np.arange(n1, dtype=U64) + U64(t) * U64(1 << 32))
        for j, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
            value = mix(part[:, x] * U64(3) + mix(part[:, y]) + seed + U64(j))
            out.append(value[size[:, x] + size[:, y] > 0])
        if ((size > 0).sum(1) >= 2).sum() < k // 2 + 1:
            prefix = len(s) - math.ceil(len(s) * SIMILARITY[0] / SIMILARITY[1]) + 1
            out.append(mix(s[:prefix] ^ U64(0x5851F42D4C957F2D)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U64)


def described(docs: DataFrame, text: str, key: str, row: Column | None = None) -> DataFrame:
    """key, row_key, n_shingles, set_key and sketch of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = sets_of(batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()), pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())], names=["key", "row_key", "n_shingles", "set_key", "sketch"])

    rows = docs.select(F.col(key).alias("key"), (F.xxhash64(key, text) if row is None else row).alias("row_key"), F.col(text).alias("text"))
    return rows.mapInArrow(describe, f"key {rows.schema['key'].dataType.simpleString()}, row_key long, n_shingles long, set_key long, sketch binary")


#: Of entries, who tells how many of sigs each of keys owns, and keys are tags; see _named.
_PACKED = "range int, kind int, sigs binary, who binary, keys binary"
#: Kinds of packed rows: entries by the low half of their signature or by all of it, members of a hot signature, its forwarded entry.
ENTRIES, MEMBERS, FORWARDED, WHOLE_ENTRIES = range(4)


def _place(sigs: np.ndarray, ranges: int) -> np.ndarray:
    return ((sigs >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["range", "kind", "sigs", "who", "keys"])


def _named(owner: np.ndarray, keys: np.ndarray) -> tuple[bytes, bytes]:
    """who and keys of entries whose owners ascend, as do their keys: the width and numbers of entries a key, and the keys' differences, compressed by planes of bytes."""
    begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    n = np.diff(np.append(begins, len(owner)))
    n = n.astype(np.min_scalar_type(n.max()))
    steps = np.diff(keys[owner[begins]], prepend=0).astype(np.uint32)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T)
    return bytes([n.itemsize]) + n.tobytes(), pa.compress(planes, codec="zstd", asbytes=True)


def _owners(who: bytes, keys: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a packed row of entries, and each entry's index in them."""
    n = np.frombuffer(who, f"u{who[0]}", offset=1)
    planes = np.frombuffer(pa.decompress(keys, decompressed_size=4 * len(n), codec="zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.int64), np.repeat(np.arange(len(n)), n)


def _pack(sigs: np.ndarray, owner: np.ndarray, keys: np.ndarray, ranges: int, hot: int, whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of (range, kind, sigs, who, keys)."""
    by = np.argsort(sigs, kind="stable")
    sigs, owner = sigs[by], owner[by]
    begins = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
    length = np.diff(np.append(begins, len(sigs)))
    is_hot = np.repeat(length > hot, length)
    rows = []
    if is_hot.any():
        members = np.flatnonzero(is_hot)
        for i, some in enumerate(np.array_split(members, -(-len(members) // 65536))):
            rows.append((int(sigs[some[0]] % U64(ranges) + U64(i)) % ranges, MEMBERS, sigs[some].tobytes(), b"", keys[owner[some]].tobytes()))
        for b, n in zip(begins[length > hot], length[length > hot], strict=True):
            rows.append((int(_place(sigs[b : b + 1], ranges)[0]), FORWARDED, sigs[b : b + 1].tobytes(), b"", keys[owner[b : b + n]].min(keepdims=True).tobytes()))
        sigs, owner = sigs[~is_hot], owner[~is_hot]
    place = _place(sigs, ranges)
    edges = np.append(np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])), len(place)) if len(place) else [0]
    order = np.argsort(keys, kind="stable")
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    keys, owner = keys[order], rank[owner]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        by = a + np.argsort(owner[a:b], kind="stable")
        rows.append((int(place[a]), WHOLE_ENTRIES if whole else ENTRIES, (sigs[by] if whole else sigs[by].astype(np.uint32)).tobytes(), *_named(owner[by], keys)))
    if rows:
        yield _batch(rows)


def _buckets(packed: pa.Table) -> pa.Table:
    """(bucket, set_key) of the sets in one range that share a signature, by the keys that were packed."""
    sigs, keys, full = [], [], []
    out_bucket, out_key = [], []
    for kind, s, who, k in zip(*(packed[c].to_pylist() for c in ("kind", "sigs", "who", "keys")), strict=True):
        if kind == MEMBERS:
            out_bucket.append(np.frombuffer(s, np.int64))
            out_key.append(np.frombuffer(k, np.int64))
        elif kind == FORWARDED:
            whole = np.frombuffer(s, U64)
            sigs.append(whole.astype(np.uint32))
            full.append(whole)
            keys.append(np.frombuffer(k, np.int64))
        else:
            short = np.frombuffer(s, np.uint32)
            of, owner = _owners(who, k)
            sigs.append(short)
            full.append(np.zeros(len(short), U64))
            keys.append(of[owner])
    if sigs:
        sig, key, whole = np.concatenate(sigs), np.concatenate(keys), np.concatenate(full)
        by = np.lexsort((key, sig))
        sig, key, whole = sig[by], key[by], whole[by]
        begins = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        length = np.diff(np.append(begins, len(sig)))
        hot = np.maximum.reduceat(whole, begins)
        distinct = np.concatenate([[True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])])
        members = np.add.reduceat(distinct.astype(np.int64), begins)
        # Buckets with the same members are one: their name is a hash of the members.
        name = np.where(hot > 0, hot, mix(np.add.reduceat(np.where(distinct, mix(key.view(U64)), U64(0)), begins)))
        keep = (members > 1) | (hot > 0)
        _, once = np.unique(np.where(keep, name, U64(0)), return_index=True)
        chosen = np.zeros(len(begins), bool)
        chosen[once] = True
        take = np.repeat(keep & (chosen | (hot > 0)), length) & distinct
        out_bucket.append(np.repeat(name, length)[take].view(np.int64))
        out_key.append(key[take])
        # Entries tell signatures apart by half their bits: hot ones that agree there get all members each.
        least = np.minimum.reduceat(np.where(whole > 0, whole, U64((1 << 64) - 1)), begins)
        for g in np.flatnonzero((hot > 0) & (least != hot)):
            of = slice(begins[g], begins[g] + length[g])
            for other in np.setdiff1d(whole[of], np.array([0, hot[g]], U64)):
                some = np.unique(key[of])
                out_bucket.append(np.full(len(some), other, U64).view(np.int64))
                out_key.append(some)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.table({"bucket": join(out_bucket), "set_key": join(out_key)})


class Held:
    """Signatures of sets, packed when many are held."""

    def __init__(self, *how):
        self.how = how
        self.clear()

    def clear(self) -> None:
        self.sigs, self.owner, self.keys, self.n, self.n_keys = [], [], [], 0, 0

    def add(self, sigs: np.ndarray, owner: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.sigs.append(sigs)
        self.owner.append(owner.astype(np.int64) + self.n_keys)
        self.keys.append(keys)
        self.n, self.n_keys = self.n + len(sigs), self.n_keys + len(keys)
        if self.n >= FLUSH:
            yield from self.pack()

    def pack(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            yield from _pack(np.concatenate(self.sigs), np.concatenate(self.owner), np.concatenate(self.keys), *self.how)
        self.clear()


def shared_signatures(docs: DataFrame, text: str, keys: DataFrame, ranges: int, hot: int = HOT, coarse: int = COARSE, tag_bits: int = TAG_BITS) -> DataFrame:
    """(bucket, set_key): which sets share which signatures. keys(set_key) holds every set's, or repeats them."""
    two = ranges > ONCE * coarse
    mask = (1 << tag_bits) - 1

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held = Held(coarse if two else ranges, hot, two)
        for batch in batches:
            for s in sets_of(batch.column(0)):
                if not len(s) or (k := set_key(s)) in seen:
                    continue
                seen.add(k)
                own = signatures(s)
                yield from held.add(own, np.zeros(len(own), np.int64), np.array([k & mask], np.int64))
        yield from held.pack()

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(ranges, hot)
        for batch in batches:
            for r, kind, s, who, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sigs = np.frombuffer(s, U64)
                if kind == WHOLE_ENTRIES:
                    of, owner = _owners(who, k)
                    yield from held.add(sigs, owner, of)
                else:
                    yield _batch([(int(_place(sigs[:1], ranges)[0]) if kind == FORWARDED else r, kind, s, who, k)])
        yield from held.pack()

    packed = docs.select(text).mapInArrow(sign, _PACKED)
    if two:
        packed = packed.repartition(coarse, "range").mapInArrow(refine, _PACKED)
    found = packed.groupBy("range").applyInArrow(_buckets, "bucket long, set_key long").withColumnRenamed("set_key", "tag")
    # One exchange by tag serves both the distinct and the join.
    tagged = keys.select(F.col("set_key").bitwiseAND(F.lit(mask)).alias("tag"), "set_key").repartition("tag").groupBy("tag").agg(F.collect_set("set_key").alias("of"))
    named = found.repartition("tag").distinct().join(tagged, "tag").select("bucket", F.explode("of").alias("set_key"))
    return named.unionByName(tagged.filter(F.size("of") > 1).select(F.xxhash64("tag").alias("bucket"), F.explode("of").alias("set_key")))


def _distances(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ many).sum(axis=-1, dtype=np.int64)


def _fold(s: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(s.reshape(*s.shape[:-1], -1, words), axis=-2)


def can_link(n: int, own: np.ndarray, sizes: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of others a set of n elements could link with, by sizes and sketches alone; it never denies a link."""
    small, large = np.minimum(n, sizes), np.maximum(n, sizes)
    ok = SIMILARITY[1] * small >= SIMILARITY[0] * large
    for words in {len(others[i]) for i in np.flatnonzero(ok)}:
        some = np.array([i for i in np.flatnonzero(ok) if len(others[i]) == words])
        least = min(words, len(own))
        d = _distances(_fold(own, least), _fold(np.stack([others[i] for i in some]), least))
        ok[some] = (SIMILARITY[0] + SIMILARITY[1]) * d <= (SIMILARITY[1] - SIMILARITY[0]) * (n + sizes[some])
    return ok


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that come sorted by column."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(column).to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        table = pa.Table.from_batches([batch])
        if held and held[0].column(column)[0].as_py() != int(key[-1]):
            # The group held before ends in this batch.
            yield pa.concat_tables([*held, table.slice(0, last)])
            held = [table.slice(last)]
        elif held:
            held.append(table)
        else:
            if last:
                yield table.slice(0, last)
            held = [table.slice(last)]
    if held:
        yield pa.concat_tables(held)


class Bucket:
    """The sets of one bucket, in the order of their keys, and which of them could link."""

    def __init__(self, key: np.ndarray, sizes: np.ndarray, sketches: list[bytes]):
        by = np.argsort(key, kind="stable")
        self.by, self.key, self.sizes = by, key[by], sizes[by]
        words = np.array([len(sketches[i]) // 8 for i in by])
        self.kinds = [(w, np.flatnonzero(words == w)) for w in np.unique(words)]
        self.stacks = [np.frombuffer(b"".join(sketches[by[i]] for i in at), U64).reshape(len(at), w) for w, at in self.kinds]

    def candidates(self, tries: int, apart=None, some: np.ndarray | None = None, larger: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(row, other) of the sets (of some) and others of smaller keys (or larger ones) that they could link with,
        as far as apart(rows, others) lets pairs pass, until a row has about tries. Others come in growing blocks, and a row leaves with its last."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for (w, at), stack in zip(self.kinds, self.stacks, strict=True):
            chosen = np.arange(len(at)) if some is None else np.flatnonzero(np.isin(at, some))
            for a in range(0, len(chosen), 2048):
                left, got = chosen[a : a + 2048], np.zeros(min(2048, len(chosen) - a), np.int64)
                for (v, cols), other in zip(self.kinds, self.stacks, strict=True):
                    least, c, block = min(w, v), 0, 64
                    while c < len(cols) and len(left):
                        own = at[left]
                        if not larger and cols[c] >= own.max():
                            break
                        block = max(1, min(block, (4 << 20) // (len(left) * least)))
                        some_cols = cols[c : c + block]
                        d = _distances(_fold(stack[left], least)[:, None, :], _fold(other[c : c + block], least)[None, :, :])
                        n, m = self.sizes[own][:, None], self.sizes[some_cols][None, :]
                        ok = (SIMILARITY[0] + SIMILARITY[1]) * d <= (SIMILARITY[1] - SIMILARITY[0]) * (n + m)
                        ok &= SIMILARITY[1] * np.minimum(n, m) >= SIMILARITY[0] * np.maximum(n, m)
                        ok &= some_cols[None, :] > own[:, None] if larger else some_cols[None, :] < own[:, None]
                        if apart is not None and ok.any():
                            ok &= apart(own, some_cols, ok)
                        ok &= np.cumsum(ok, axis=1) <= (tries - got)[:, None]
                        i, j = np.nonzero(ok)
                        found.append((own[i], some_cols[j]))
                        got += ok.sum(1)
                        left, got = left[got < tries], got[got < tries]
                        c, block = c + len(some_cols), block * 4
        return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((), ())))


def _groups(table: pa.Table) -> Iterator[tuple[int, int]]:
    key = table.column("bucket").to_numpy()
    edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (bucket, set_key, n_shingles, sketch), those that could link with another of their bucket, each with one of smaller key if there is any."""
    for table in whole_groups(batches, "bucket"):
        keys, sizes, sketches = table.column("set_key").to_numpy(), table.column("n_shingles").to_numpy(), table.column("sketch").to_pylist()
        keep, partner = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        known = np.zeros(len(keys), bool)
        for a, b in _groups(table):
            if b - a < 2:
                continue
            bucket = Bucket(keys[a:b], sizes[a:b], sketches[a:b])
            rows, others = bucket.candidates(1)
            keep[a + bucket.by[rows]] = keep[a + bucket.by[others]] = True
            known[a + bucket.by[rows]] = True
            partner[a + bucket.by[rows]] = bucket.key[others]
            if len(rows):  # a set may be another's second choice alone
                rows, _ = bucket.candidates(1, some=np.flatnonzero(~keep[a + bucket.by]), larger=True)
                keep[a + bucket.by[rows]] = True
        out = table.append_column("partner", pa.array(partner, mask=~known)).filter(pa.array(keep))
        yield from out.combine_chunks().to_batches()


def more_candidates(tries: int):
    """Pairs (a, b) of sets of one bucket and two components: each set with about the first tries others of smaller keys, of another component, that it could link with and that weren't refuted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "bucket"):
            keys, comps, sizes = (table.column(c).to_numpy() for c in ("set_key", "component", "n_shingles"))
            sketches, failed = table.column("sketch").to_pylist(), table.column("failed").to_pylist()
            left, right = [], []
            for a, b in _groups(table):
                bucket = Bucket(keys[a:b], sizes[a:b], sketches[a:b])
                comp = comps[a:b][bucket.by]

                def apart(rows, cols, ok, a=a, bucket=bucket, comp=comp):
                    out = comp[rows][:, None] != comp[cols][None, :]
                    for i in np.flatnonzero((ok & out).any(1)):
                        refuted = failed[a + bucket.by[rows[i]]]
                        if refuted:
                            out[i] &= ~np.isin(bucket.key[cols], np.array(refuted, np.int64))
                    return out

                of, other = bucket.candidates(tries, apart)
                left.append(bucket.key[other])
                right.append(bucket.key[of])
            one = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
            yield pa.record_batch([one(left), one(right)], names=["a", "b"])

    return run


def rare_prefixes(elements: DataFrame, n_sets: int) -> DataFrame:
    """(bucket, set_key): a bucket for each of the rarest 1/5 (and one) of a set's shingles, of which linked sets share one, in any order of shingles that holds for all.

    The order goes by how many of up to SAMPLED sets hold a shingle, so that what many share comes last.
    """
    some = elements.filter(F.pmod(F.xxhash64("set_key"), F.lit(max(1, -(-n_sets // SAMPLED)))) == 0)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(np.concatenate([np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()] or [np.zeros(0, np.int64)]))], names=["shingle"])

    counts = some.select("elements").mapInArrow(each, "shingle long").groupBy("shingle").count().filter("count > 2").orderBy(F.col("count").desc(), "shingle").limit(COMMON).toPandas()
    by = np.argsort(counts["shingle"].to_numpy(np.int64).view(U64))
    common, often = counts["shingle"].to_numpy(np.int64).view(U64)[by], counts["count"].to_numpy(np.int64)[by]
    table = elements.sparkSession.sparkContext.broadcast((common, often))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = table.value
        for batch in batches:
            buckets, keys = [], []
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = np.frombuffer(x, U64)
                at = np.minimum(np.searchsorted(common, s), max(0, len(common) - 1))
                n = np.where(common[at] == s, often[at], 0) if len(common) else np.zeros(len(s), np.int64)
                prefix = len(s) - -(-len(s) * SIMILARITY[0] // SIMILARITY[1]) + 1
                buckets.append(mix(s[np.lexsort((s, n))[:prefix]] ^ U64(0x2545F4914F6CDD1D)).view(np.int64))
                keys.append(np.full(len(buckets[-1]), k, np.int64))
            one = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
            yield pa.record_batch([one(buckets), one(keys)], names=["bucket", "set_key"])

    return elements.select("set_key", "elements").mapInArrow(deal, "bucket long, set_key long")


def block_pairs(members: DataFrame, sizes: DataFrame, limit: int) -> DataFrame:
    """members(bucket, set_key) of the buckets of sizes(bucket, count), dealt to a bucket for each pair of blocks of half of limit sets."""
    n = F.ceil(2 * F.col("count") / limit).cast("int")
    block = F.pmod(F.xxhash64("set_key", "bucket"), F.col("n")).cast("int")
    dealt = members.join(sizes.select("bucket", n.alias("n")), "bucket").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return dealt.select(F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"), "set_key")


def _hub_candidates(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (set_key, n_shingles, sketch, hub_key, hub_n, hub_sketch), the pairs that could link."""
    for batch in rows:
        key, n, bits, hub, hub_n, hub_bits = (c.to_pylist() for c in batch.columns)
        ok = [bool(can_link(n[i], np.frombuffer(bits[i], U64), np.array([hub_n[i]]), [np.frombuffer(hub_bits[i], U64)])[0]) for i in range(len(key))]
        yield pa.record_batch([pa.array([min(x, y) for x, y, o in zip(key, hub, ok, strict=True) if o], pa.int64()), pa.array([max(x, y) for x, y, o in zip(key, hub, ok, strict=True) if o], pa.int64())], names=["a", "b"])


def whole_sets(docs: DataFrame, text: str, keys: DataFrame) -> DataFrame:
    """set_key and elements of the sets that keys(set_key) names, once each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found = [(k, s.tobytes()) for s in sets_of(batch.column(0)) if len(s) and (k := set_key(s)) not in seen and not seen.add(k)]
            yield pa.record_batch([pa.array([k for k, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], names=["set_key", "elements"])

    wanted = F.broadcast(keys) if keys.count() <= NEEDED else keys
    rows = docs.select(text).mapInArrow(write, "set_key long, elements binary").join(wanted, "set_key", "left_semi")
    return rows.groupBy("set_key").agg(F.first("elements").alias("elements"))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [linked(np.frombuffer(x, U64), np.frombuffer(y, U64)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of edges(a, b): the smallest node reachable. Minimum labels spread to neighbours and along labels, so that the number of rounds is about the logarithm of a path's length."""
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = saved(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels.node == near.a, "left").select("node", F.col("component").alias("old"), F.least("component", F.coalesce("near", "component")).alias("next"))
        root = labels.select(F.col("node").alias("at"), F.col("component").alias("root"))
        moved = saved(step.join(root, step.next == root["at"], "left").select("node", "old", F.least("next", F.coalesce("root", "next")).alias("component")))
        dropped(labels)
        labels = moved.select("node", "component")
        if moved.filter("old <> component").isEmpty():
            dropped(both)
            return labels


class Links:
    """What is known of sets: their shingles, components, and pairs that don't link."""

    def __init__(self, elements: DataFrame, labels: DataFrame):
        self.elements, self.labels = elements, labels
        self.failed = elements.sparkSession.createDataFrame([], "a long, b long")

    def check(self, pairs: DataFrame) -> None:
        """Merges the components of the pairs(a, b) that link, and notes those that don't."""
        of = lambda c: self.elements.select(F.col("set_key").alias(c), F.col("elements").alias(f"of_{c}"))
        whole = pairs.join(of("a"), "a").join(of("b"), "b")
        checked = saved(whole.select("a", "b", "of_a", "of_b").mapInArrow(_verify, "a long, b long, linked boolean"))
        self.failed = self.failed.union(checked.filter("not linked").select("a", "b"))  # one table a round, and rounds are few
        good = checked.filter("linked")
        if not good.isEmpty():
            name = lambda c: self.labels.select(F.col("set_key").alias(c), F.col("component").alias(f"c{c}"))
            edges = good.join(name("a"), "a").join(name("b"), "b").filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
            merged = components(edges)
            before = self.labels
            self.labels = saved(before.join(merged, before.component == merged.node, "left").select("set_key", F.coalesce(merged.component, before.component).alias("component")))
            dropped(merged)


def split_large(members: DataFrame, per_set: DataFrame, known: Links, limit: int) -> DataFrame:
    """(bucket, set_key) in buckets of about limit sets at most, which together suggest every pair that members(bucket, set_key), of larger buckets, suggest and that isn't settled by their first sets."""
    hub = members.groupBy("bucket").agg(F.min("set_key").alias("hub"))
    described_hub = hub.join(per_set.withColumnsRenamed({"set_key": "hub", "n_shingles": "hub_n", "sketch": "hub_sketch"}), "hub")
    meet = members.join(described_hub, "bucket").filter("set_key <> hub").select("set_key", "hub", "hub_n", "hub_sketch").distinct().join(per_set, "set_key")
    pairs = saved(meet.select("set_key", "n_shingles", "sketch", "hub", "hub_n", "hub_sketch").mapInArrow(_hub_candidates, "a long, b long").distinct())
    known.check(pairs)
    dropped(pairs)
    labelled = members.join(known.labels, "set_key")
    open_buckets = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("bucket")
    left = saved(members.join(open_buckets, "bucket", "left_semi").select("set_key").distinct())
    dealt = saved(rare_prefixes(known.elements.join(left, "set_key", "left_semi"), left.count()))
    sizes = saved(dealt.join(known.labels, "set_key").groupBy("bucket").agg(F.count("*").alias("count"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high"))
    small = dealt.join(sizes.filter(F.col("count") <= limit).select("bucket"), "bucket", "left_semi")
    return saved(small.unionByName(block_pairs(dealt, sizes.filter(F.col("count") > limit), limit)))


def set_components(docs: DataFrame, described_rows: DataFrame, text: str, hot: int = HOT, bucket: int = BUCKET, ranges: int | None = None, coarse: int = COARSE, tag_bits: int = TAG_BITS) -> DataFrame:
    """(set_key, component) of every set that links with another, by the smallest set_key."""
    per_set = described_rows.filter("set_key is not null").groupBy("set_key").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    total = described_rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    shared = every = saved(shared_signatures(docs, text, described_rows.filter("set_key is not null").select("set_key"), ranges or max(1, round(total / RANGE)), hot, coarse, tag_bits))
    large = saved(shared.groupBy("bucket").count().filter(F.col("count") > bucket).select("bucket"))
    known = big = None
    if not large.isEmpty():
        big = saved(shared.join(large, "bucket", "left_semi"))
        keys = saved(big.select("set_key").distinct())
        known = Links(saved(whole_sets(docs, text, keys)), keys.select("set_key", F.col("set_key").alias("component")))
        shared = shared.join(large, "bucket", "left_anti").unionByName(split_large(big, per_set, known, bucket)).distinct()
    members = shared.join(per_set, "set_key").select("bucket", "set_key", "n_shingles", "sketch")
    # Most buckets hold sets that no sketch lets through: from here on, only the others' members count.
    members = saved(members.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_first_pass, "bucket long, set_key long, n_shingles long, sketch binary, partner long"))
    dropped(every)
    keys = members.select("set_key")
    keys = saved((keys if big is None else keys.union(big.select("set_key"))).distinct())
    labels = keys.select("set_key", F.col("set_key").alias("component"))
    first = members.filter("partner is not null").select(F.col("partner").alias("a"), F.col("set_key").alias("b")).distinct()
    if known is None:
        known = Links(saved(whole_sets(docs, text, keys)), labels)
    else:
        settled = known.labels.withColumnRenamed("component", "settled")
        more = keys.join(known.elements.select("set_key"), "set_key", "left_anti")
        known.elements = known.elements.unionByName(saved(whole_sets(docs, text, saved(more))))
        known.labels = saved(labels.join(settled, "set_key", "left").select("set_key", F.coalesce("settled", "component").alias("component")))
        name = lambda c: known.labels.select(F.col("set_key").alias(c), F.col("component").alias(f"c{c}"))
        first = first.join(name("a"), "a").join(name("b"), "b").filter("ca <> cb").select("a", "b").join(known.failed, ["a", "b"], "left_anti")
    members = members.drop("partner")
    pairs, tries = saved(first), GROWTH
    while not pairs.isEmpty():
        known.check(pairs)
        dropped(pairs)
        refuted = known.failed.select(F.col("b").alias("set_key"), "a").groupBy("set_key").agg(F.collect_set("a").alias("failed"))
        # Buckets of one component are done for good: only the others' members go on, and bring their sketches.
        inside = members.select("bucket", "set_key").join(known.labels, "set_key").groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        open_buckets = saved(inside.filter("low <> high").select("bucket"))
        wanted = F.broadcast(open_buckets) if open_buckets.count() <= NEEDED else open_buckets
        done, members = members, saved(members.join(wanted, "bucket", "left_semi"))
        dropped(done, open_buckets)
        live = members.join(known.labels, "set_key").join(refuted, "set_key", "left").repartition("bucket").sortWithinPartitions("bucket")
        pairs = saved(live.select("bucket", "set_key", "component", "n_shingles", "sketch", "failed").mapInArrow(more_candidates(tries), "a long, b long").distinct())
        tries *= GROWTH
    return known.labels


def link(docs: DataFrame, text: str = "text", key: str = "doc_id", row: Column | None = None, **how) -> DataFrame:
    """key, row_key (row, or a hash of key and text), n_shingles and component_id (the smallest key of the component) of every row of docs."""
    bounded_batches(docs.sparkSession)
    rows = saved(described(docs, text, key, row))
    labels = set_components(docs, rows, text, **how)
    full = rows.filter("set_key is not null").select("key", "row_key", "n_shingles", "set_key")
    named = saved(full.groupBy("set_key").agg(F.min("key").alias("least")).join(labels, "set_key", "left").withColumn("component", F.coalesce("component", "set_key")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = salted_join(named, least, "component").select("set_key", "component_id")
    columns = [F.col("key").alias(key), "row_key", "n_shingles", F.coalesce("component_id", "key").alias("component_id")]
    empty = rows.filter("set_key is null").withColumn("component_id", F.col("key"))
    return salted_join(full, by_set, "set_key").select(*columns).unionByName(empty.select(*columns))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, that with the smallest key, with all columns; texts without words all stay.

    Of rows with one key in a component, the one with the smallest hash of all its columns (but maps) stays.
    """
    names = docs.columns
    mark = "_row" + "_" * max(map(len, names))  # a name that no column has
    marked = docs.withColumn(mark, F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant")))
    found = saved(link(marked, text, key, F.col(mark)))
    full = found.filter("n_shingles > 0")
    chosen = full.groupBy("component_id").agg(F.min(F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), "row_key")).alias("first")).select("first.row_key")
    chosen = chosen.union(found.filter("n_shingles = 0").select("row_key")).distinct()
    kept = marked.join(chosen.withColumnRenamed("row_key", mark), mark, "left_semi")
    repeated = full.groupBy("row_key").count().filter("count > 1").select(F.col("row_key").alias(mark))
    if not repeated.isEmpty():
        # Rows that agree in all columns are one document.
        again = kept.join(repeated, mark, "left_semi").dropDuplicates([mark])
        kept = kept.join(repeated, mark, "left_anti").unionByName(again)
    return kept.select(*names)
