"""The similarity join against brute force over all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pliego.llm import jaccard

SCHEMA = "doc_id long, text string, component string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows)))


def corpus(seed, n_base=40, copies=8):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for _ in range(n_base):
        words = [word() for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 8, 9, 12, 20, 60, 150, 400]))]
        if rnd.random() < 0.2:
            words = passage.split() + words
        rows.append(" ".join(words))
        for _ in range(rnd.randint(0, copies)):
            near = list(words)
            for _ in range(rnd.randint(0, 1 + len(words) // 40)):
                if near:
                    at = rnd.randrange(len(near))
                    near[at : at + rnd.randint(0, 1)] = [word()] * rnd.randint(0, 2)
            rows.append(" ".join(near).upper() if rnd.random() < 0.2 else "\n".join(near))
    rows += ["", None, " \n\t", None]
    rnd.shuffle(rows)
    return [(i, t, "clash") for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "how"), [(1, {}), (2, {"hot": 2}), (3, {"hot": 3, "bucket": 3}), (4, {"hot": 3, "ranges": 50, "coarse": 4})])
def test_components_equal_brute_force(spark, seed, how):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(df, **how).collect())
    assert got == brute(rows)


def test_signatures_never_lose_a_link():
    rnd = np.random.default_rng(5)
    for _ in range(400):
        n = int(rnd.choice([5, 6, 7, 9, 10, 13, 20, 45, 100, 333]))
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        drop = int(rnd.integers(0, max(1, n // 5) + 1))
        b = np.unique(np.concatenate([rnd.permutation(a)[drop:], rnd.integers(0, 1 << 63, int(rnd.integers(0, max(1, n // 5) + 1)), dtype=np.uint64)]))
        if len(a) and len(b) and jaccard.linked(a, b) and not np.array_equal(a, b):
            assert len(np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)))
            bits = [np.frombuffer(jaccard.sketch(x), np.uint64) for x in (a, b)]
            assert jaccard.can_link(len(a), bits[0], np.array([len(b)]), [bits[1]])[0]


def test_every_case_has_a_result(spark):
    assert jaccard.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(7, "a b c d e f", "x"), (7, "a b c d e f", "x"), (3, "A B C D E F", "y"), (None, "a b c d e f", "z"), (9, None, "w"), (10, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id) for r in jaccard.link(df).collect())
    assert got == [((False, 3), 2, 3), ((False, 7), 2, 3), ((False, 7), 2, 3), ((False, 9), 0, 9), ((False, 10), 0, 10), ((True, 0), 2, 3)]
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.n_shingles) for r in kept.collect()) == [(3, "y"), (9, "w"), (10, None)]


def test_short_texts_are_one_shingle():
    sets = jaccard.sets_of(pa.array(["a b", "a  B", "b a", "a b c d e", None]))
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0]
    assert np.array_equal(sets[0], sets[1])
    assert not np.array_equal(sets[0], sets[2])


def test_texts_around_one_footer_take_few_rounds(spark, monkeypatch):
    """Two hundred sets in one large bucket, of which few link."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    footer = " ".join(word() for _ in range(40))
    rows = [(i, " ".join(word() for _ in range(45)) + " " + footer) for i in range(200)]
    rows += [(300 + i, rows[i][1].replace(" ", "  ") + " " + word()) for i in range(0, 60, 2)]
    written = []
    from pliego.llm import cluster

    keep = cluster.saved
    monkeypatch.setattr(jaccard, "saved", lambda df: written.append(1) or keep(df))
    # All sets in one bucket, as if a signature's parts held the footer alone.
    monkeypatch.setattr(jaccard, "shared_signatures", lambda docs, *a: docs.sparkSession.createDataFrame([(1, jaccard.set_key(s)) for s in jaccard.sets_of(pa.array([r[1] for r in rows]))], "bucket long, set_key long").distinct())
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), bucket=3).collect())
    assert got == brute([(*r, "") for r in rows])
    assert len(written) < 60


def test_hot_signatures_that_share_half_their_bits():
    one, two = (1 << 40) + 7, (1 << 41) + 7
    packed = [b for sigs in (one, two) for b in jaccard._pack(np.full(4, sigs, np.uint64), np.arange(4), np.arange(4, dtype=np.int64) + sigs % 100, 1, 2)]
    packed += list(jaccard._pack(np.array([two], np.uint64), np.zeros(1, np.int64), np.array([999], np.int64), 1, 2))
    found = jaccard._buckets(pa.Table.from_batches(packed)).to_pydict()
    of = lambda name: {k for b, k in zip(found["bucket"], found["set_key"], strict=True) if b == name}
    assert 999 in of(two) and set(range(two % 100, two % 100 + 4)) <= of(two) and set(range(one % 100, one % 100 + 4)) <= of(one)


@pytest.mark.parametrize("how", [{"tag_bits": 3}, {"tag_bits": 3, "hot": 2, "bucket": 3, "ranges": 50, "coarse": 4}])
def test_sets_whose_tags_agree_lose_no_link(spark, how):
    rows = corpus(6)
    got = jaccard.link(spark.createDataFrame(rows, SCHEMA).repartition(7), **how).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


@pytest.mark.parametrize("whole", [False, True])
def test_packed_rows_are_small_and_whole(whole):
    """Three signatures of each of 4,000 sets in one range: 8.7 bytes each, or 12.7, when who and keys went as they are."""
    rnd = np.random.default_rng(8)
    keys, owner = rnd.integers(0, 1 << 32, 4000), np.repeat(rnd.permutation(4000), 3)
    sigs = rnd.integers(0, 1 << 63, 12000).astype(np.uint64)
    (packed,) = jaccard._pack(sigs, owner, keys, 1, 64, whole)
    row = packed.to_pylist()[0]
    assert sum(len(row[c]) for c in ("sigs", "who", "keys")) / 12000 < (9.5 if whole else 5.5)
    of, who = jaccard._owners(row["who"], row["keys"])
    got = np.frombuffer(row["sigs"], np.uint64 if whole else np.uint32).tolist()
    assert sorted(zip(got, of[who].tolist(), strict=True)) == sorted(zip((sigs if whole else sigs.astype(np.uint32)).tolist(), keys[owner].tolist(), strict=True))


def test_a_second_exchange_follows_only_where_rows_grow_too_small(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "set_key long, text string")
    passes = lambda ranges: jaccard.shared_signatures(docs, "text", docs.select("set_key"), ranges, coarse=4)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    assert [passes(r) for r in (4, 5, 16, 17)] == [1, 1, 1, 2]


def test_kept_rows_are_one_choice_and_no_column_is_touched(spark):
    from pyspark.sql import functions as F

    rows = [(1, "a b c d e f", f"v{i}", "mine") for i in range(6)] + [(2, None, "x", "mine"), (3, "long " * 300_000 + "end", "y", "mine"), (4, "long " * 300_000 + "end", "z", "mine")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, _row_key string").withColumn("m", F.create_map(F.lit("k"), F.col("lang")))
    once = sorted((r.doc_id, r.lang, r._row_key) for r in jaccard.keep_one(df.repartition(4)).collect())
    assert once == sorted((r.doc_id, r.lang, r._row_key) for r in jaccard.keep_one(df.repartition(2, "lang")).collect())
    assert [x[0] for x in once] == [1, 2, 3] and {x[2] for x in once} == {"mine"}


def test_salted_joins_equal_plain_ones(spark):
    from pliego.llm.cluster import salted_join

    left = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id end as k")
    right = spark.range(2000).selectExpr("id as k", "id * 2 as v")
    want = sorted(map(repr, left.join(right, "k", "left").select("id", "k", "v").collect()))
    assert sorted(map(repr, salted_join(left, right, "k").select("id", "k", "v").collect())) == want
