"""Word counts and the trie against plain Python over the same texts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pliego.llm import scoring
from pliego.llm.words import text_bytes


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


def ppm(texts):
    """Method C with exclusion, straight from its definition."""
    seen = defaultdict(Counter)
    for t in texts:
        data = bytes([255] * scoring.ORDER) + lower(t).encode() + b"\xff"
        for i in range(scoring.ORDER, len(data)):
            for n in range(scoring.ORDER + 1):
                seen[data[i - n : i]][data[i]] += 1

    def score(text):
        data = bytes([255] * scoring.ORDER) + lower(text).encode() + b"\xff"
        total = 0.0
        for i in range(scoring.ORDER, len(data)):
            excluded = set()
            for n in range(scoring.ORDER, -1, -1):
                left = {s: c for s, c in seen.get(data[i - n : i], {}).items() if s not in excluded}
                if left:
                    whole = sum(left.values()) + len(left)
                    if data[i] in left:
                        total += math.log10(left[data[i]] / whole)
                        break
                    total += math.log10(len(left) / whole)
                    excluded |= set(left)
            else:
                total -= math.log10(256 - len(excluded))
        return total

    return score


def corpus(seed, n=60):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé'") for _ in range(rnd.randint(1, 4))) for _ in range(50)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 40]))) for _ in range(n)]
    texts += [texts[3]] * 5 + [None, "", "ZZ unseen \U0001f600"]
    return [(i, t, "x") for i, t in enumerate(texts)] + [(None, "Ab ab", "y"), (3, texts[3], "again")]


@pytest.mark.parametrize("head", [4, 1 << 19])
def test_scores_equal_brute_force(spark, head, monkeypatch):
    monkeypatch.setattr(scoring, "RANGE_TOKENS", 200)
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]
    train = [t for k, t, _ in rows if not held_out(k)]
    count = Counter(w for t in train for w in tokens(t))
    n, v = sum(count.values()), len(count)
    model = ppm(train)
    want = sorted((k if k is not None else -1, held_out(k), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)), 6), round(model(t), 3)) for k, t, _ in rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in scoring.score(df, head=head).collect())
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=2e-3)


def test_kept_contexts_give_a_distribution():
    rnd = np.random.default_rng(3)
    counts = {}
    data = rnd.choice([97, 98, 99, 255], 3000)
    for order in range(scoring.ORDER + 1):
        gram = np.zeros(len(data) - order, np.uint64)
        for j in range(order + 1):
            gram = gram << np.uint64(8) | data[j : len(data) - order + j].astype(np.uint64)
        g, n = np.unique(gram, return_counts=True)
        if order:
            context, total = g >> np.uint64(8), Counter()
            for c, m in zip(context.tolist(), n.tolist(), strict=True):
                total[c] += m
            keep = np.array([total[c] >= 60 for c in context.tolist()])
            g, n = g[keep], n[keep]
        counts[order] = (g, n)
    trie = scoring.Trie(counts)
    assert np.allclose((10.0 ** trie.log10.astype(float)).sum(1), 1, atol=1e-4)


def test_no_rows_and_nothing_to_learn(spark):
    assert scoring.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    keys = [k for k in range(60) if held_out(k)][:2]
    got = scoring.score(spark.createDataFrame([(k, "a b") for k in keys], "doc_id long, text string")).collect()
    assert all((r.train_tokens, r.n_known, r.n_tokens, r.base_score) == (0, 0, 3, 0.0) for r in got)
    assert all(r.score == pytest.approx(-4 * math.log10(256), abs=1e-3) for r in got)


def test_learned_model_beats_order_zero_on_held_out_texts():
    rnd = random.Random(7)
    make = lambda: " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(30))
    model = ppm([make() for _ in range(20)])
    unseen = make()
    symbols = Counter(unseen)
    entropy = sum(-n * math.log10(n / len(unseen)) for n in symbols.values())
    assert -model(unseen) < 0.6 * entropy
    body, _ = text_bytes(pa.array([unseen * 4]))
    assert -scoring.score_adaptive(body.tobytes()) < 4 * entropy


def test_rare_contexts_count_in_a_corpus_of_many(spark, monkeypatch):
    """The former model kept at most 4,000 contexts an order; here most stand in one text each."""
    rnd = random.Random(11)
    rows = [(i, "".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(400)), "x") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    train = [t for k, t, _ in rows if not held_out(k)]
    assert len({t[i : i + 4] for t in train for i in range(len(t))}) > 4000
    model = ppm(train)
    want = [model(t) for _, t, _ in rows]
    for how in ({}, {"chunk": 5000}, {"chunk": 1000}):
        if how.get("chunk") == 1000:
            monkeypatch.setattr(scoring, "PART_GRAMS", 300)
        got = {r.doc_id: r.score for r in scoring.score(df, **how).collect()}
        assert [got[k] for k, _, _ in rows] == pytest.approx(want, abs=1e-6)
