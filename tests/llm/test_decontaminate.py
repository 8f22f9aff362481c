"""Copies of items that templates alone do not find."""

import random

import pyarrow as pa
import pytest

from pliego.llm import decontaminate


def test_copies_dense_in_slots_or_in_another_case(spark):
    items = [
        (0, "Compute 12 + 45 - 3 * 7 + 18"),
        (1, "which of these rivers flows through the old town before it meets the sea"),
        (2, "Wann hat der Vater von Anna dem Bruder das Haus mit Garten und Keller in Berlin gezeigt"),
        (3, "tiny item"),
        (4, "7 km 3 kg 12 lb 9 m"),
    ]
    rows = [(10 + i, f"so it goes on, and {t} and so on") for i, t in items]
    rows += [(20 + i, f"so it goes on, and {t.title()} and so on") for i, t in items]
    rows += [(30 + i, f"so it goes on, and {t.lower()} and so on") for i, t in items]
    rows += [(40 + i, f"so it goes on, and {t.upper()} and so on") for i, t in items]
    rows += [(90, "compute 13 + 44 - 2 * 8 + 17 is another one"), (91, "8 km 4 kg 13 lb 10 m")]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(d, d % 10) for d, _ in rows if d < 90}


def test_another_case_in_other_scripts(spark):
    items = [(0, "Сколько яблок осталось у Маши после того как она отдала половину брату"), (1, "Πόσα μήλα έμειναν στον Γιώργο όταν έδωσε τα μισά στον αδελφό του χθες")]
    rows = [(10 + i, t.upper()) for i, t in items] + [(20 + i, t.lower()) for i, t in items]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(d, d % 10) for d, _ in rows}


def test_short_items_are_found_whole_and_long_ones_dense(spark):
    long = " ".join(f"word{chr(97 + i)}" for i in range(26))
    items = [(0, "What is the capital of France?"), (1, long)]
    w = long.split()
    rows = [(10, "so what is the capital of France then"), (20, "what is the capital of my heart"), (30, "so what is the capital of Peru then"), (11, " ".join(w[3:20])), (21, " filler filler filler filler filler filler filler filler filler filler ".join(" ".join(w[i : i + 5]) for i in range(0, 25, 5)))]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(10, 0), (30, 0), (11, 1)}


def test_items_of_one_template_count_once(spark):
    items = [(i, f"How many apples are left if Anna has {i + 20} apples and eats {i % 7 + 2} of them today") for i in range(300)] + [(900, "How many apples are left if Anna has 5 apples and eats 5 of them today")]
    rows = [(1, f"x {items[7][1]} x"), (2, "How many apples are left if Bert has 999 apples and eats 98 of them today"), (3, "How many apples are left if Bert has 9 apples and eats 9 of them today")]
    for size in (200, 1_000_000):
        got = {(r.doc_id, r.item_id, r.n_items) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), size=size).collect()}
        assert {(1, 7), (2, 0), (3, 900)} <= {x[:2] for x in got}
        if size > 200:
            assert {(d, n) for d, _, n in got if d < 3} == {(1, 300), (2, 300)}
    assert decontaminate.keep_clean(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), size=200).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_finds_equal_brute_force(seed):
    """Every passage of every item, by aligning each item at each place of each text, token by token."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]) + rnd.choice("abcdefgh")
    token = lambda: rnd.choice([word, word, word, lambda: str(rnd.randint(1, 30)), lambda: rnd.choice(["Anna", "Bert", "Carl"]), lambda: rnd.choice(["kg", "km"])])()
    texts = [" ".join(["start", *(token() for _ in range(rnd.choice([1, 3, 5, 8, 12, 20, 40])))]) for _ in range(25)]
    items = decontaminate.Items(list(range(len(texts))), texts)
    docs = []
    for _ in range(150):
        t = rnd.choice(texts).split()
        if rnd.random() < 0.5:
            t = t[: rnd.randint(1, len(t))]
        if rnd.random() < 0.5:
            swap = {x: token() for x in set(t) if not x[0].islower()}
            t = [swap.get(x, x) for x in t]
        docs.append(" ".join([*("fill" + rnd.choice("qrs") for _ in range(rnd.randint(0, 9))), *t, *("fill" + rnd.choice("qrs") for _ in range(rnd.randint(0, 9)))]))

    def slots(text):
        body, at = decontaminate.text_bytes(pa.array([text]))
        t = decontaminate.template(body, at)
        return [(int(k), w.lower()) for k, w in zip(t.slot, text.split(), strict=True)]

    fits = lambda a, b: a[0] == b[0] and (a[0] > 0 or a[1] == b[1])
    got = decontaminate.find(pa.array(docs), items)
    for text, found in zip(docs, got, strict=True):
        d, want = slots(text), set()
        for i, item in enumerate(texts):
            own = slots(item)
            n = min(5, len(own))
            for shift in range(-len(own), len(d)):
                pairs = [(own[p], d[p + shift]) for p in range(len(own)) if 0 <= p + shift < len(d)]
                runs = [k for k in range(len(pairs) - n + 1) if all(fits(*x) for x in pairs[k : k + n]) and sum(x[0][0] == 0 for x in pairs[k : k + n]) >= 3 or len(pairs[k : k + n]) == n and all(a[1] == b[1] for a, b in pairs[k : k + n])]
                cuts = [0, *(j for j in range(1, len(runs)) if runs[j] - runs[j - 1] > n + decontaminate.GAP), len(runs)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    covered = {k + j for k in runs[a:b] for j in range(n)}
                    same = [(pairs[k][0][0], pairs[k][0][1], pairs[k][1][1]) for k in sorted(covered) if pairs[k][0][0]]
                    if len(covered) >= decontaminate.needed(len(own)) and decontaminate.consistency(same) >= 0.8 and (len(own) >= 5 or all(x[1] == y[1] for x, y in pairs)):
                        want.add(i)
        assert {p.id for p in found} >= {i for i in want if texts.index(texts[i]) == i}, (text, want)
        assert all(p.covered >= decontaminate.needed(len(texts[p.id].split())) for p in found)
