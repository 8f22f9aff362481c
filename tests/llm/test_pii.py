"""Surrogates: format, distinctness, coreference, and that nothing detected is left."""

import random

import pytest

from pliego.llm import pii

KEY = b"test"


def one(text):
    return pii.rewrite(text, KEY)


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("Write to Jane.Doe99@Mail.example.com, now.", ["email"]),
        ("call +1 (743) 555-3824 or 743-555-3824.", ["phone", "phone"]),
        ("card 4785380592391139### and 4785 3805 9239 1139", ["card", "card"]),
        ("not a card: 2123465659789240", []),
        ("at 152.143.123.131!! but not 1.2.3 or 300.1.1.1", ["ip"]),
        ("ssn 123-45-6789", ["ssn"]),
        ("Mr. John Smith met Frau Müller and госпожа; Госпожа Иванова", ["name_m", "name_f", "name_f"]),
        ("version 2.0. of 3.", []),
        ("", []),
    ],
)
def test_detects_and_keeps_format(text, kinds):
    new, found = one(text)
    assert [e.kind for e in found] == kinds
    again = pii.entities(new)
    assert [e.kind for e in again] == kinds
    for a, b in zip(found, again, strict=True):
        assert a.known != b.known
        if not a.kind.startswith("name"):
            assert [("d" if c.isdigit() else "l" if c.isalpha() else c) for c in a.shown] == [("d" if c.isdigit() else "l" if c.isalpha() else c) for c in b.shown] or a.kind == "ip"
    gaps = lambda t, es: [t[x:y] for x, y in zip([0, *(e.end for e in es)], [*(e.start for e in es), len(t)], strict=True)]
    assert gaps(text, found) == gaps(new, again)


def test_coreference_across_formats():
    a, _ = one("+1 (743) 555-3824")
    b, _ = one("+1 743-555-3824")
    assert pii._digits(a) == pii._digits(b)
    assert one("A@B.com")[0].lower() == one("a@b.com")[0]


def test_permutations_are_distinct_and_move_everything():
    keyed = pii.Keyed(KEY)
    for n in (2, 3, 10, 97, 260):
        image = [keyed.permute(x, n, "t") for x in range(n)]
        assert sorted(image) == list(range(n))
        assert all(x != y for x, y in enumerate(image))
    even = [x for x in range(50) if x % 2 == 0]
    assert sorted(keyed.permute(x, 50, "t", lambda x: x % 2 == 0) for x in even) == even


def test_classes_and_keys():
    for ip in ("10.1.2.3", "192.168.0.9", "172.16.5.4", "233.1.1.1", "8.8.8.8"):
        new = one(ip)[0]
        as_int = lambda t: int.from_bytes(bytes(map(int, t.split("."))), "big")
        assert pii.ip_class(as_int(ip)) == pii.ip_class(as_int(new))
    assert pii.rewrite("8.8.8.8", b"x") != pii.rewrite("8.8.8.8", b"y")


def test_names_that_meet_are_moved(spark, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", 1)
    rnd = random.Random(4)
    names = {"".join(rnd.choice("abcdef") for _ in range(6)).capitalize() for _ in range(40)}
    rows = [(i, f"Mr. {n} said so, and Mr. {n} left.", "x") for i, n in enumerate(sorted(names))] + [(98, None, "y"), (99, "", None), (99, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_spans string").repartition(3)
    got = {r.doc_id: r for r in pii.replace(df, KEY).collect()}
    made = [[e.known for e in pii.entities(got[i].text)] for i in range(len(names))]
    assert all(len(x) == 2 and x[0] == x[1] for x in made)
    assert len({x[0] for x in made}) == len(names)
    assert got[98].text is None and got[98].pii_spans == "" and got[99].text == ""
    assert pii.replace(spark.createDataFrame([], df.schema), KEY).count() == 0


@pytest.mark.parametrize(
    ("text", "left"),
    [
        ("Dr. Smith and Mr. Smith met; later Smith left, said SMITH.", ["smith"]),
        ("Mr. John Smith wrote. John Smith, or Smith, signed; Prof. Dr. Anna-Maria O'Brien's too.", ["john", "smith", "anna", "maria", "brien"]),
        ("Mr. 王小明 and Mr. Arun नरेंद्र and Ms. שרה לוי", ["王小明", "arun", "नरेंद्र", "שרה", "לוי"]),
        ("Herr Müller, Frau Müller und Dr. MÜLLER", ["müller"]),
        ("Господин Йован Ђорђевић и Κύριος Νίκος Παπαδόπουλος", ["йован", "ђорђевић", "νίκος", "παπαδόπουλος"]),
        ("call +7 912 345 67 89, +359 2 123 4567 or +4915112345678", ["912 345", "123 4567", "15112345678"]),
        ("Mr. J. Smith", ["smith"]),
    ],
)
def test_nothing_detected_stays_and_mentions_corefer(text, left):
    new, found = one(text)
    assert not any(x in new.lower() for x in left), new
    assert one(text)[0] == new


def test_family_names_corefer_across_titles_and_keep_gender_and_script():
    words = lambda t: [w.strip(".,;").lower() for w in one(t)[0].split()]
    family = words("Mr. Smith")[1]
    assert words("Dr. Smith")[1] == words("Ms. Smith")[1] == words("Mrs. Ann Smith")[2] == words("SMITH Mr. SMITH".title())[2] == family
    assert words("Mr. Kim Smith")[1][:-1] == words("Ms. Kim Smith")[1][:-1] and words("Mr. Kim Smith")[1][-1] == "n" and words("Ms. Kim Smith")[1][-1] == "a"
    assert words("Dr. Kim Smith and Ms. Smith")[1][-1] == "a"
    assert words("Mr. Müller")[1] == words("Mr. Mu\u0308ller")[1]
    assert any(c in words("Mr. Müller")[1] for c in "áéíóú") and not any(c in family for c in "áéíóú")
    assert one("+7 912 345 67 89")[0].startswith("+7 ") and one("+359 2 123 4567")[0].startswith("+359 ")
    assert one("Mr. 王小明")[0][4:].strip() != "王小明" and all("一" <= c <= "龥" for c in one("Mr. 王小明")[0][4:])


def test_made_words_never_meet():
    keyed = pii.Keyed(KEY)
    letters = ["a", "b", "é", "ö", "z"]
    every = [a + b + c for a in letters for b in ["", *letters] for c in ["", *letters]]
    made = {pii._made_word(keyed, w, "family", 1) for w in every}
    assert len(made) == len(set(every))
    blocks = ["".join(x) for x in zip("王小明王小", "明王小小王", strict=True)]
    assert len({pii._made_word(keyed, w, "family", 1) for w in blocks}) == len(set(blocks))


def test_collisions_are_found_and_raise(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"Mr. N{chr(97 + i)} of a{i}@b.example.com, +1 743-555-38{i:02d}") for i in range(9)], "doc_id long, text string")
    assert pii.collisions(df, KEY).count() == 0
    monkeypatch.setattr(pii, "with_surrogates", lambda found, key: found.selectExpr("kind", "known", "'same' as surrogate"))
    with pytest.raises(ValueError, match="collide"):
        pii.replace(df, KEY)
    assert pii.replace(df, KEY, check=False).count() == 9


def test_long_texts_take_time_in_proportion():
    import time

    text = " ".join(f"mail{i}@host{i}.example.com and Mr. Name{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} at 10.0.{i % 250}.{i // 250}," for i in range(8000))
    start = time.time()
    found = pii.entities(text + " x" * 500_000)
    assert len(found) == 24_000 and time.time() - start < 5
