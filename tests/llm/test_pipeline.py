"""The whole pipeline against its stages in plain Python on a small fixture."""

import random
import re

import duckdb
import pyarrow as pa

import corpus_pipeline
from test_jaccard import shingles

from pliego.llm import decontaminate, mixing, quality, secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def fixture():
    rnd = random.Random(20)
    word = lambda: rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") + rnd.choice("bcdfglmnprst") + rnd.choice("aeiou")
    clean = lambda n: " ".join(word() for _ in range(n))
    item = clean(20)
    rows = [(i, clean(rnd.randint(55, 120)), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more", "en", "s0") for i in range(5)]  # near copies
    rows += [(110 + i, rows[i + 10][1], "en", "s1") for i in range(5)]  # exact ones
    rows += [(120, clean(60) + " " + item + " " + clean(30), "de", "s2"), (121, clean(30) + " " + item.upper() + ". " + clean(30), "de", "s2")]
    rows += [(130, clean(60) + " password = hunter22x and more " + clean(5), "en", None), (131, clean(70), "en", "é")]
    rows += [(140 + i, " ".join(f"{rnd.choice('QXZJ')}{rnd.randint(0, 99)}$$$ ***" for _ in range(70)), "en", "s3") for i in range(6)]
    rows += [(150, "too short", "en", "s3"), (151, None, None, None), (152, "", "en", "s1"), (153, "again and again " * 40, "en", "s1")]
    rows = [(*r, len(r[1]) if r[1] is not None else None, "x") for r in rows]
    labels = [(r[0], int(not 140 <= r[0] < 150), 0) for r in rows if r[0] % 2 == 0]
    return rows, labels, [(1, item), (2, None)]


def tables(spark, folder, rows, labels, items):
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_every_stage_works_on_all_that_is_kept(spark, tmp_path):
    rows, labels, items = fixture()
    tables(spark, tmp_path, rows, labels, items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    ratio = quality.fit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    m = quality.measures(pa.array([r[1] for r in rows]), ratio)
    good = [r for r, bad, score in zip(rows, m["base_failed"], m["score"], strict=True) if not bad and score >= quality.THRESHOLD]
    assert {r[0] for r in rows} - {r[0] for r in good} == {*range(140, 146), 150, 151, 152, 153}
    unique, seen = [], []
    for r in sorted(good):
        s = shingles(r[1])
        if not any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
            unique.append(r)
        seen.append(s)
    assert {r[0] for r in good} - {r[0] for r in unique} == {*range(100, 105), *range(110, 115)}
    words = lambda t: re.findall(r"[a-z]+", t.lower())
    holds = lambda t: any(words(t)[i : i + 20] == words(items[0][1]) for i in range(len(words(t))))
    clean = [r for r in unique if not holds(r[1])]
    assert {r[0] for r in unique} - {r[0] for r in clean} == {120, 121}
    masked = [(r[0], secrets.redact_text(r[1]), r[2], r[3]) for r in clean]
    docs = pa.table({c: [r[i] for r in masked] for i, c in enumerate(("doc_id", "text", "lang", "source"))})
    want = duckdb.connect().register("docs", docs).sql(mixing.MIX_SQL.format(docs="docs")).fetchall()
    assert {(i, r.size, r.source_size, round(r.target, 6), r.taken) for i, r in got.items()} == {(a, b, c, round(d, 6), e) for a, b, c, d, e in want}
    assert {(i, r.text, r.lang, r.source, r.n_chars) for i, r in got.items()} == {(*r, len(r[1])) for r in masked}
    assert secrets.MASK in got[130].text and "hunter22x" not in got[130].text
    assert all(len(r.positions or []) == (-(-r.taken // r.size) if r.taken else 0) for r in got.values())
    assert decontaminate.leaks(spark.createDataFrame([(i, r.text) for i, r in got.items()], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_stages_keep_the_columns_and_empty_tables(spark, tmp_path):
    rows, labels, items = fixture()
    tables(spark, tmp_path, rows, labels, items)
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        bare = docs.select("doc_id", "text", "source")
        assert stage(spark, bare, str(tmp_path)).columns == bare.columns, name
    assert corpus_pipeline.source_mix(spark, docs.select("doc_id", "text", "source").limit(0), str(tmp_path)).count() == 0
