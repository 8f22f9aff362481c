"""Every copy that the mix takes has its place in training order."""

from collections import defaultdict

import pytest

from pliego.llm import mixing


def test_every_copy_has_a_position(spark):
    rows = [(i, " ".join("w" * (i % 7)), "abc"[i * i % 3]) for i in range(90)]
    mixed = mixing.positions(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    taken = defaultdict(list)
    for r in mixed:
        at = r.positions or []
        assert len(at) == (-(-r.taken // r.size) if r.taken else 0)
        assert r.position == (at[0] if at else None)
        for n, t in enumerate(at):
            taken[r.source].append((t, min(r.size, r.taken - n * r.size)))
    assert max(len(r.positions or []) for r in mixed) == 2
    by = {r.source: r for r in mixed}
    for source, copies in taken.items():
        whole, slope, done = int(by[source].target), by[source].slope, 0
        for t, size in sorted(copies):
            done += size
            assert t + slope * (t * t - t) == pytest.approx(done / whole)
        assert done == whole


def test_the_query_equals_its_sql_with_places_and_kept_columns(spark, tmp_path, monkeypatch):
    import duckdb
    from pyspark.sql import functions as F

    from pliego.llm.queries import ORACLES, QUERIES

    rows = [(i, None if i % 31 == 0 else " ".join("w" * (i * 7 % 23)), ["a", "b", None, "é", "a"][i % 5], f"x{i}") for i in range(400)]
    df = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, source string, size string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(mixing, "GROUP_BUCKETS", 2)
    got = QUERIES["op9_mixing"](spark, str(tmp_path))
    want = duckdb.sql(ORACLES["op9_mixing"].replace("from documents", f"from '{tmp_path}/documents.parquet/*.parquet'"))
    assert got.columns == want.columns
    places = [r for r in got.collect()]
    assert sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.positions) for r in places) == sorted((a, b, c, round(d, 6), e, f) for a, b, c, d, e, f in want.fetchall())
    assert any("," in r.positions for r in places) and any(r.positions == "" for r in places)
    for sources in (mixing.BROADCAST_SOURCES, 0):
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", sources)
        kept = mixing.mix(df, bucket_rows=7, keep=("text",)).select("doc_id", "taken", F.col("text").isNull().alias("n")).collect()
        assert sorted((r.doc_id, r.taken) for r in kept) == sorted((r.doc_id, r.taken) for r in places)
        assert all(r.n == (r.doc_id % 31 == 0) for r in kept)
