"""What keeps tasks, the driver and repeated work small, on small inputs."""

import __spark_entry__
from pliego import scratch
from pliego.operators import resolve
from pliego.plans.catalog_queries import REGISTER
from pliego.store import Catalog, offer_variants

SF = "/root/testdata/sf0.001"


def test_tasks_of_the_joint_resolution_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(scratch, "TASK_ROWS", 500)
    found = __spark_entry__.queries()["resolve_joint"](spark, SF)
    rows = found.rdd.glom().map(len).collect()
    assert len(rows) >= 12 and max(rows) < 1500 and sum(rows) == found.count()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_price_evidence_is_read_once_a_text(spark):
    for name in ("price_basis", "price_cross_check"):
        assert "regexp_" not in plan(__spark_entry__.queries()[name](spark, SF))


def test_variants_of_a_later_batch_leave_the_earlier_rows_where_they_are(spark, tmp_path, monkeypatch):
    written, write = [], Catalog._write

    def noted(self, name, number, rows, mode="overwrite"):
        written.append((name, number, mode))
        return write(self, name, number, rows, mode)

    monkeypatch.setattr(Catalog, "_write", noted)
    records = spark.createDataFrame([("r", "c", {"a": "1"}, {}, "t", 1)], "record_key string, category string, identity map<string,string>, descriptive map<string,string>, raw_text string, seq long")

    def batch(*offers):
        rows = [("T", "1", "gp", i, "x", True, price, 1.0, price, "CLP", "2024-01-01") for i, price in offers]
        return offer_variants(spark.createDataFrame(rows, "tender_id string, item_id string, node_id string, offer_id string, text string, awarded boolean, unit_price double, quantity double, total_clp double, currency string, date string"))

    store = Catalog(spark, f"{tmp_path}/catalog")
    held = lambda: sorted((r.offer_id, r.unit_price) for r in store.load("products").collect())
    store.merge(0, records, batch(("a", 1.0), ("b", 2.0), (None, 9.0)))
    for _ in range(2):  # the same batch again counts once
        store.merge(1, records, batch(("b", 3.0), ("c", 4.0)))
        assert held() == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    store.merge(2, records, batch(("d", 5.0)))
    assert held() == [("a", 1.0), ("b", 3.0), ("c", 4.0), ("d", 5.0)]
    assert [x for x in written if x[0] == "products"][:3] == [("products", 0, "overwrite"), ("products", 1, "overwrite"), ("products", 1, "append")]


def test_many_texts_are_not_sent_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(resolve, "MAX_BROADCAST_ROWS", 2)
    rows = spark.createDataFrame([(i, f"red ring N°{i}") for i in range(5)] + [(5, None)], "id long, t string")
    many, few = (resolve.prepared(rows.filter(f"id < {n} or t is null"), "t", "t", REGISTER) for n in (5, 2))
    assert "strategy=merge" in plan(many) and "strategy=broadcast" in plan(few)
    assert many.count() == 6 and many.filter("t_cls.category = 'ring'").count() == 5
