"""The catalog as versioned Parquet snapshots: generic products, variants, and the links of records.

A version is a folder a table, and counts once the last of its tables is whole. Batches carry numbers: a batch that
comes twice is written from the version before it again, so that nothing counts twice and a run that broke off goes on
where it stopped. Nodes, variants and links of a batch are merged in one step each, by joins on their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.model import MAX_BROADCAST_ROWS
from pliego.operators import catalog
from pliego.scratch import saved

_MAP = "map<string,string>"
SCHEMAS = {
    "nodes": f"node_id string, category string, identity_key string, identity {_MAP}, descriptive {_MAP}, records bigint, specificity int, parent_id string",
    "products": "product_id string, generic_id string, tender_id string, item_id string, offer_id string, unit_price double, total_clp double, quantity double, awarded boolean, currency string, date string, supplier_text string",
    "links": "record_key string, target_id string, raw_text string, seq bigint, version int, current boolean",
}


class Catalog:
    """Snapshots under path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(place)

    def last(self) -> int:
        """The number of the last whole version, -1 for none."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/links")
        files = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        return max([int(n[2:]) for n in names if n.startswith("v=") and self._exists(f"{self.path}/links/{n}/_SUCCESS")], default=-1)

    def load(self, table: str, version: int | None = None, category: str | None = None) -> DataFrame:
        """A table as of a version (the last), of one category or all."""
        version = self.last() if version is None else version
        if version < 0:
            return self.spark.createDataFrame([], SCHEMAS[table])
        found = self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.path}/{table}/v={version}")
        return found if category is None else found.filter(F.col("category") == category)

    def merge(self, number: int, records: DataFrame, products: DataFrame | None = None) -> None:
        """Batch number of records(record_key, category, identity, descriptive, raw_text, seq), and of variants, as version number.

        A record's earlier link retires. What a node's first record said of it stays. Parents are planned anew for the
        categories that got a node.
        """
        before = number - 1
        for back in range(number - 1, -1, -1):
            if self._exists(f"{self.path}/links/v={back}/_SUCCESS"):
                before = back
                break
        else:
            before = -1
        known, history = self.load("nodes", before), self.load("links", before)
        fresh = saved(catalog.nodes(records), "fresh")
        more = fresh.select("node_id", F.col("records").alias("more"))
        old = known.join(more, "node_id", "left").withColumn("records", F.col("records") + F.coalesce("more", F.lit(0))).drop("more", "parent_id")
        new = fresh.join(known.select("node_id"), "node_id", "left_anti")
        touched = new.select("category").distinct()
        every = saved(old.unionByName(new), "every")
        replanned = catalog.parents(every.join(touched, "category", "left_semi"))
        same = known.select("node_id", "parent_id").join(every, "node_id").join(touched, "category", "left_anti")
        self._write("nodes", number, replanned.unionByName(same))
        self._merge_products(number, before, products)
        links = records.select("record_key", catalog.node_id(catalog.identity_key(F.col("category"), F.col("identity"))).alias("target_id"), "raw_text", "seq")
        self._write("links", number, catalog.link(history, links))

    def _merge_products(self, number: int, before: int, products: DataFrame | None) -> None:
        """Variants of a version: the batch's are written first, then those of the version before that they don't replace.

        Only ids are shuffled to find what is replaced; the earlier rows pass by that list as they are.
        """
        if products is None:
            return self._write("products", number, self.load("products", before))
        self._write("products", number, products)
        if before >= 0:
            kept, ids = self.load("products", before), self.load("products", number).select("product_id")
            gone = saved(kept.select("product_id").join(ids, "product_id", "left_semi").distinct(), "replaced")
            gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_ROWS else gone.hint("merge")
            self._write("products", number, kept.join(gone, "product_id", "left_anti"), "append")

    def without(self, category: str) -> int:
        """A new version without a category's nodes, their variants, and the links to them; its number."""
        number = self.last() + 1
        gone = self.load("nodes").filter(F.col("category") == category).select("node_id")
        links = self.load("links").join(gone, F.col("target_id") == F.col("node_id"), "left_anti")
        products = self.load("products").join(gone, F.col("generic_id") == F.col("node_id"), "left_anti")
        self._write("nodes", number, catalog.without_category(self.load("nodes"), category))
        self._write("products", number, products)
        self._write("links", number, links)
        return number

    def counts(self) -> DataFrame:
        """name and n of every table, and the categories."""
        n = lambda name, rows: rows.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        nodes = self.load("nodes")
        return n("categories", nodes.select("category").distinct()).unionByName(n("nodes", nodes)).unionByName(n("products", self.load("products"))).unionByName(n("links", self.load("links")))

    def _write(self, table: str, number: int, rows: DataFrame, mode: str = "overwrite") -> None:
        columns = [c.split(" ")[0] for c in SCHEMAS[table].replace(_MAP, "map").split(", ")]
        rows.select(*columns).write.mode(mode).parquet(f"{self.path}/{table}/v={number}")


def variants(items: DataFrame) -> DataFrame:
    """A variant for each offer of items(tender_id, item_id, node_id, offers) that has an id, and the key of its own record; offers without one are counted, not written."""
    return offer_variants(items.select("tender_id", "item_id", "node_id", F.explode("offers").alias("o")).select("tender_id", "item_id", "node_id", "o.*"))


def offer_variants(offers: DataFrame) -> DataFrame:
    """The same of a row for each offer(tender_id, item_id, node_id, offer_id, text, awarded, unit_price, quantity, total_clp, currency, date): nothing has to be nested."""
    rows = offers.filter(F.col("node_id").isNotNull() & F.col("offer_id").isNotNull())
    key = catalog.record_key(F.lit("mp_oferta"), F.col("tender_id"), F.concat_ws(":", "item_id", "offer_id"))
    return rows.select(catalog.product_id(key).alias("product_id"), key.alias("record_key"), F.col("node_id").alias("generic_id"), "tender_id", "item_id", "offer_id", "unit_price", "total_clp", "quantity", F.coalesce("awarded", F.lit(False)).alias("awarded"), "currency", "date", F.col("text").alias("supplier_text"))
