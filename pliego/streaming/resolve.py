"""Incremental resolution: a stream of items into a growing catalog, exactly once.

Each micro-batch is resolved like a table and merged into the catalog under its batch number, so that a replayed batch
is merged from the version before it again: a node that two batches bring is one, and a record that comes again gets its
next version. What a stream has done is in its checkpoint; it goes on from there, and refuses another scope.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.model import Register
from pliego.operators import catalog, classify, extract, resolve
from pliego.scratch import saved
from pliego.store import Catalog


def resolved(rows: DataFrame, key: str, text: str, register: Register) -> DataFrame:
    """key, category, identity_key and node_id of the rows that classify."""
    rows = resolve.prepared(rows.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", "t", register)
    rows = rows.select("key", F.col("t_norm").alias("norm"), F.col("t_cls.category").alias("category")).filter("category is not null")
    values = extract.extracted(extract.yields(rows, "key", "norm", "category", register)).filter("role = 'identity'")
    maps = extract.attribute_maps(values).withColumnRenamed("key", "_k")
    rows = rows.join(maps, rows.key == maps["_k"], "left").withColumn("identity_key", catalog.identity_key(F.col("category"), F.coalesce("attributes", F.create_map().cast("map<string,string>"))))
    return rows.select("key", "category", "identity_key", catalog.node_id(F.col("identity_key")).alias("node_id"))


def records(batch: DataFrame, key: str, text: str, register: Register) -> DataFrame:
    """record_key, category, identity, descriptive, raw_text and seq of the rows that classify."""
    rows = resolve.prepared(batch, text, "t", register)
    rows = rows.select(F.col(key).cast("string").alias("record_key"), F.col(key).cast("bigint").alias("seq"), F.col(text).alias("raw_text"), F.col("t_norm").alias("norm"), F.when(resolve.status(F.col("t_cls")) == classify.CLASSIFIED, F.col("t_cls.category")).alias("category")).filter("category is not null")
    values = extract.extracted(extract.yields(rows, "record_key", "norm", "category", register))
    empty = F.create_map().cast("map<string,string>")
    for role in ("identity", "descriptive"):
        maps = extract.attribute_maps(values.filter(F.col("role") == role)).withColumnsRenamed({"key": "record_key", "attributes": role})
        rows = rows.join(maps, "record_key", "left").withColumn(role, F.coalesce(role, empty))
    return rows.select("record_key", "category", "identity", "descriptive", "raw_text", "seq")


def into_catalog(spark: SparkSession, stream: DataFrame, key: str, text: str, register: Register, path: str, checkpoint: str, scope: dict | None = None, on_batch=None):
    """The stream merged into the catalog at path, as far as it has come; on_batch(number, records) is told of each batch.

    scope, of the run that began, is kept beside the checkpoint: a run of another scope raises.
    """
    store = Catalog(spark, path)
    kept = spark.read.schema("scope string").json(f"{checkpoint}-scope").collect() if store._exists(f"{checkpoint}-scope/_SUCCESS") else []
    told = json.dumps(scope or {}, sort_keys=True)
    if kept and kept[0].scope != told:
        raise ValueError(f"the checkpoint is of scope {kept[0].scope}, not {told}")
    if not kept:
        spark.createDataFrame([(told,)], "scope string").write.mode("overwrite").json(f"{checkpoint}-scope")

    def merge(batch: DataFrame, number: int) -> None:
        found = saved(records(batch, key, text, register), "batch")
        store.merge(number, found)
        if on_batch:
            on_batch(number, found)

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return store


def run(spark: SparkSession, stream: DataFrame, key: str, text: str, register: Register, out: str, checkpoint: str):
    """The stream resolved to Parquet under out, as far as it has come."""

    def write(batch: DataFrame, number: int) -> None:
        resolved(batch, key, text, register).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out)


def windowed_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by kind and window of an event stream, late events kept for a while."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n"))
