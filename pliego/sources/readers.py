"""Input contracts and readers: tenders, items with their offers, orders, the catalog, definitions, state files."""

from __future__ import annotations

import csv
import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pliego.functions.numbers import in_segment
from pliego.functions.text import Abbreviation, contains, is_rubric, with_title

_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


TENDER = _schema(id_licitacion=_S, titulo=_S, fecha_publicacion=_S)
TENDER_ITEM = _schema(id_licitacion=_S, id_item=_S, descripcion_comprador=_S, codigo_unspsc_producto=_I, cantidad=_D, moneda_item=_S, unidad_medida=_S, nombre_producto_fuente=_S)
OFFER = _schema(id_licitacion=_S, id_item=_S, id_oferta=_S, descripcion_proveedor=_S, es_adjudicada=_B, precio_unitario=_D, precio_unitario_clean=_D, cantidad_ofertada=_D, cantidad_clean=_D, precio_total=_D, precio_total_clean=_D, precio_total_clp=_S, moneda=_S, fecha=_S)
ORDER_LINE = _schema(id_oc=_S, id_item_oc=_S, especificacion_comprador=_S, especificacion_proveedor=_S, codigo_unspsc_producto=_I, cantidad=_D, precio_neto=_D, total_linea_neto=_D, moneda_item=_S, unidad_medida=_S, fecha_envio=_S)


def _scope(rows: DataFrame, text: str, needle: str | None, segment: int | None) -> DataFrame:
    return rows.filter(F.col(text).isNotNull() & contains(F.col(text), needle) & in_segment(F.col("codigo_unspsc_producto"), segment))


def paged(rows: DataFrame, keys: list[str], skip: int = 0, limit: int | str | None = None) -> DataFrame:
    """A page in the order of keys; no limit, 'all', 0 or less means everything."""
    if limit in (None, "all") or int(limit) <= 0:
        return rows.orderBy(*keys).offset(skip) if skip else rows
    return rows.orderBy(*keys).offset(skip).limit(int(limit))


def tender_items(items: DataFrame, tenders: DataFrame, needle: str | None = None, segment: int | None = None, skip: int = 0, limit=None) -> DataFrame:
    """Item lines with their tender's title."""
    rows = _scope(items, "descripcion_comprador", needle, segment).join(tenders, "id_licitacion")
    return paged(rows, ["id_licitacion", "id_item"], skip, limit)


def item_offers(items: DataFrame, tenders: DataFrame, offers: DataFrame, needle: str | None = None, segment: int | None = None, skip: int = 0, limit=None) -> DataFrame:
    """One row for each item, with the array of its offers (empty when it has none)."""
    o = F.struct(
        F.col("id_oferta").alias("offer_id"),
        F.col("descripcion_proveedor").alias("text"),
        F.col("es_adjudicada").alias("awarded"),
        F.coalesce("precio_unitario_clean", "precio_unitario").alias("unit_price"),
        F.coalesce("cantidad_clean", "cantidad_ofertada").alias("quantity"),
        F.expr("try_cast(precio_total_clp as double)").alias("total_clp"),
        F.col("moneda").alias("currency"),
        F.col("fecha").alias("date"),
    )
    nested = offers.groupBy("id_licitacion", "id_item").agg(F.sort_array(F.collect_list(o)).alias("offers"))
    rows = tender_items(items, tenders, needle, segment, skip, limit).join(nested, ["id_licitacion", "id_item"], "left")
    return rows.withColumn("offers", F.coalesce("offers", F.array().cast(nested.schema["offers"].dataType)))


def offer_lines(offers: DataFrame, items: DataFrame, awarded_only: bool = False) -> DataFrame:
    rows = offers.join(items, ["id_licitacion", "id_item"]).filter(F.col("descripcion_proveedor").isNotNull())
    return rows.filter("es_adjudicada") if awarded_only else rows


ORDER = _schema(id_oc=_S, fecha_envio=_S)


def order_lines(lines: DataFrame, orders: DataFrame, needle: str | None = None, skip: int = 0, limit=None) -> DataFrame:
    """Purchase-order lines that have a text, in the columns of a source record."""
    dated = lines.drop("fecha_envio").join(orders.select("id_oc", "fecha_envio"), "id_oc")
    rows = dated.filter(F.col("especificacion_comprador").isNotNull() & contains(F.col("especificacion_comprador"), needle))
    rows = rows.select("id_oc", "id_item_oc", F.col("especificacion_comprador").alias("text"), F.col("especificacion_proveedor").alias("supplier_text"), F.col("codigo_unspsc_producto").alias("unspsc"), F.col("cantidad").alias("quantity"), F.col("precio_neto").alias("unit_price"), F.col("total_linea_neto").alias("total"), F.col("moneda_item").alias("currency"), F.col("unidad_medida").alias("uom"), F.col("fecha_envio").alias("date"))
    return paged(rows, ["id_oc", "id_item_oc"], skip, limit)


def count_in_scope(items: DataFrame, tenders: DataFrame, needle: str | None = None, segment: int | None = None) -> DataFrame:
    """n, the items that tender_items() gives for the scope."""
    return _scope(items, "descripcion_comprador", needle, segment).join(tenders.select("id_licitacion"), "id_licitacion").agg(F.count("*").alias("n"))


def count_by_text(items: DataFrame, offers: DataFrame, needle: str | None = None) -> DataFrame:
    """kind and n: items by their text, and offers by their item's."""
    found = items.filter(contains(F.col("descripcion_comprador"), needle))
    n = lambda rows, kind: rows.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    bound = offers.filter(F.col("descripcion_proveedor").isNotNull()).join(found.select("id_licitacion", "id_item"), ["id_licitacion", "id_item"])
    return n(found.filter(F.col("descripcion_comprador").isNotNull()), "items").unionByName(n(bound, "offers"))


def rubric_offers(offers: DataFrame, items: DataFrame) -> DataFrame:
    """The offers of lines that are nothing but a taxonomy path."""
    return offer_lines(offers, items.filter(is_rubric(F.col("descripcion_comprador"))))


def residue_items(records: DataFrame, nodes: DataFrame, products: DataFrame, prefix: str = "unspsc_") -> DataFrame:
    """text, code and spend of the current records that only a commodity code holds; a bucket's awarded spend is shared evenly by its records."""
    bucket = nodes.filter(F.col("category").startswith(prefix)).select("node_id", F.col("category").alias("code"))
    held = records.filter("current").join(bucket, F.col("target_id") == F.col("node_id")).select(F.coalesce("raw_text", F.lit("")).alias("text"), "code")
    spend = products.filter("awarded").join(bucket, F.col("generic_id") == F.col("node_id")).groupBy("code").agg(F.sum(F.expr("try_cast(total_clp as double)")).alias("bucket_spend"))
    sizes = held.groupBy("code").agg(F.count("*").alias("n")).join(spend, "code", "left").select("code", (F.coalesce("bucket_spend", F.lit(0.0)) / F.col("n")).alias("spend"))
    return held.join(sizes, "code").select("text", "code", "spend")


def item_spend(items: DataFrame, tenders: DataFrame, offers: DataFrame, segment: int | None = None) -> DataFrame:
    """text, context and awarded spend of the items that aren't rubrics; totals that aren't numbers count 0."""
    spend = offers.filter("es_adjudicada").groupBy("id_licitacion", "id_item").agg(F.sum(F.expr("try_cast(precio_total_clp as double)")).alias("spend"))
    rows = _scope(items, "descripcion_comprador", None, segment).filter(~is_rubric(F.col("descripcion_comprador"))).join(tenders, "id_licitacion", "left").join(spend, ["id_licitacion", "id_item"], "left")
    return rows.select(F.col("descripcion_comprador").alias("text"), F.col("titulo").alias("context"), F.coalesce("spend", F.lit(0.0)).alias("spend"))


def samples(items: DataFrame, tenders: DataFrame, regex: str, limit: int = 50) -> DataFrame:
    """Distinct item texts, with title, that a pattern matches as a whole."""
    text = with_title(F.col("descripcion_comprador"), F.col("titulo"))
    rows = items.join(tenders, "id_licitacion", "left").select(text.alias("text")).distinct()
    return rows.filter(F.col("text").rlike(f"^(?:{regex})$")).orderBy("text").limit(limit)


def training_rows(records: DataFrame, nodes: DataFrame) -> DataFrame:
    """text and label of the current records of curated categories."""
    rows = records.filter("current").join(nodes.select(F.col("node_id").alias("target_id"), "category"), "target_id")
    return rows.filter(~F.col("category").startswith("unspsc_")).select("raw_text", F.col("category").alias("label"))


def progress_log(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines timeline; broken lines are left out."""
    return spark.read.schema("ts double, processed bigint, total bigint, resolved bigint, unresolved bigint, created bigint").option("mode", "DROPMALFORMED").json(path)


def delimited(spark: SparkSession, path: str, sep: str = "|", schema: T.StructType | str | None = None) -> DataFrame:
    """With a schema, one pass; without one, types are inferred in a pass of their own."""
    reader = spark.read.option("sep", sep).option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def columnar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ranking(spark: SparkSession, path: str) -> DataFrame:
    """What writers.ranking() wrote."""
    return delimited(spark, path, ",", "`group` string, records bigint, distinct_texts bigint, spend double, spend_share double, cum_share double")


def state(path: str | Path) -> dict | None:
    """A checkpoint file, or None where there is none or a broken one (driver side)."""
    try:
        found = json.loads(Path(path).read_text("utf-8"))
    except (OSError, ValueError):
        return None
    return found if isinstance(found, dict) else None


def abbreviations(path: str | Path) -> tuple[str, tuple[Abbreviation, ...]]:
    """Version (the file's stem) and rules of a CSV of pattern and replacement, in the file's order (driver side)."""
    with open(path, newline="", encoding="utf-8-sig") as f:
        return Path(path).stem, tuple(Abbreviation(r["pattern"], r["replacement"]) for r in csv.DictReader(f))


def sql(spark: SparkSession, statement: str, hook: Callable[[DataFrame], DataFrame] | None = None, waits: tuple[float, ...] = (1, 2, 4)) -> DataFrame:
    """The result of a statement, planned again after each wait if that fails, and then changed by hook."""
    for wait in (*waits, None):
        try:
            found = spark.sql(statement)
            return found.transform(hook) if hook else found
        except Exception:
            if wait is None:
                raise
            time.sleep(wait)
    raise AssertionError


def rows_of(df: DataFrame) -> Iterator:
    """Rows one after the other, a partition at a time in the driver."""
    return df.toLocalIterator(prefetchPartitions=True)


def regions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path).select(F.explode("regions").alias("r")).select("r.*")


def folders(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The folders right below path, or what a pattern's group takes from their names."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.regexp_extract(F.col("path"), path.rstrip("/").split("/")[-1] + r"/([^/]+)/", 1).alias("folder")).filter("folder <> ''")
    if pattern:
        names = names.select(F.regexp_extract("folder", pattern, 1).alias("folder")).filter("folder <> ''")
    return names.distinct()


def grouped(rows: DataFrame, key: str) -> DataFrame:
    """key and the array of its rows."""
    return rows.groupBy(key).agg(F.collect_list(F.struct(*[c for c in rows.columns if c != key])).alias("rows"))


def nested(rows: DataFrame, outer: str, inner: str, order: str) -> DataFrame:
    """outer and a map from inner to the rest of its row as a struct; of rows with both keys equal, the last by order."""
    rest = [c for c in rows.columns if c not in (outer, inner)]
    last = rows.groupBy(outer, inner).agg(F.max_by(F.struct(*rest), order).alias("v"))
    return last.groupBy(outer).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(inner, "v")))).alias("by_" + inner))


def definitions(text: str) -> dict:
    """A JSON definition file (driver side)."""
    return json.loads(text)
