"""Attribute extraction by ordered rules, as a join with the rules of a text's category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pliego.model import MAX_BROADCAST_ROWS, Register


def yields(rows: DataFrame, key: str, text: str, category: str, register: Register) -> DataFrame:
    """key, attr, role, attr_ord, rule_ord, value, legal of every rule that finds something."""
    rules = register.rules(rows.sparkSession)
    n = sum(len(a.rules) for x in register.attributes.values() for a in x)
    rules = F.broadcast(rules) if n <= MAX_BROADCAST_ROWS else rules
    hits = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(category).alias("category_id")).join(rules, "category_id").filter(F.expr("text rlike pattern"))
    value = F.when(F.col("kind") == "regex", F.expr("replace(template, '{1}', regexp_extract(text, pattern, 1))")).otherwise(F.col("template"))
    return hits.select("key", "category_id", "attr", "role", "attr_ord", "rule_ord", "pattern", value.alias("value")).join(F.broadcast(rules.select("category_id", "attr", "domain").distinct()) if n <= MAX_BROADCAST_ROWS else rules.select("category_id", "attr", "domain").distinct(), ["category_id", "attr"]).withColumn("legal", F.array_contains("domain", F.col("value"))).drop("domain")


def extracted(found: DataFrame) -> DataFrame:
    """key, category_id, attr, role, value: the first legal yield of each attribute."""
    first = found.filter("legal").groupBy("key", "category_id", "attr", "role", "attr_ord").agg(F.min_by("value", "rule_ord").alias("value"), F.min("rule_ord").alias("rule_ord"))
    return first


def illegal(found: DataFrame) -> DataFrame:
    """The yields outside their domain that came before an attribute's first legal one."""
    w = Window.partitionBy("key", "attr")
    return found.withColumn("chosen", F.min(F.when(F.col("legal"), F.col("rule_ord"))).over(w)).filter(~F.col("legal") & (F.col("chosen").isNull() | (F.col("rule_ord") < F.col("chosen")))).drop("chosen")


def attribute_maps(values: DataFrame, key: str = "key") -> DataFrame:
    """key and its attributes as a map in the order of names."""
    return values.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("attr", "value")))).alias("attributes"))


def merged(primary, secondary):
    """Union of two maps; the first wins."""
    empty = F.create_map().cast("map<string,string>")
    return F.map_zip_with(F.coalesce(primary, empty), F.coalesce(secondary, empty), lambda k, a, b: F.coalesce(a, b))


def pruned(attributes):
    """A map without its null values."""
    return F.map_filter(attributes, lambda _, v: v.isNotNull())


def without(attributes, names: tuple[str, ...]):
    """A map without bookkeeping entries, as JSON with sorted keys."""
    kept = F.map_filter(attributes, lambda k, _: ~k.isin(*names)) if names else attributes
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(kept))))


def coverage(values: DataFrame, total: int) -> DataFrame:
    """attr, n and the share of all rows that have it."""
    return values.groupBy("attr").agg(F.count_distinct("key").alias("n")).withColumn("share", F.round(F.col("n") / max(total, 1), 3))
