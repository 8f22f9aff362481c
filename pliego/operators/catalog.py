"""Generic products: identity keys, the subsumption forest, variants and versioned links.

The forest is a function of the set of identity keys alone: each node's parent is, of the nodes of its
category whose identity attributes are a proper subset of its own, the one with the most attributes
(and the greatest id among those). So a batch plans it in one join, whatever order records come in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Identity attributes of a schema, at most.
MAX_ATTRIBUTES = 6


def identity_key(category: Column, attributes: Column) -> Column:
    """category|name=value|... by name; what is absent stays absent."""
    return _key(category, F.sort_array(F.map_entries(attributes)))


def _key(category: Column, entries: Column) -> Column:
    return F.concat_ws("|", category, F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])))


def node_id(key: Column) -> Column:
    return F.concat(F.lit("gp_"), F.substring(F.sha1(key), 1, 12))


def product_id(record_key: Column) -> Column:
    return F.concat(F.lit("pr_"), F.substring(F.sha1(record_key), 1, 12))


def record_key(source: Column, tender: Column, line: Column) -> Column:
    return F.concat_ws("|", source, tender, line)


def identity_values(key: Column) -> Column:
    """The attributes of an identity key."""
    return F.map_filter(F.str_to_map(key, F.lit(r"\|"), F.lit("=")), lambda k, v: v.isNotNull())


def nodes(records: DataFrame, seq: str = "seq") -> DataFrame:
    """A row for each identity of records(category, identity, descriptive, seq): the first record gives the descriptive attributes."""
    keyed = records.withColumn("identity_key", identity_key(F.col("category"), F.col("identity")))
    out = keyed.groupBy("category", "identity_key").agg(F.min_by("identity", seq).alias("identity"), F.min_by("descriptive", seq).alias("descriptive"), F.count("*").alias("records"))
    return out.withColumn("node_id", node_id(F.col("identity_key"))).withColumn("specificity", F.size("identity"))


def parents(found: DataFrame) -> DataFrame:
    """nodes with parent_id.

    A schema has MAX_ATTRIBUTES identity attributes at most, so a child has 2**MAX_ATTRIBUTES - 1 possible parents
    at most: the keys of its attributes' proper subsets, which meet the nodes in an equi-join.
    """
    n = F.size("identity")
    entries = F.when(n <= MAX_ATTRIBUTES, F.sort_array(F.map_entries("identity"))).otherwise(F.raise_error(F.lit(f"more than {MAX_ATTRIBUTES} identity attributes")))
    subsets = F.sequence(F.lit(0), F.pow(F.lit(2), n).cast("int") - 2)
    probes = found.filter(n > 0).select(F.col("node_id").alias("child_id"), "category", entries.alias("entries"), F.explode(subsets).alias("bits"))
    probes = probes.select("child_id", _key(F.col("category"), F.filter("entries", lambda e, i: F.getbit(F.col("bits"), i) == 1)).alias("identity_key"))
    best = probes.join(found.select("identity_key", "specificity", F.col("node_id").alias("p_id")), "identity_key").groupBy("child_id").agg(F.max(F.struct("specificity", "p_id")).alias("p"))
    return found.join(best.select(F.col("child_id").alias("node_id"), F.col("p.p_id").alias("parent_id")), "node_id", "left")


def versions(links: DataFrame, key: str = "record_key", seq: str = "seq") -> DataFrame:
    """links with version (1, 2, ... by seq) and current (the last)."""
    w = Window.partitionBy(key).orderBy(seq)
    return links.withColumn("version", F.row_number().over(w)).withColumn("current", F.lead(seq).over(w).isNull())


def link(history: DataFrame, new: DataFrame, key: str = "record_key") -> DataFrame:
    """history with new(record_key, target_id, ...) as the current versions: what was current retires."""
    last = history.groupBy(key).agg(F.max("version").alias("last"))
    fresh = new.join(last, key, "left").withColumn("version", F.coalesce("last", F.lit(0)) + 1).withColumn("current", F.lit(True)).drop("last")
    kept = history.join(new.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left").withColumn("current", F.col("current") & F.col("_k").isNull()).drop("_k")
    return kept.unionByName(fresh, allowMissingColumns=True)


def upsert(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new replace those of table with the same keys."""
    return table.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def checked(values: DataFrame, domains: DataFrame) -> DataFrame:
    """values(category_id, attr, value) that raise where a value is outside its attribute's domain, or the attribute unknown."""
    joined = values.join(domains, ["category_id", "attr"], "left")
    wrong = F.when(F.col("domain").isNull(), F.raise_error(F.concat(F.lit("unknown attribute "), "attr"))).when(~F.array_contains("domain", F.col("value")), F.raise_error(F.concat(F.lit("illegal value "), "value"))).otherwise(F.col("value"))
    return joined.withColumn("value", wrong).drop("domain")


def rollup(found: DataFrame, depth: int) -> DataFrame:
    """(ancestor, node_id) along parent_id, each node its own ancestor. A parent has fewer attributes than its child, so depth is the number of identity attributes of a schema, at most."""
    out = found.select(F.col("node_id").alias("ancestor"), "node_id")
    edges = found.filter("parent_id is not null").select(F.col("node_id").alias("e_child"), F.col("parent_id").alias("e_parent"))
    step = out
    for _ in range(depth):
        step = step.join(edges, step.ancestor == edges.e_child).select(F.col("e_parent").alias("ancestor"), "node_id")
        out = out.union(step)
    return out


def without_category(table: DataFrame, category: str) -> DataFrame:
    return table.filter(~F.col("category").eqNullSafe(category))
