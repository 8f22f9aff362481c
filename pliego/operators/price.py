"""Price series, currency conversion on the last known day, and deflation by a chained index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days back, the day itself included, that a rate may come from.
LOOKBACK_DAYS = 10
#: The indicator behind each currency.
INDICATORS = {"UF": "uf", "CLF": "uf", "USD": "dolar", "EUR": "euro"}


def as_of(rows: DataFrame, rates: DataFrame, day: str, indicator: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """rows with the rate (indicator, d, value) of day or of the latest of the days before it.

    Each rate is offered to the days it may serve, and one day keeps its latest: the join with rows
    is then an equi-join, and no row meets more than one rate.
    """
    offered = rates.select(F.col("indicator").alias("r_indicator"), F.explode(F.sequence("d", F.date_add("d", days - 1))).alias("r_day"), "d", "value")
    served = offered.groupBy("r_indicator", "r_day").agg(F.max_by("value", "d").alias("rate"))
    return rows.join(served, (F.col(indicator) == F.col("r_indicator")) & (F.col(day) == F.col("r_day")), "left").drop("r_indicator", "r_day")


def to_clp(rows: DataFrame, rates: DataFrame, amount: str, currency: str, day: str) -> DataFrame:
    """rows with clp; an unknown currency raises, a missing rate gives null."""
    table = F.create_map(*[F.lit(x) for kv in INDICATORS.items() for x in kv])
    upper = F.upper(F.col(currency))
    rows = as_of(rows.withColumn("_indicator", F.try_element_at(table, upper)), rates, day, "_indicator")
    clp = F.when(upper == "CLP", F.col(amount)).when(F.col("_indicator").isNotNull(), F.col(amount) * F.col("rate")).otherwise(F.raise_error(F.concat(F.lit("unsupported currency "), F.col(currency))))
    return rows.withColumn("clp", clp).drop("_indicator", "rate")


def cpi_index(variations: DataFrame) -> DataFrame:
    """month and index of variations(month, pct): 100 before the first, then chained.

    One running product in the order of months; there are as many rows as months, so one task is enough.
    """
    up_to = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return variations.select("month", (F.lit(100.0) * F.product(1 + F.col("pct") / 100.0).over(up_to)).alias("index"))


def months(first: Column, last: Column) -> Column:
    """The months from first to last, both with, as yyyy-MM."""
    month = lambda c: F.trunc(c, "month")
    return F.transform(F.sequence(month(first), month(last), F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))


def deflate(rows: DataFrame, index: DataFrame, amount: str, month: str, to_month: str | None = None) -> DataFrame:
    """rows with real: amount in to_month's money, or in the last month's."""
    own = index.select(F.col("month").alias("_m"), F.col("index").alias("_own"))
    base = index.agg(F.max_by("index", "month").alias("_base")) if to_month is None else index.filter(F.col("month") == to_month).select(F.col("index").alias("_base"))
    return rows.join(own, F.col(month) == F.col("_m"), "left").crossJoin(F.broadcast(base)).withColumn("real", F.col(amount) * F.col("_base") / F.col("_own")).drop("_m", "_own", "_base")  # one row


def series(products: DataFrame, nodes: DataFrame, category: str) -> DataFrame:
    """Awarded price points of a category by product and date."""
    found = products.filter(F.col("awarded") & F.col("unit_price").isNotNull()).join(nodes.filter(F.col("category") == category).select("node_id", "identity_key"), "node_id")
    return found.select(F.col("node_id").alias("product"), "identity_key", F.substring(F.coalesce(F.col("date").cast("string"), F.lit("")), 1, 10).alias("date"), "tender", "unit_price").orderBy("product", "date", "tender", "unit_price")


def series_summary(rows: DataFrame, top: int = 8) -> DataFrame:
    priced = rows.filter(F.coalesce("unit_price", F.lit(0.0)) != 0)
    return priced.groupBy("product").agg(F.count("*").alias("n"), F.median("unit_price").alias("median"), F.min("unit_price").alias("low"), F.max("unit_price").alias("high")).orderBy(F.col("n").desc(), "product").limit(top)
