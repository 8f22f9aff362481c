"""The competitive-pricing report over a base matrix of (item, supplier) rows.

Every function takes and returns DataFrames; ``entity`` is the supplier under study. A base row has
item_key, anio, rut_comprador, nombre_comprador, producto, rut_proveedor, nombre_proveedor,
num_unidades, precio_unitario, precio_unitario_ganador and flag_adjudicado.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pliego.functions.numbers import competition_bucket, gap, portfolio_label, price_segment, product, ratio, segment_order, win_rate_band

#: A product that names nothing: left out of what can be recovered.
UNKNOWN_PRODUCT = "producto no identificable - especificación insuficiente"


def revenue() -> Column:
    """What a row's supplier earned."""
    return product(F.col("flag_adjudicado"), F.col("num_unidades"), F.col("precio_unitario"))


def _mine(base: DataFrame, entity) -> DataFrame:
    return base.filter(F.col("rut_proveedor") == entity)


def base_matrix(bids: DataFrame, items: DataFrame, entity) -> DataFrame:
    """bids(item_key, rut_proveedor, nombre_proveedor, unidades, precio, adjudicada) of the items in
    which entity bid, one row for each item and supplier, with items(item_key, ...) beside."""
    wanted = bids.filter(F.col("rut_proveedor") == entity).select("item_key").distinct()
    bids = bids.join(wanted, "item_key", "left_semi")
    cells = bids.groupBy("item_key", "rut_proveedor", "nombre_proveedor").agg(
        F.sum(F.coalesce("unidades", F.lit(0))).cast("bigint").alias("num_unidades"),
        F.round(F.avg("precio"), 6).alias("precio_unitario"),
        F.max(F.when(F.col("adjudicada"), 1).otherwise(0)).alias("flag_adjudicado"),
    )
    winning = bids.filter("adjudicada").groupBy("item_key").agg(F.round(F.avg("precio"), 6).alias("precio_unitario_ganador"))
    return cells.join(winning, "item_key", "left").join(items, "item_key", "left")


def item_stats(base: DataFrame) -> DataFrame:
    return base.filter(F.col("item_key").isNotNull()).groupBy("item_key").agg((F.count_distinct("rut_proveedor") - 1).alias("n_competidores"), F.var_samp("precio_unitario").alias("var_precio"))


def product_table(base: DataFrame, entity) -> DataFrame:
    mine = _mine(base, entity).join(item_stats(base), "item_key", "left")
    out = mine.groupBy("producto").agg(
        F.count("*").alias("ofertas"),
        F.sum("flag_adjudicado").alias("adjudicaciones"),
        F.coalesce(F.sum(revenue()), F.lit(0.0)).alias("revenue"),
        F.avg("flag_adjudicado").alias("win_rate"),
        F.avg(product(F.col("num_unidades"), F.col("precio_unitario"))).alias("ticket_promedio"),
        F.avg("n_competidores").alias("n_competidores_promedio"),
        F.avg("var_precio").alias("var_precios_promedio"),
    )
    return out.withColumn("segmento", win_rate_band(F.col("win_rate"))).withColumn("diagnostico", portfolio_label(F.col("segmento")))


def price_ranks(base: DataFrame) -> DataFrame:
    """Competition ranks of prices inside items; a null price has none and shifts nobody."""
    known = F.col("precio_unitario").isNotNull()
    w = Window.partitionBy("item_key", known).orderBy("precio_unitario")
    return base.withColumn("precio_rank", F.when(known, F.rank().over(w)))


def price_table(base: DataFrame, entity) -> DataFrame:
    """entity's items with rival quantiles, ranks, gaps and the price segment."""
    mine = _mine(base, entity).select("item_key", "anio", "producto", "rut_comprador", "nombre_comprador", F.col("precio_unitario").alias("precio_entidad"), "num_unidades", F.col("flag_adjudicado").alias("entidad_gano"), "precio_unitario_ganador")
    rivals = base.filter((F.col("rut_proveedor") != entity) & F.col("item_key").isNotNull()).groupBy("item_key").agg(
        F.percentile("precio_unitario", 0.25).alias("p25"),
        F.percentile("precio_unitario", 0.5).alias("p50"),
        F.percentile("precio_unitario", 0.75).alias("p75"),
        F.min("precio_unitario").alias("precio_siguiente_ganador"),
        F.count_distinct("rut_proveedor").alias("n_competidores"),
    )
    ranks = _mine(price_ranks(base), entity).select("item_key", "precio_rank")
    out = mine.join(rivals, "item_key", "left").join(ranks, "item_key", "left")
    out = (
        out.withColumn("gap", gap(F.col("precio_entidad"), F.col("p25")))
        .withColumn("gap_to_win", gap(F.col("precio_unitario_ganador"), F.col("precio_entidad")))
        .withColumn("gap_to_lose", gap(F.col("precio_siguiente_ganador"), F.col("precio_entidad")))
    )
    return out.withColumn("diagnostico", price_segment(F.col("entidad_gano"), F.col("gap_to_lose"), F.col("gap_to_win"))).withColumn("competition_bucket", competition_bucket(F.col("n_competidores")))


def product_split(products: DataFrame) -> DataFrame:
    """producto, ab and threshold: A at or above the median of mean competitors, B below or unknown."""
    threshold = products.agg(F.coalesce(F.median("n_competidores_promedio"), F.lit(0.0)).alias("threshold"))
    ab = F.when(F.col("n_competidores_promedio").isNull() | (F.col("n_competidores_promedio") < F.col("threshold")), "B").otherwise("A")
    return products.crossJoin(F.broadcast(threshold)).select("producto", ab.alias("producto_segmento"), "threshold")  # one row


def with_split(base: DataFrame, entity) -> DataFrame:
    """base with its products' A or B; products of which entity offered nothing go."""
    split = product_split(product_table(base, entity)).withColumnRenamed("producto", "split_producto")
    return base.join(split, F.col("producto").eqNullSafe(F.col("split_producto"))).drop("split_producto")


def rival_revenue(units: Column, won: Column, winning: Column) -> Column:
    return F.when(winning.isNotNull() & (F.coalesce(won, F.lit(0)) == 0), product(units, winning)).otherwise(0.0)


def annual_summary(universe: DataFrame, entity) -> DataFrame:
    """A row a year (null: (s/a)), and a Total whose ratios are made anew and whose means are weighted."""
    mine = _mine(universe, entity).join(item_stats(universe).select("item_key", "n_competidores"), "item_key", "left")
    lost = F.col("precio_unitario_ganador").isNotNull() & (F.coalesce("flag_adjudicado", F.lit(0)) == 0)
    mine = mine.select(F.coalesce(F.col("anio").cast("string"), F.lit("(s/a)")).alias("anio"), F.coalesce("n_competidores", F.lit(0)).alias("n_comp"), F.col("flag_adjudicado").alias("won"), F.when(lost, 1).otherwise(0).alias("lost"), revenue().alias("rev"), rival_revenue(F.col("num_unidades"), F.col("flag_adjudicado"), F.col("precio_unitario_ganador")).alias("rev_comp"))
    sums = [F.avg("n_comp").alias("comp_item"), F.count("*").alias("ofertas"), F.sum("lost").alias("adj_comp"), F.coalesce(F.sum("won"), F.lit(0)).alias("adjudicadas"), F.sum("rev_comp").alias("rev_comp"), F.sum("rev").alias("rev_entidad")]
    years = mine.groupBy("anio").agg(*sums)
    total = mine.agg(*sums).select(F.lit("Total").alias("anio"), "*")
    out = years.unionByName(total)
    return out.withColumn("wr_entidad", ratio(F.col("adjudicadas"), F.col("ofertas"))).withColumn("share_entidad", ratio(F.col("rev_entidad"), F.col("rev_entidad") + F.col("rev_comp")))


def optimal_discount(rows: DataFrame, keys: list[str]) -> DataFrame:
    """For each group: the discount of 1..80 % with the most recovered revenue, that revenue and its items.

    An item is recovered when the discount exceeds the distance to the winner; the smallest discount
    among equals wins; a group without revenue is absent. The grid meets groups, not pairs of rows:
    each row is summed into the grid point from which on it counts, and running sums do the rest.
    """
    rows = rows.filter(F.col("gap_to_win").isNotNull() & F.col("num_unidades").isNotNull() & F.col("precio_entidad").isNotNull())
    rows = rows.withColumn("value", product(F.col("num_unidades"), F.col("precio_entidad")))
    grid = F.transform(F.sequence(F.lit(1), F.lit(80)), lambda d: d)
    first = F.get(F.filter(grid, lambda d: d / 100.0 > -F.col("gap_to_win")), F.lit(0))
    steps = rows.withColumn("d", first).filter("d is not null").groupBy(*keys, "d").agg(F.sum("value").alias("v"), F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy("d")
    steps = steps.withColumn("v", F.sum("v").over(w)).withColumn("n", F.sum("n").over(w))
    # Between two steps revenue falls with the discount, so that the best point is one of the steps.
    steps = steps.withColumn("revenue", F.col("v") * (1 - F.col("d") / 100.0)).filter("revenue <> 0")
    best = steps.groupBy(*keys).agg(F.max(F.struct(F.round("revenue", 6).alias("r"), (-F.col("d")).alias("minus"), "n")).alias("b"))
    return best.select(*keys, (-F.col("b.minus") / 100.0).alias("rate"), F.col("b.r").alias("revenue"), F.col("b.n").alias("n_items"))


def optimal_uplift(rows: DataFrame, keys: list[str]) -> DataFrame:
    """For each group: the uplift of 0..80 % with the most revenue from the items that stay below their next rival."""
    rows = rows.filter(F.col("num_unidades").isNotNull() & F.col("precio_entidad").isNotNull())
    rows = rows.withColumn("value", product(F.col("num_unidades"), F.col("precio_entidad")))
    rival = F.col("precio_siguiente_ganador")
    # The points at which the item is kept are the first ones: their number says which.
    kept = F.aggregate(F.sequence(F.lit(0), F.lit(80)), F.lit(0), lambda n, u: n + F.when(rival.isNull() | (F.col("precio_entidad") * (1 + u / 100.0) < rival), 1).otherwise(0))
    steps = rows.withColumn("u", kept - 1).filter("u >= 0").groupBy(*keys, "u").agg(F.sum("value").alias("v"), F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.col("u").desc())
    steps = steps.withColumn("v", F.sum("v").over(w)).withColumn("n", F.sum("n").over(w))
    steps = steps.withColumn("revenue", F.col("v") * (1 + F.col("u") / 100.0)).filter("revenue <> 0")
    best = steps.groupBy(*keys).agg(F.max(F.struct(F.round("revenue", 6).alias("r"), (-F.col("u")).alias("minus"), "n")).alias("b"))
    return best.select(*keys, (-F.col("b.minus") / 100.0).alias("rate"), F.col("b.r").alias("revenue"), F.col("b.n").alias("n_items"))


def price_segments(prices: DataFrame) -> DataFrame:
    """A row for each price segment that has items: volumes, medians, revenues, and the best price move."""
    key = ["diagnostico"]
    rev = product(F.col("entidad_gano"), F.col("num_unidades"), F.col("precio_entidad"))
    lost = F.col("precio_unitario_ganador").isNotNull() & (F.coalesce("entidad_gano", F.lit(0)) == 0)
    out = prices.groupBy(*key).agg(
        F.avg(F.coalesce("n_competidores", F.lit(0))).alias("comp_item"),
        F.count("*").alias("ofertas"),
        F.count_if(lost).alias("adj_comp"),
        F.sum(F.coalesce("entidad_gano", F.lit(0))).alias("adjudicadas"),
        F.median("gap_to_lose").alias("delta_win_med"),
        F.median("gap_to_win").alias("delta_lose_med"),
        F.sum(rival_revenue(F.col("num_unidades"), F.col("entidad_gano"), F.col("precio_unitario_ganador"))).alias("rev_comp"),
        F.sum(rev).alias("rev_actual"),
    )
    s = F.substring("diagnostico", 1, 2)
    up = optimal_uplift(prices.filter(s.isin("W1", "W2", "W3")), key).withColumn("sign", F.lit("+"))
    down = optimal_discount(prices.filter(s.isin("L1", "L2")), key).withColumn("sign", F.lit("−"))
    best = up.unionByName(down).withColumnRenamed("diagnostico", "b")
    out = out.join(best, out.diagnostico == best.b, "left").drop("b")
    moved = F.col("rate").isNotNull() & (F.col("rate") != 0)
    action = F.when(s.isin("W4", "W5"), "No Calculable").when(F.col("rate").isNotNull(), F.concat("sign", F.round(F.col("rate") * 100).cast("int").cast("string"), F.lit("%"))).otherwise("—")
    return (
        out.withColumn("accion", action)
        .withColumn("rev_opt", F.when(moved, F.col("revenue")).otherwise(F.col("rev_actual")))
        .withColumn("adj_adic", F.when(moved, F.col("n_items") - F.col("adjudicadas")).otherwise(0))
        .withColumn("rev_adic", F.col("rev_opt") - F.col("rev_actual"))
        .withColumn("orden", segment_order(F.col("diagnostico")))
        .drop("rate", "revenue", "n_items", "sign")
    )


def weighted_mean(value: Column, weight: Column) -> Column:
    """Null where the weights add up to nothing."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def segment_totals(prices: DataFrame, segments: DataFrame) -> DataFrame:
    """The Total of price_segments(): volumes and revenues added up, mean and medians over all items, and no action."""
    sums = segments.agg(*[F.sum(c).alias(c) for c in ("ofertas", "adj_comp", "adjudicadas", "rev_comp", "rev_actual", "rev_opt", "adj_adic", "rev_adic")])
    means = prices.agg(F.coalesce(F.avg(F.coalesce("n_competidores", F.lit(0))), F.lit(0.0)).alias("comp_item"), F.median("gap_to_lose").alias("delta_win_med"), F.median("gap_to_win").alias("delta_lose_med"))
    return sums.crossJoin(F.broadcast(means)).select(F.lit("Total").alias("diagnostico"), "*", F.lit("—").alias("accion"))  # one row each


def split_totals(universe: DataFrame, entity) -> DataFrame:
    """The Total of split_summary(): its ratio and mean are made anew over all of entity's offers."""
    parts = split_summary(universe, entity)
    sums = parts.agg(*[F.sum(c).alias(c) for c in ("n_productos", "ofertas_entidad", "adjudicaciones", "revenue")])
    mean = _mine(universe, entity).join(item_stats(universe).select("item_key", "n_competidores"), "item_key", "left").agg(F.avg("n_competidores").alias("comp_item"))
    return sums.crossJoin(F.broadcast(mean)).select(F.lit("Total").alias("producto_segmento"), "*", ratio(F.col("adjudicaciones"), F.col("ofertas_entidad")).alias("wr_entidad"))  # one row each


def shown_totals(rows: DataFrame, key: str) -> DataFrame:
    """The Total of the rows that a top list shows; means weigh by offers."""
    return rows.agg(F.coalesce(weighted_mean(F.coalesce("comp_item", F.lit(0.0)), F.col("ofertas")), F.lit(0.0)).alias("comp_item"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("ofertas", "adj_adic")], F.coalesce(F.sum("rev_adic"), F.lit(0.0)).alias("rev_adic")).select(F.lit("Total").alias(key), "*", F.lit("—").alias("accion"))


def competitor_totals(stats: DataFrame) -> DataFrame:
    """The Total of competitor_stats(): counts and revenues added up, rates from the sums."""
    sums = stats.agg(*[F.sum(c).alias(c) for c in ("n_ofertas", "n_adj", "revenue", "entidad_won", "this_won", "other_won", "unawarded")])
    return sums.select(F.lit("Total").alias("nombre_proveedor"), "*", ratio(F.col("n_adj"), F.col("n_ofertas")).alias("wr"), ratio(F.col("revenue"), F.col("n_adj")).alias("avg_ticket"))


def first_rows(base: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a stated order."""
    return base.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def winners(base: DataFrame) -> DataFrame:
    """item_key, rut_ganador and nombre_ganador: the winner with the smallest id."""
    won = base.filter("flag_adjudicado = 1").groupBy("item_key").agg(F.min(F.struct("rut_proveedor", "nombre_proveedor")).alias("w"))
    return won.select("item_key", F.col("w.rut_proveedor").alias("rut_ganador"), F.col("w.nombre_proveedor").alias("nombre_ganador"))


def competitor_stats(universe: DataFrame, entity) -> DataFrame:
    """A row for each supplier met: footprint, revenue, and who won the items it shares with entity."""
    prices = _mine(universe, entity).groupBy("item_key").agg(F.min("precio_unitario").alias("pp"))
    rows = universe.join(winners(universe), "item_key", "left").join(prices, "item_key", "left")
    by_me, by_it = F.col("rut_ganador") == entity, F.col("rut_ganador") == F.col("rut_proveedor")
    third = F.col("rut_ganador").isNotNull() & ~by_me & ~by_it
    at_stake = product(F.col("num_unidades"), F.col("precio_unitario_ganador"))
    relative = F.when((F.col("rut_proveedor") != entity) & (F.coalesce("pp", F.lit(0.0)) > 0), gap(F.col("precio_unitario"), F.col("pp")))
    n_ab = F.count_if(F.col("producto_segmento").isin("A", "B"))
    return rows.groupBy("rut_proveedor", "nombre_proveedor").agg(
        F.count("*").alias("n_ofertas"),
        F.sum(F.coalesce("flag_adjudicado", F.lit(0))).alias("n_adj"),
        ratio(F.sum("flag_adjudicado"), F.count("*")).alias("wr"),
        F.count_distinct("producto").alias("n_productos"),
        F.count_distinct("rut_comprador").alias("n_compradores"),
        F.sum(revenue()).alias("revenue"),
        ratio(F.sum(revenue()), F.sum("flag_adjudicado")).alias("avg_ticket"),
        F.count_if(by_me).alias("entidad_won"),
        F.count_if(by_it).alias("this_won"),
        F.count_if(third).alias("other_won"),
        F.count_if(F.col("rut_ganador").isNull()).alias("unawarded"),
        F.sum(F.when(by_me, at_stake).otherwise(0.0)).alias("rev_entidad_won"),
        F.sum(F.when(by_it, at_stake).otherwise(0.0)).alias("rev_this_won"),
        F.sum(F.when(third, at_stake).otherwise(0.0)).alias("rev_other_won"),
        ratio(F.count_if(by_me), F.count("*")).alias("wr_entidad_h2h"),
        F.median(relative).alias("price_rel_median"),
        ratio(F.count_if(F.col("producto_segmento") == "A"), n_ab).alias("pct_a"),
        ratio(F.count_if(F.col("producto_segmento") == "B"), n_ab).alias("pct_b"),
    )


def head_to_head(stats: DataFrame, entity, top: int = 15) -> DataFrame:
    """The top rivals by revenue: who won the items, and the revenue, of each, in percent."""
    best = stats.filter(F.col("rut_proveedor") != entity).orderBy(F.col("revenue").desc(), "rut_proveedor").limit(top)
    money = F.col("rev_entidad_won") + F.col("rev_this_won") + F.col("rev_other_won")
    share = lambda c: (ratio(F.col(c), F.col("n_ofertas")) * 100).alias("pct_" + c)
    part = lambda c: (ratio(F.col(c), money) * 100).alias("pct_" + c)
    return best.select("rut_proveedor", "nombre_proveedor", *[share(c) for c in ("entidad_won", "this_won", "other_won", "unawarded")], *[part(c) for c in ("rev_entidad_won", "rev_this_won", "rev_other_won")])


def recoverable(prices: DataFrame, base: DataFrame) -> DataFrame:
    """The L1 items with their winner, the discount they need and the revenue it would bring."""
    rows = prices.filter(F.substring("diagnostico", 1, 2) == "L1").join(winners(base), "item_key", "left")
    rows = rows.filter(~F.col("producto").eqNullSafe(UNKNOWN_PRODUCT) & F.col("nombre_comprador").isNotNull())
    return rows.withColumn("descuento_requerido", -F.col("gap_to_win")).withColumn("revenue_recuperable", product(F.col("num_unidades"), F.col("precio_entidad")) * (1 - F.col("descuento_requerido")))


def recoverable_by(l1: DataFrame, keys: list[str], top: int = 15) -> DataFrame:
    """The groups with the most revenue at their best discount."""
    groups = l1.groupBy(*keys).agg(F.avg(F.coalesce("n_competidores", F.lit(0))).alias("comp_item"), F.count("*").alias("ofertas"))
    best = optimal_discount(l1, keys).withColumnsRenamed({k: "b_" + k for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("b_" + k))
    out = groups.join(best, same, "left").select(*keys, "comp_item", "ofertas", F.col("rate").alias("descuento"), F.coalesce("n_items", F.lit(0)).alias("adj_adic"), F.coalesce("revenue", F.lit(0.0)).alias("rev_adic"))
    return out.orderBy(F.col("rev_adic").desc(), *keys).limit(top)


def quick_wins(l1: DataFrame, top: int = 20) -> DataFrame:
    rows = l1.filter("descuento_requerido > 0").withColumn("roi", F.col("revenue_recuperable") / F.col("descuento_requerido"))
    return rows.orderBy(F.col("roi").desc(), "item_key").limit(top)


def split_summary(universe: DataFrame, entity) -> DataFrame:
    """Volumes of the A and the B products."""
    comp = item_stats(universe).select("item_key", "n_competidores")
    mine = _mine(universe, entity).join(comp, "item_key", "left")
    return mine.groupBy("producto_segmento").agg(F.count_distinct(F.coalesce("producto", F.lit("\0"))).alias("n_productos"), F.count("*").alias("ofertas_entidad"), F.sum("flag_adjudicado").alias("adjudicaciones"), ratio(F.sum("flag_adjudicado"), F.count("*")).alias("wr_entidad"), F.avg("n_competidores").alias("comp_item"), F.sum(revenue()).alias("revenue"))


def executive_kpis(universe: DataFrame, entity) -> DataFrame:
    mine = F.col("rut_proveedor") == entity
    rev = F.sum(F.when(mine, revenue()).otherwise(0.0))
    rival = F.sum(F.when(mine, rival_revenue(F.col("num_unidades"), F.col("flag_adjudicado"), F.col("precio_unitario_ganador"))).otherwise(0.0))
    won = F.sum(F.when(mine, F.col("flag_adjudicado")).otherwise(0))
    return universe.agg(
        F.count("*").alias("n_ofertas_totales"),
        F.count_if(mine).alias("n_ofertas_entidad"),
        won.alias("n_adjudicadas"),
        ratio(won, F.count_if(mine)).alias("wr_global"),
        rev.alias("revenue_entidad"),
        ratio(rev, rev + rival).alias("share_entidad"),
        F.count_distinct(F.when(~mine, F.col("rut_proveedor"))).alias("n_competidores"),
        F.count_distinct("rut_comprador").alias("n_compradores"),
    )
