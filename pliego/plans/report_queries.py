"""Queries of the pricing report, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.operators import report
from pliego.plans.adapters import BASE_CTE, ENTITY, best_discount, best_uplift, bids, items
from pliego.scratch import saved

#: Where values are cut: an odd fraction of the last digit.
EDGE = 0.5378
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _base(spark, sf_dir) -> DataFrame:
    """The base matrix, made once and written: every table of a report reads it, most of them several times."""
    offers = bids(spark, sf_dir)
    return saved(report.base_matrix(offers, items(spark, sf_dir, offers), ENTITY), "base")


def _prices(base: DataFrame) -> DataFrame:
    return saved(report.price_table(base, ENTITY), "prices")


def _universe(base: DataFrame) -> DataFrame:
    return saved(report.with_split(base, ENTITY), "universe")


def _rounded(df: DataFrame, digits: int = 3) -> DataFrame:
    """Doubles to three decimals, as r3() does in SQL: engines add in different orders, and the
    cut lies where no ratio of short decimals does, so that a last bit never decides."""
    cut = lambda c: F.floor(F.col(c) * 1000 + EDGE) / 1000.0
    return df.select(*[cut(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _sql(select: str, cte: str = BASE_CTE) -> str:
    return f"with {cte}\n{select}"


def query(name: str, sql: str, cte: str = BASE_CTE):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: _rounded(f(spark, sf_dir))
        ORACLES[name] = _sql(sql, cte)
        return f

    return add


def r(*names: str) -> str:
    """Columns cut as _rounded() cuts them."""
    return ", ".join(f"floor(({n}) * 1000 + 0.5378) / 1000 as {n}" for n in names)


@query("base_matrix", f"select item_key, id_licitacion, anio, rut_comprador, nombre_comprador, producto, rut_proveedor, nombre_proveedor, num_unidades, flag_adjudicado, {r('precio_unitario', 'precio_unitario_ganador')} from base")
def base_matrix(spark, sf_dir):
    return _base(spark, sf_dir).select("item_key", "id_licitacion", "anio", "rut_comprador", "nombre_comprador", "producto", "rut_proveedor", "nombre_proveedor", "num_unidades", "flag_adjudicado", "precio_unitario", "precio_unitario_ganador")


@query("product_table", f"select producto, ofertas, cast(adjudicaciones as bigint) as adjudicaciones, {r('revenue', 'win_rate', 'ticket_promedio', 'n_competidores_promedio', 'var_precios_promedio')} from products")
def product_table(spark, sf_dir):
    return report.product_table(_base(spark, sf_dir), ENTITY).drop("segmento", "diagnostico")


@query("portfolio_segments", f"select segmento, diagnostico, count(*) as productos, {r('revenue')} from (select segmento, diagnostico, producto, sum(revenue) over (partition by segmento) as revenue from portfolio) group by segmento, diagnostico, revenue")
def portfolio_segments(spark, sf_dir):
    return report.product_table(_base(spark, sf_dir), ENTITY).groupBy("segmento", "diagnostico").agg(F.count("*").alias("productos"), F.sum("revenue").alias("revenue"))


_PRICE = "item_key, anio, producto, rut_comprador, num_unidades, entidad_gano, n_competidores, precio_rank, diagnostico, competition_bucket"


@query("price_table", f"select {_PRICE}, {r('precio_entidad', 'precio_unitario_ganador', 'p25', 'p50', 'p75', 'precio_siguiente_ganador', 'gap', 'gap_to_win', 'gap_to_lose')} from prices")
def price_table(spark, sf_dir):
    return report.price_table(_base(spark, sf_dir), ENTITY).drop("nombre_comprador")


@query("price_rank", f"select item_key, rut_proveedor, precio_rank, {r('precio_unitario')} from ranked")
def price_rank(spark, sf_dir):
    return report.price_ranks(_base(spark, sf_dir)).select("item_key", "rut_proveedor", "precio_unitario", "precio_rank")


@query("price_diagnosis", "select diagnostico, entidad_gano, count(*) as items from prices group by all")
def price_diagnosis(spark, sf_dir):
    return report.price_table(_base(spark, sf_dir), ENTITY).groupBy("diagnostico", "entidad_gano").agg(F.count("*").alias("items"))


@query("competition_bucket", "select competition_bucket, count(*) as items, cast(sum(entidad_gano) as bigint) as won from prices group by 1")
def competition(spark, sf_dir):
    return report.price_table(_base(spark, sf_dir), ENTITY).groupBy("competition_bucket").agg(F.count("*").alias("items"), F.sum("entidad_gano").alias("won"))


@query(
    "price_segment_summary",
    f"""select diagnostico, ofertas, adj_comp, adjudicadas, {r('comp_item', 'delta_win_med', 'delta_lose_med', 'rev_comp', 'rev_actual', 'rev_opt')}, floor((rev_opt - rev_actual) * 1000 + 0.5378) / 1000 as rev_adic, accion, adj_adic,
    cast(list_position(['W1', 'W2', 'W3', 'W4', 'W5', 'L1', 'L2', 'L3', 'D '], diagnostico[1:2]) as bigint) as orden from (
    select s.*, case when s.diagnostico[1:2] in ('W4', 'W5') then 'No Calculable' when rate is null then '—'
        else (case when s.diagnostico[1:1] = 'W' then '+' else '−' end) || cast(cast(round(rate * 100) as int) as varchar) || '%' end as accion,
        case when rate is not null and rate <> 0 then revenue else rev_actual end as rev_opt,
        cast(case when rate is not null and rate <> 0 then n_items - adjudicadas else 0 end as bigint) as adj_adic
    from (select diagnostico, avg(coalesce(n_competidores, 0)) as comp_item, count(*) as ofertas,
        count(*) filter (where precio_unitario_ganador is not null and entidad_gano = 0) as adj_comp, cast(sum(entidad_gano) as bigint) as adjudicadas,
        median(gap_to_lose) as delta_win_med, median(gap_to_win) as delta_lose_med,
        coalesce(sum(num_unidades * precio_unitario_ganador) filter (where precio_unitario_ganador is not null and entidad_gano = 0), 0) as rev_comp,
        sum(entidad_gano * coalesce(num_unidades, 0) * coalesce(precio_entidad, 0)) as rev_actual from prices group by 1) s
    left join (select * from {best_uplift("(select * from prices where diagnostico[1:2] in ('W1', 'W2', 'W3'))", 'diagnostico')}
        union all select * from {best_discount("(select * from prices where diagnostico[1:2] in ('L1', 'L2'))", 'diagnostico')}) b using (diagnostico))""",
)
def price_segment_summary(spark, sf_dir):
    return report.price_segments(_prices(_base(spark, sf_dir)))


_ANNUAL = "avg(coalesce(n_competidores, 0)) as comp_item, count(*) as ofertas, count(*) filter (where lost) as adj_comp, cast(coalesce(sum(flag_adjudicado), 0) as bigint) as adjudicadas, coalesce(sum(at_stake) filter (where lost), 0) as rev_comp, sum(revenue) as rev_entidad"


@query(
    "annual_summary",
    f"""select anio, ofertas, adj_comp, adjudicadas, {r('comp_item', 'rev_comp', 'rev_entidad')}, floor((adjudicadas / ofertas) * 1000 + 0.5378) / 1000 as wr_entidad,
    floor((coalesce(rev_entidad / nullif(rev_entidad + rev_comp, 0), 0)) * 1000 + 0.5378) / 1000 as share_entidad from (
    select coalesce(cast(anio as varchar), '(s/a)') as anio, {_ANNUAL} from mine group by 1 union all select 'Total', {_ANNUAL} from mine)""",
)
def annual_summary(spark, sf_dir):
    return report.annual_summary(_universe(_base(spark, sf_dir)), ENTITY)


@query("ab_split", f"select producto, producto_segmento, {r('threshold')} from split")
def ab_split(spark, sf_dir):
    return report.product_split(report.product_table(_base(spark, sf_dir), ENTITY))


@query(
    "ab_summary",
    f"""select producto_segmento, count(distinct coalesce(m.producto, '')) as n_productos, count(*) as ofertas_entidad, cast(sum(flag_adjudicado) as bigint) as adjudicaciones,
    floor((avg(flag_adjudicado)) * 1000 + 0.5378) / 1000 as wr_entidad, floor((avg(n_competidores)) * 1000 + 0.5378) / 1000 as comp_item, floor((sum(revenue)) * 1000 + 0.5378) / 1000 as revenue
    from mine m join split s on m.producto is not distinct from s.producto group by 1""",
)
def ab_summary(spark, sf_dir):
    return report.split_summary(_universe(_base(spark, sf_dir)), ENTITY)


_FOOTPRINT = """select rut_proveedor, nombre_proveedor, count(*) as n_ofertas, cast(sum(flag_adjudicado) as bigint) as n_adj, avg(flag_adjudicado) as wr,
    count(distinct producto) as n_productos, count(distinct rut_comprador) as n_compradores,
    sum(flag_adjudicado * coalesce(num_unidades, 0) * coalesce(precio_unitario, 0)) as revenue,
    coalesce(sum(flag_adjudicado * coalesce(num_unidades, 0) * coalesce(precio_unitario, 0)) / nullif(sum(flag_adjudicado), 0), 0) as avg_ticket,
    count(*) filter (where rut_ganador = 1) as entidad_won, count(*) filter (where rut_ganador = rut_proveedor) as this_won,
    count(*) filter (where rut_ganador <> 1 and rut_ganador <> rut_proveedor) as other_won, count(*) filter (where rut_ganador is null) as unawarded,
    coalesce(sum(stake) filter (where rut_ganador = 1), 0) as rev_entidad_won, coalesce(sum(stake) filter (where rut_ganador = rut_proveedor), 0) as rev_this_won,
    coalesce(sum(stake) filter (where rut_ganador <> 1 and rut_ganador <> rut_proveedor), 0) as rev_other_won,
    count(*) filter (where rut_ganador = 1) / count(*) as wr_entidad_h2h,
    median(case when rut_proveedor <> 1 and pp > 0 then (precio_unitario - pp) / pp end) as price_rel_median,
    count(*) filter (where producto_segmento = 'A') / count(*) as pct_a, count(*) filter (where producto_segmento = 'B') / count(*) as pct_b
    from (select u.*, w.rut_ganador, p.pp, coalesce(num_unidades, 0) * coalesce(precio_unitario_ganador, 0) as stake from universe u left join winners w using (item_key)
        left join (select item_key, min(precio_unitario) as pp from base where rut_proveedor = 1 group by 1) p using (item_key)) group by 1, 2"""


@query(
    "competitor_stats",
    f"select rut_proveedor, nombre_proveedor, n_ofertas, n_adj, n_productos, n_compradores, entidad_won, this_won, other_won, unawarded, {r('wr', 'revenue', 'avg_ticket', 'rev_entidad_won', 'rev_this_won', 'rev_other_won', 'wr_entidad_h2h', 'price_rel_median', 'pct_a', 'pct_b')} from ({_FOOTPRINT})",
)
def competitor_stats(spark, sf_dir):
    return report.competitor_stats(_universe(_base(spark, sf_dir)), ENTITY)


@query(
    "head_to_head",
    f"""select rut_proveedor, nombre_proveedor, {', '.join(f'floor((100 * {c} / n_ofertas) * 1000 + 0.5378) / 1000 as pct_{c}' for c in ('entidad_won', 'this_won', 'other_won', 'unawarded'))},
    {', '.join(f'floor((coalesce(100 * {c} / nullif(rev_entidad_won + rev_this_won + rev_other_won, 0), 0)) * 1000 + 0.5378) / 1000 as pct_{c}' for c in ('rev_entidad_won', 'rev_this_won', 'rev_other_won'))}
    from ({_FOOTPRINT}) where rut_proveedor <> 1 order by revenue desc, rut_proveedor limit 15""",
)
def head_to_head(spark, sf_dir):
    return report.head_to_head(report.competitor_stats(_universe(_base(spark, sf_dir)), ENTITY), ENTITY)


def _l1(spark, sf_dir):
    base = _base(spark, sf_dir)
    return saved(report.recoverable(report.price_table(base, ENTITY), base), "l1")


def _by(keys: str) -> str:
    first = keys.split(",")[0].strip()
    same = " and ".join(f"g.{k.strip()} is not distinct from b.{k.strip()}" for k in keys.split(","))
    return f"""select {', '.join('g.' + k.strip() for k in keys.split(','))}, floor((comp_item) * 1000 + 0.5378) / 1000 as comp_item, ofertas, floor((rate) * 1000 + 0.5378) / 1000 as descuento, coalesce(n_items, 0) as adj_adic, floor((coalesce(revenue, 0)) * 1000 + 0.5378) / 1000 as rev_adic
    from (select {keys}, avg(coalesce(n_competidores, 0)) as comp_item, count(*) as ofertas from l1 where {first} is not null or {first} is null group by {keys}) g
    left join {best_discount('l1', keys)} b on {same} order by coalesce(revenue, 0) desc, {', '.join('g.' + k.strip() + ' nulls first' for k in keys.split(','))} limit 15"""


@query("l1_by_product", _by("producto"))
def l1_by_product(spark, sf_dir):
    return report.recoverable_by(_l1(spark, sf_dir), ["producto"])


@query("l1_by_buyer", _by("rut_comprador, nombre_comprador"))
def l1_by_buyer(spark, sf_dir):
    return report.recoverable_by(_l1(spark, sf_dir), ["rut_comprador", "nombre_comprador"])


@query("l1_by_winner", _by("rut_ganador, nombre_ganador"))
def l1_by_winner(spark, sf_dir):
    return report.recoverable_by(_l1(spark, sf_dir).filter("rut_ganador is not null"), ["rut_ganador", "nombre_ganador"])


@query("quick_wins", "select item_key, producto, nombre_comprador, nombre_ganador, num_unidades, floor((descuento_requerido) * 1000 + 0.5378) / 1000 as descuento_requerido, floor((revenue_recuperable) * 1000 + 0.5378) / 1000 as revenue_recuperable from l1 where descuento_requerido > 0 order by revenue_recuperable / descuento_requerido desc, item_key limit 20")
def quick_wins(spark, sf_dir):
    return report.quick_wins(_l1(spark, sf_dir)).select("item_key", "producto", "nombre_comprador", "nombre_ganador", "num_unidades", "descuento_requerido", "revenue_recuperable")


@query("optimal_discount", f"select diagnostico, floor((rate) * 1000 + 0.5378) / 1000 as rate, n_items, floor((revenue) * 1000 + 0.5378) / 1000 as revenue from {best_discount('prices', 'diagnostico')} where diagnostico like 'L%'")
def optimal_discount(spark, sf_dir):
    prices = report.price_table(_base(spark, sf_dir), ENTITY).filter("diagnostico like 'L%'")
    return report.optimal_discount(prices, ["diagnostico"])


@query("optimal_uplift", f"select diagnostico, floor((rate) * 1000 + 0.5378) / 1000 as rate, n_items, floor((revenue) * 1000 + 0.5378) / 1000 as revenue from {best_uplift('prices', 'diagnostico')} where diagnostico like 'W%'")
def optimal_uplift(spark, sf_dir):
    prices = report.price_table(_base(spark, sf_dir), ENTITY).filter("diagnostico like 'W%'")
    return report.optimal_uplift(prices, ["diagnostico"])


@query(
    "executive_kpis",
    """select count(*) as n_ofertas_totales, count(*) filter (where rut_proveedor = 1) as n_ofertas_entidad, cast(sum(flag_adjudicado) filter (where rut_proveedor = 1) as bigint) as n_adjudicadas,
    floor((avg(flag_adjudicado) filter (where rut_proveedor = 1)) * 1000 + 0.5378) / 1000 as wr_global, floor(((select sum(revenue) from mine)) * 1000 + 0.5378) / 1000 as revenue_entidad,
    floor(((select sum(revenue) / (sum(revenue) + sum(at_stake) filter (where lost)) from mine)) * 1000 + 0.5378) / 1000 as share_entidad,
    count(distinct rut_proveedor) filter (where rut_proveedor <> 1) as n_competidores, count(distinct rut_comprador) as n_compradores from universe""",
)
def executive_kpis(spark, sf_dir):
    return report.executive_kpis(_universe(_base(spark, sf_dir)), ENTITY)


@query("first_per_key", f"select item_key, rut_proveedor, {r('precio_unitario')} from base qualify row_number() over (partition by item_key order by item_key, rut_proveedor) = 1")
def first_per_key(spark, sf_dir):
    return report.first_rows(_base(spark, sf_dir), ["item_key"], ["item_key", "rut_proveedor"]).select("item_key", "rut_proveedor", "precio_unitario")


@query("union_segments", f"select producto_segmento, producto, {r('win_rate')} from products join split using (producto) where producto_segmento = 'A' union all select producto_segmento, producto, floor((win_rate) * 1000 + 0.5378) / 1000 as win_rate from products join split using (producto) where producto_segmento = 'B'")
def union_segments(spark, sf_dir):
    products = report.product_table(_base(spark, sf_dir), ENTITY)
    both = products.join(report.product_split(products).withColumnRenamed("producto", "p"), F.col("producto").eqNullSafe(F.col("p"))).select("producto_segmento", "producto", "win_rate")
    return both.filter("producto_segmento = 'A'").unionByName(both.filter("producto_segmento = 'B'"))
