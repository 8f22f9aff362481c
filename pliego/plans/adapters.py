"""The synthetic tables seen as tenders: Spark frames, and the same as DuckDB CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The supplier under study.
ENTITY = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lineitem is an offer; an item is a part in a year."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lines = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey, "left")
    return lines.select(
        (F.col("l_partkey") * 10000 + F.year("l_shipdate")).alias("item_key"),
        F.col("l_partkey").alias("partkey"),
        F.year("l_shipdate").alias("anio"),
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_suppkey").alias("rut_proveedor"),
        F.col("s_name").alias("nombre_proveedor"),
        F.col("l_quantity").alias("unidades"),
        F.try_divide("l_extendedprice", "l_quantity").alias("precio"),
        (F.col("l_returnflag") == "A").alias("adjudicada"),
    )


def items(spark: SparkSession, sf_dir: str, offers: DataFrame) -> DataFrame:
    """Each item's product, year and buyer: the customer of its first order."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("producto"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("nombre_comprador"))
    per = offers.groupBy("item_key", "partkey", "anio").agg(F.min("orderkey").alias("id_licitacion"))
    per = per.join(part, per.partkey == part.p_partkey, "left").join(orders, per.id_licitacion == orders.o_orderkey, "left")
    per = per.join(customer, per.o_custkey == customer.c_custkey, "left")
    return per.select("item_key", "id_licitacion", "anio", "producto", F.col("o_custkey").alias("rut_comprador"), "nombre_comprador")


BASE_CTE = """
offers as (select l_partkey * 10000 + year(l_shipdate) as item_key, l_partkey as partkey, cast(year(l_shipdate) as int) as anio,
    l_orderkey as orderkey, l_suppkey as rut_proveedor, s_name as nombre_proveedor, l_quantity as unidades,
    l_extendedprice / nullif(l_quantity, 0) as precio, l_returnflag = 'A' as adjudicada
    from lineitem left join supplier on l_suppkey = s_suppkey),
wanted as (select distinct item_key from offers where rut_proveedor = 1),
mine_offers as (select * from offers where item_key in (select item_key from wanted)),
cells as (select item_key, rut_proveedor, nombre_proveedor, cast(sum(coalesce(unidades, 0)) as bigint) as num_unidades,
    round(avg(precio), 6) as precio_unitario, max(case when adjudicada then 1 else 0 end) as flag_adjudicado
    from mine_offers group by all),
winning as (select item_key, round(avg(precio), 6) as precio_unitario_ganador from mine_offers where adjudicada group by all),
per_item as (select item_key, partkey, anio, min(orderkey) as id_licitacion from offers group by all),
items as (select item_key, id_licitacion, anio, p_name as producto, o_custkey as rut_comprador, c_name as nombre_comprador
    from per_item left join part on partkey = p_partkey left join orders on id_licitacion = o_orderkey left join customer on o_custkey = c_custkey),
base as (select c.*, w.precio_unitario_ganador, i.id_licitacion, i.anio, i.producto, i.rut_comprador, i.nombre_comprador
    from cells c left join winning w using (item_key) left join items i using (item_key)),
stats as (select item_key, count(distinct rut_proveedor) - 1 as n_competidores, var_samp(precio_unitario) as var_precio from base group by 1),
mine as (select b.*, s.n_competidores, s.var_precio,
    coalesce(flag_adjudicado, 0) * coalesce(num_unidades, 0) * coalesce(precio_unitario, 0) as revenue,
    coalesce(num_unidades, 0) * coalesce(precio_unitario, 0) as ticket,
    precio_unitario_ganador is not null and coalesce(flag_adjudicado, 0) = 0 as lost,
    coalesce(num_unidades, 0) * coalesce(precio_unitario_ganador, 0) as at_stake
    from base b left join stats s using (item_key) where rut_proveedor = 1),
products as (select producto, count(*) as ofertas, sum(flag_adjudicado) as adjudicaciones, sum(revenue) as revenue, avg(flag_adjudicado) as win_rate,
    avg(ticket) as ticket_promedio, avg(n_competidores) as n_competidores_promedio, avg(var_precio) as var_precios_promedio from mine group by 1),
bands as (select *, case when win_rate <= 0.05 then 'Eliminable' when win_rate <= 0.2 then 'Débil' when win_rate <= 0.4 then 'Competitivo' else 'Core' end as segmento from products),
portfolio as (select *, case segmento when 'Core' then 'P1 Segmento Core' when 'Débil' then 'P2 Segmento Débil' when 'Eliminable' then 'P3 Segmento Eliminable' else 'mantener' end as diagnostico from bands),
ranked as (select *, case when precio_unitario is not null then rank() over (partition by item_key, precio_unitario is not null order by precio_unitario) end as precio_rank from base),
rivals as (select item_key, quantile_cont(precio_unitario, 0.25) as p25, quantile_cont(precio_unitario, 0.5) as p50, quantile_cont(precio_unitario, 0.75) as p75,
    min(precio_unitario) as precio_siguiente_ganador, count(distinct rut_proveedor) as n_competidores from base where rut_proveedor <> 1 group by 1),
gaps as (select m.item_key, m.anio, m.producto, m.rut_comprador, m.nombre_comprador, m.precio_unitario as precio_entidad, m.num_unidades, m.flag_adjudicado as entidad_gano,
    m.precio_unitario_ganador, r.p25, r.p50, r.p75, r.precio_siguiente_ganador, r.n_competidores, k.precio_rank,
    (m.precio_unitario - r.p25) / nullif(r.p25, 0) as gap,
    (m.precio_unitario_ganador - m.precio_unitario) / nullif(m.precio_unitario, 0) as gap_to_win,
    (r.precio_siguiente_ganador - m.precio_unitario) / nullif(m.precio_unitario, 0) as gap_to_lose
    from base m left join rivals r using (item_key) left join ranked k on k.item_key = m.item_key and k.rut_proveedor = 1 where m.rut_proveedor = 1),
prices as (select *, case when entidad_gano = 1 then
        case when gap_to_lose is null then 'W5 — Monopoly' when gap_to_lose < 0 then 'W4 — Lock-In' when gap_to_lose <= 0.05 then 'W1 — Aligned' when gap_to_lose <= 0.15 then 'W2 — Improvable' else 'W3 — Comp-Overshot' end
    else case when gap_to_win is null then 'D — Unawarded' when gap_to_win >= 0 then 'L3 — Lock-Out' when gap_to_win >= -0.15 then 'L1 — Recoverable' else 'L2 — Overshot' end end as diagnostico,
    case when n_competidores is null or n_competidores <= 2 then 'Low (≤2)' when n_competidores <= 4 then 'Mid (3-4)' else 'High (≥5)' end as competition_bucket from gaps),
cut as (select coalesce(median(n_competidores_promedio), 0.0) as threshold from products),
split as (select producto, case when n_competidores_promedio is null or n_competidores_promedio < threshold then 'B' else 'A' end as producto_segmento, threshold from products, cut),
universe as (select b.*, s.producto_segmento from base b join split s on b.producto is not distinct from s.producto),
first_winner as (select item_key, min({'r': rut_proveedor, 'n': nombre_proveedor}) as w from base where flag_adjudicado = 1 group by 1),
winners as (select item_key, w.r as rut_ganador, w.n as nombre_ganador from first_winner),
l1 as (select p.*, w.rut_ganador, w.nombre_ganador, -gap_to_win as descuento_requerido,
    coalesce(num_unidades, 0) * coalesce(precio_entidad, 0) * (1 + gap_to_win) as revenue_recuperable
    from prices p left join winners w using (item_key)
    where diagnostico like 'L1%' and producto is distinct from 'producto no identificable - especificación insuficiente' and nombre_comprador is not null)
"""


def best_discount(rows: str, keys: str) -> str:
    """SQL of each group's best discount, by trying all of the grid."""
    return f"""(select {keys}, arg_max(d / 100.0, (r, -d)) as rate, arg_max(n, (r, -d)) as n_items, max(r) as revenue from (
        select {keys}, d, round(sum(case when d / 100.0 > -gap_to_win then num_unidades * precio_entidad * (1 - d / 100.0) else 0 end), 6) as r,
        count(*) filter (where d / 100.0 > -gap_to_win) as n
        from {rows}, (select unnest(range(1, 81)) as d) where gap_to_win is not null and num_unidades is not null and precio_entidad is not null
        group by {keys}, d) group by {keys} having max(r) <> 0)"""


def best_uplift(rows: str, keys: str) -> str:
    kept = "(precio_siguiente_ganador is null or precio_entidad * (1 + u / 100.0) < precio_siguiente_ganador)"
    return f"""(select {keys}, arg_max(u / 100.0, (r, -u)) as rate, arg_max(n, (r, -u)) as n_items, max(r) as revenue from (
        select {keys}, u, round(sum(case when {kept} then num_unidades * precio_entidad * (1 + u / 100.0) else 0 end), 6) as r, count(*) filter (where {kept}) as n
        from {rows}, (select unnest(range(0, 81)) as u) where num_unidades is not null and precio_entidad is not null
        group by {keys}, u) group by {keys} having max(r) <> 0)"""
