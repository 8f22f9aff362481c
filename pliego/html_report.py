"""The competitive-pricing report as one HTML page, and the base matrix beside it.

Every number of the page is made and formatted by Spark; the driver takes the rows that a table shows (a row a year, a
segment or a category, and top lists), never the matrix. The page holds all it needs: no script, no font, no address.
"""

from __future__ import annotations

from collections.abc import Callable
from html import escape
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.functions import text
from pliego.operators import report
from pliego.scratch import saved
from pliego.sources import writers

#: Suppliers in the footprint table, beside the entity.
TOP = 15
STYLE = """body{font:15px sans-serif;margin:2em auto;max-width:70em;color:#222}h2{margin-top:2em}table{border-collapse:collapse;width:100%}
th,td{padding:.3em .7em;border-bottom:1px solid #ddd;text-align:left}.n{text-align:right}.total{font-weight:bold}
.kpi{display:inline-block;margin-right:2.5em}.kpi b{display:block;font-size:1.5em}.bar{display:flex;height:1.2em}.bar i{display:block}"""
#: Colours and captions of who won: the entity, the rival, a third one, nobody.
PARTS = (("entidad_won", "#2b6cb0"), ("this_won", "#c05621"), ("other_won", "#a0aec0"), ("unawarded", "#edf2f7"))


class Shown(NamedTuple):
    column: str
    title: str
    form: Callable[[Column], Column] | None = None


def whole(c: Column) -> Column:
    return F.format_number(c.cast("long"), 0)


def decimal(c: Column) -> Column:
    return F.format_number(c, 1)


def cells(rows: DataFrame, shown: list[Shown]) -> list[list[str]]:
    """The formatted cells of rows, in their order; what is null, or a column that rows lack, is a dash."""
    pick = [(s.form or (lambda c: c.cast("string")))(F.col(s.column)) if s.column in rows.columns else F.lit(None) for s in shown]
    return [list(r) for r in rows.select(*[F.coalesce(c.cast("string"), F.lit("-")) for c in pick]).toLocalIterator()]


def table(rows: DataFrame, shown: list[Shown], totals: DataFrame | None = None) -> str:
    """An HTML table of rows, which are few, and of the one row of totals."""
    body = cells(rows, shown)
    if not body:
        return "<p><i>(sin datos)</i></p>"
    place = [' class="n"' if s.form else "" for s in shown]
    line = lambda values, tag: "".join(f"<{tag}{p}>{escape(v)}</{tag}>" for p, v in zip(place, values, strict=True))
    out = [f"<tr>{line([s.title for s in shown], 'th')}</tr>"] + [f"<tr>{line(r, 'td')}</tr>" for r in body]
    out += [f'<tr class="total">{line(r, "td")}</tr>' for r in (cells(totals, shown) if totals is not None else ())]
    return f"<table>{''.join(out)}</table>"


def bars(rows: DataFrame, prefix: str, names: dict[str, str]) -> str:
    """A bar of percentages for each row: who won."""
    parts = [(c, colour) for c, colour in PARTS if prefix + c in rows.columns]
    legend = " ".join(f'<span style="border-left:1em solid {colour}"> {escape(names[c])}</span>' for c, colour in parts)
    out = []
    for r in rows.toLocalIterator():
        label = ", ".join(f"{names[c]} {r[prefix + c]:.1f}%" for c, _ in parts)
        inside = "".join(f'<i style="width:{r[prefix + c]:.2f}%;background:{colour}"></i>' for c, colour in parts)
        out.append(f'<tr><td>{escape(str(r.nombre_proveedor))}</td><td style="width:65%" title="{escape(label, quote=True)}"><div class="bar">{inside}</div></td></tr>')
    return f"<p>{legend}</p><table>{''.join(out)}</table>" if out else "<p><i>(sin datos)</i></p>"


def display_name(base: DataFrame, entity) -> str:
    """The entity's name in title case, or its id where the matrix has none."""
    found = base.filter(F.col("rut_proveedor") == entity).agg(F.min(F.trim("nombre_proveedor")).alias("n")).select(F.initcap("n")).first()[0]
    return found or f"RUT {entity}"


def render(base: DataFrame, entity, name: str) -> str:
    """The page: indicators, years, competition, price segments, what is recoverable, quick wins."""
    universe = saved(report.with_split(base, entity), "universe")
    prices = saved(report.price_table(universe, entity), "prices")
    segments = saved(report.price_segments(prices), "segments")
    split = saved(report.split_summary(universe, entity), "split")
    stats = saved(report.competitor_stats(universe, entity), "competitors")
    lost = saved(report.recoverable(prices, universe), "l1")
    kpis = [
        Shown("n_ofertas_entidad", "Ofertas", whole), Shown("n_adjudicadas", "Adjudicaciones", whole), Shown("wr_global", "Tasa de adjudicación", text.percent),
        Shown("revenue_entidad", "Ingresos", text.millions), Shown("share_entidad", "Participación", text.percent), Shown("n_competidores", "Competidores", whole), Shown("n_compradores", "Compradores", whole),
    ]
    values = cells(report.executive_kpis(universe, entity), kpis)[0]
    out = ["".join(f'<span class="kpi">{escape(k.title)}<b>{escape(v)}</b></span>' for k, v in zip(kpis, values, strict=True))]

    volume = [Shown("comp_item", "Competidores por ítem", decimal), Shown("ofertas", "Ofertas", whole)]
    years = report.annual_summary(universe, entity)
    shown = [Shown("anio", "Año"), *volume, Shown("adj_comp", "Ganadas por otros", whole), Shown("adjudicadas", "Adjudicadas", whole), Shown("wr_entidad", "Tasa", text.percent), Shown("rev_comp", "Ingresos de otros", text.millions), Shown("rev_entidad", "Ingresos", text.millions), Shown("share_entidad", "Participación", text.percent)]
    out += ["<h2>Por año</h2>", table(years.filter("anio <> 'Total'").orderBy("anio"), shown, years.filter("anio = 'Total'"))]

    out.append("<h2>1. Competencia</h2><h3>1.1 Productos de alta (A) y baja (B) competencia</h3>")
    shown = [Shown("producto_segmento", "Categoría"), Shown("n_productos", "Productos", whole), Shown("comp_item", "Competidores por ítem", decimal), Shown("ofertas_entidad", "Ofertas", whole), Shown("adjudicaciones", "Adjudicadas", whole), Shown("wr_entidad", "Tasa", text.percent), Shown("revenue", "Ingresos", text.millions)]
    out.append(table(split.orderBy("producto_segmento"), shown, report.split_totals(universe, entity)))
    out.append("<h3>1.2 Proveedores</h3>")
    mine = F.col("rut_proveedor") == entity
    rivals = stats.filter(~mine).orderBy(F.col("revenue").desc(), "rut_proveedor").limit(TOP)
    footprint = stats.filter(mine).withColumn("wr_entidad_h2h", F.lit(None).cast("double")).unionByName(rivals).orderBy((~mine).cast("int"), F.col("revenue").desc(), "rut_proveedor")
    shown = [Shown("nombre_proveedor", "Proveedor"), Shown("n_ofertas", "Ofertas", whole), Shown("n_adj", "Adjudicadas", whole), Shown("wr", "Tasa", text.percent), Shown("wr_entidad_h2h", f"Tasa de {name} frente a él", text.percent), Shown("n_compradores", "Compradores", whole), Shown("revenue", "Ingresos", text.millions)]
    out.append(table(footprint, shown))
    names = {"entidad_won": name, "this_won": "el competidor", "other_won": "otro", "unawarded": "sin adjudicar"}
    duel = saved(report.head_to_head(stats, entity, TOP), "duel")
    out += ["<h3>1.3 Quién gana los ítems comunes</h3>", bars(duel, "pct_", names), "<h3>1.4 Quién gana sus ingresos</h3>", bars(duel, "pct_rev_", names)]

    shown = [Shown("diagnostico", "Segmento"), *volume, Shown("adj_comp", "Ganadas por otros", whole), Shown("adjudicadas", "Adjudicadas", whole), Shown("delta_win_med", "Brecha al siguiente", text.percent), Shown("delta_lose_med", "Brecha al ganador", text.percent), Shown("rev_comp", "Ingresos de otros", text.millions), Shown("rev_actual", "Ingresos", text.millions), Shown("accion", "Ajuste"), Shown("adj_adic", "Adjudicaciones adicionales", text.signed), Shown("rev_adic", "Ingresos adicionales", text.millions)]
    out += ["<h2>2. Posición de precio</h2>", table(segments.orderBy("orden"), shown, report.segment_totals(prices, segments))]

    out.append("<h2>3. Recuperable (L1)</h2>")
    rest = [*volume, Shown("accion", "Descuento"), Shown("adj_adic", "Adjudicaciones adicionales", text.signed), Shown("rev_adic", "Ingresos adicionales", text.millions)]
    lists = (("3.1 Productos", ["producto"], "Producto", lost), ("3.2 Compradores", ["nombre_comprador", "rut_comprador"], "Comprador", lost), ("3.3 Ganadores", ["nombre_ganador", "rut_ganador"], "Ganador", lost.filter("rut_ganador is not null")))
    for title, keys, head, rows in lists:
        best = saved(report.recoverable_by(rows, keys), "best")
        action = F.when(F.col("descuento").isNotNull(), F.concat(F.lit("−"), F.format_string("%.0f%%", F.col("descuento") * 100))).otherwise("—")
        out += [f"<h3>{title}</h3>", table(best.withColumn("accion", action).orderBy(F.col("rev_adic").desc(), *keys), [Shown(keys[0], head), *rest], report.shown_totals(best, keys[0]))]

    quick = saved(report.quick_wins(lost), "quick")
    total = quick.agg(F.sum("revenue_recuperable").alias("revenue_recuperable")).withColumn("producto", F.lit("Total"))
    shown = [Shown("producto", "Producto"), Shown("nombre_comprador", "Comprador"), Shown("nombre_ganador", "Ganador"), Shown("num_unidades", "Unidades", whole), Shown("precio_entidad", "Precio", text.money), Shown("precio_unitario_ganador", "Precio ganador", text.money), Shown("descuento_requerido", "Descuento", text.percent), Shown("revenue_recuperable", "Recuperable", text.millions)]
    out += ["<h2>4. Ganancias rápidas</h2>", table(quick.orderBy(F.col("roi").desc(), "item_key"), shown, total)]

    made = base.sparkSession.range(1).select(text.stamp()).first()[0]
    head = f'<!DOCTYPE html><html lang="es"><head><meta charset="utf-8"><title>{escape(name)}</title><style>{STYLE}</style></head>'
    return f"{head}<body><h1>{escape(name)}</h1><p>RUT {escape(str(entity))}, {made}</p>{''.join(out)}</body></html>\n"


def write(base: DataFrame, entity, folder: str | Path, name: str | None = None) -> Path | None:
    """matriz_base.csv (a folder, in as many files as base has partitions) and diagnostico_<slug>.html in folder; None without rows of entity."""
    spark = base.sparkSession
    base = saved(base, "base")
    if base.filter(F.col("rut_proveedor") == entity).isEmpty():
        return None
    name = name or display_name(base, entity)
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    writers.delimited(base, str(folder / "matriz_base.csv"), ",")
    slug = spark.range(1).select(text.slug(F.lit(name))).first()[0]
    page = folder / f"diagnostico_{slug}.html"
    page.write_text(render(base, entity, name), "utf-8")
    return page
