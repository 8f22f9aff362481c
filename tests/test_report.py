"""The HTML page of the pricing report, its number formats, its command, and the indicators' files."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from pliego import cli, html_report
from pliego.functions import text
from pliego.operators import report
from pliego.sources import rates

BIDS = [
    (1, 1, "ACME <SA>", 10, 100.0, True), (1, 2, "rival", 10, 110.0, False),
    (2, 1, "ACME <SA>", 5, 100.0, False), (2, 2, "rival", 5, 95.0, True), (2, 3, "tercero", 5, 120.0, False),
    (3, 1, "ACME <SA>", 2, 50.0, False), (3, 3, "tercero", 2, None, False),
    (9, 2, "rival", 1, 1.0, True),
]
ITEMS = [(1, 2024, "guante & gasa", 7, "Hospital"), (2, 2024, "sonda", 8, "Clínica"), (3, None, None, 8, "Clínica"), (9, 2024, "sonda", 8, "Clínica")]


def tables(spark):
    bids = spark.createDataFrame(BIDS, "item_key long, rut_proveedor long, nombre_proveedor string, unidades long, precio double, adjudicada boolean")
    return bids, spark.createDataFrame(ITEMS, "item_key long, anio int, producto string, rut_comprador long, nombre_comprador string")


def test_number_formats(spark):
    df = spark.createDataFrame([(1234567.0,), (-1234567.0,), (0.0,), (None,)], "v double")
    got = df.select(text.money(F.col("v")), text.millions(F.col("v")), text.percent(F.col("v") / 1e5), text.signed(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [("$ 1.234.567", "MM$ 1,2", "1234.6%", "+1,234,567"), ("-$ 1.234.567", "-MM$ 1,2", "-1234.6%", "−1,234,567"), ("$ 0", "MM$ 0,0", "0.0%", "0"), (None,) * 4]


def test_the_page(spark, tmp_path):
    base = report.base_matrix(*tables(spark), 1)
    page = html_report.write(base, 1, tmp_path / "out")
    assert page.name == "diagnostico_acme_sa.html"
    html = page.read_text("utf-8")
    assert "<h1>Acme &lt;sa&gt;</h1>" in html and "<SA>" not in html and "<td>ACME &lt;SA&gt;</td>" in html
    assert not re.search(r"<script|https?:", html)
    kpi = dict(re.findall(r'class="kpi">([^<]+)<b>([^<]+)</b>', html))
    assert kpi["Ofertas"] == "3" and kpi["Adjudicaciones"] == "1" and kpi["Tasa de adjudicación"] == "33.3%" and kpi["Competidores"] == "2"
    assert kpi["Ingresos"] == "MM$ 0,0" and kpi["Participación"] == "67.8%"  # 1000 of 1000 + 475
    years = html[html.index("Por año") : html.index("1. Competencia")]
    assert re.findall(r"<tr(?: class=\"total\")?><td>([^<]+)", years) == ["(s/a)", "2024", "Total"]
    quick = html[html.index("4. Ganancias") :]
    assert "<td>sonda</td><td>Clínica</td><td>rival</td>" in quick and "5.0%" in quick and "$ 100" in quick
    # Every table has as many cells in each row as heads, and tags are balanced.
    for t in re.findall(r"<table>(<tr><th.*?)</table>", html):
        widths = {len(re.findall(r"<t[hd]", r)) for r in t.split("</tr>") if r}
        assert len(widths) == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/matriz_base.csv").count() == 7
    assert html_report.write(base, 77, tmp_path / "none") is None and not (tmp_path / "none").exists()


def test_a_supplier_that_loses_nothing_and_has_no_name(spark, tmp_path):
    bids = spark.createDataFrame([(1, 5, None, 1, 10.0, True)], "item_key long, rut_proveedor long, nombre_proveedor string, unidades long, precio double, adjudicada boolean")
    page = html_report.write(report.base_matrix(bids, tables(spark)[1], 5), 5, tmp_path)
    html = page.read_text("utf-8")
    assert page.name == "diagnostico_rut_5.html" and html.count("(sin datos)") == 6


def test_the_report_command(spark, tmp_path, capsys):
    for name, df in zip(("bid", "bid_item"), tables(spark), strict=True):
        df.write.parquet(f"{tmp_path}/{name}")
    assert cli.main(["report", "--data", str(tmp_path), "--rut", "2", "--name", "El Rival", "--out", f"{tmp_path}/r"], spark) == 0
    assert "diagnostico_el_rival.html" in capsys.readouterr().out and (tmp_path / "r" / "diagnostico_el_rival.html").exists()
    assert cli.main(["report", "--data", str(tmp_path), "--rut", "44", "--out", f"{tmp_path}/s"], spark) == 0
    assert "no rows of 44" in capsys.readouterr().out


def test_indicators_are_fetched_once(spark, tmp_path):
    asked = []

    def fetch(name, year):
        asked.append((name, year))
        return {f"{year}-01-02T03:00:00.000Z": 30000.5} if year < 2030 else {}

    for _ in range(2):
        got = rates.rates(spark, [("uf", 2024), ("uf", 2025)], tmp_path / "ref", fetch).collect()
        assert sorted((r.indicator, r.d, r.value) for r in got) == [("uf", datetime.date(y, 1, 2), 30000.5) for y in (2024, 2025)]
    assert asked == [("uf", 2024), ("uf", 2025)]
    rates.year_of("uf", 2024, tmp_path / "ref", fetch, force=True)
    assert len(asked) == 3
    for wrong, error in ((("oro", 2024), ValueError), (("uf", 2031), ValueError)):
        with pytest.raises(error):
            rates.year_of(*wrong, tmp_path / "ref", fetch)
    with pytest.raises(FileNotFoundError):
        rates.year_of("ipc", 2024, tmp_path / "ref")
