import datetime
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vinilo.operators.sales import (
    sales_by_month,
    sales_by_quarter,
    sales_by_weekday,
    sales_per_day,
    weekend_comparison,
)
from vinilo.plans import reports

INVOICE = "InvoiceId int, InvoiceDate string, CustomerId int"
LINE = "InvoiceId int, TrackId int, UnitPrice double, Quantity int"
LINES = [(7, 41, 2.5, 2), (7, 42, 1.25, 4), (8, 41, 2.0, 1), (9, 43, 0.5, 6), (9, 44, 3.0, 1)]


def frames(spark, invoices, lines=LINES):
    return spark.createDataFrame(invoices, INVOICE), spark.createDataFrame(lines, LINE)


@pytest.fixture
def two_days(spark):
    return frames(spark, [(7, "2023-05-12", 3), (8, "2023-05-12", 4), (9, "2023-05-13", 3)])


def test_sales_per_day(two_days, rows):
    result = rows(sales_per_day(*two_days, round_to=2), "fecha")
    first = result[datetime.date(2023, 5, 12)]
    assert first["total_canciones_vendidas"] == 3
    assert first["cantidad_total"] == 7
    assert first["numero_facturas"] == 2
    assert first["clientes_unicos"] == 2
    assert first["monto_total"] == 12.0
    assert first["avg_canciones_por_factura"] == 1.5
    assert first["ticket_promedio"] == 6.0
    assert (first["dia_semana"], first["mes"], first["año"], first["trimestre"]) == (
        "Friday",
        5,
        2023,
        2,
    )
    second = result[datetime.date(2023, 5, 13)]
    assert (second["total_canciones_vendidas"], second["cantidad_total"]) == (2, 7)
    assert second["monto_total"] == 6.0


def test_columns_of_sales_per_day(two_days):
    assert sales_per_day(*two_days).columns == [
        "fecha",
        "total_canciones_vendidas",
        "cantidad_total",
        "numero_facturas",
        "clientes_unicos",
        "monto_total",
        "dia_semana",
        "mes",
        "año",
        "trimestre",
        "avg_canciones_por_factura",
        "ticket_promedio",
    ]


def test_unreadable_dates_drop_out(spark, two_days, rows):
    invoice, line = two_days
    broken = spark.createDataFrame([(4, "nope", 12), (5, None, 12)], INVOICE)
    more = spark.createDataFrame([(4, 1, 1.0, 1), (5, 1, 1.0, 1)], LINE)
    result = sales_per_day(invoice.union(broken), line.union(more))
    assert rows(result, "fecha") == rows(sales_per_day(*two_days), "fecha")


def test_sales_by_weekday(spark, rows):
    invoice, line = frames(
        spark,
        [(7, "2023-05-08", 1), (8, "2023-05-15", 2), (9, "2023-05-10", 1)],
        [*LINES, (9, 45, 1.5, 2)],
    )
    result = rows(sales_by_weekday(invoice, line, round_to=2), "dia_semana")
    assert {d: r["ticket_promedio"] for d, r in result.items()} == {
        "Monday": 6.0,
        "Wednesday": 9.0,
    }
    assert result["Monday"]["avg_canciones_por_factura"] == 1.5


def test_sales_by_month(spark, rows):
    invoice, line = frames(
        spark, [(7, "2023-03-31", 1), (8, "2023-04-01", 2), (9, "2023-04-30", 1)]
    )
    result = rows(sales_by_month(invoice, line, round_to=2), "year_month")
    assert result["2023-03"]["ticket_promedio"] == 10.0
    assert result["2023-04"]["cantidad_total"] == 8
    assert result["2023-04"]["ticket_promedio"] == 4.0


def test_one_line_month(spark, rows):
    invoice, line = frames(spark, [(5, "2022-12-31", 1)], [(5, 9, 0.75, 4)])
    (only,) = rows(sales_by_month(invoice, line), "year_month").values()
    assert only["total_canciones_vendidas"] == 1
    assert only["cantidad_total"] == 4
    assert only["monto_total"] == 3.0


@pytest.mark.parametrize(
    "compute", [sales_per_day, sales_by_weekday, sales_by_month, weekend_comparison]
)
def test_empty_input_keeps_the_schema(spark, two_days, compute):
    invoice, line = two_days
    expected = compute(invoice, line).schema
    for empty in (
        compute(invoice.limit(0), line),
        compute(invoice, line.limit(0)),
    ):
        assert empty.schema == expected
        assert empty.count() == 0


sale = st.tuples(
    st.integers(1, 12),  # invoice
    st.integers(1, 5),  # track
    st.integers(0, 500),  # cents
    st.integers(1, 9),  # quantity
)
invoice_row = st.tuples(
    st.sampled_from(["2023-12-30", "2024-01-01", "2024-01-06", "2024-02-03", "bad", None]),
    st.integers(1, 3),
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(invoice_row, min_size=1, max_size=10), st.lists(sale, min_size=1, max_size=30))
def test_rollups_agree_with_counting_by_hand(spark, invoices, sales):
    invoice = spark.createDataFrame(
        [(i, date, customer) for i, (date, customer) in enumerate(invoices, 1)], INVOICE
    )
    line = spark.createDataFrame(
        sales, "InvoiceId int, TrackId int, cents int, Quantity int"
    ).withColumn("UnitPrice", (F.col("cents") / 100).cast("decimal(10,2)"))

    days = defaultdict(lambda: [0, 0, set(), set(), 0])
    for number, _, cents, quantity in sales:
        if number > len(invoices):
            continue
        date, customer = invoices[number - 1]
        if date in ("bad", None):
            continue
        entry = days[date]
        entry[0] += 1
        entry[1] += quantity
        entry[2].add(number)
        entry[3].add(customer)
        entry[4] += cents * quantity
    measures = sales_per_day(invoice, line).collect()
    assert {
        str(r["fecha"]): (
            r["total_canciones_vendidas"],
            r["cantidad_total"],
            r["numero_facturas"],
            r["clientes_unicos"],
            int(r["monto_total"] * 100),
        )
        for r in measures
    } == {d: (a, b, len(c), len(e), f) for d, (a, b, c, e, f) in days.items()}

    total = [
        sum(r[c] for r in measures)
        for c in ("total_canciones_vendidas", "cantidad_total", "numero_facturas", "monto_total")
    ]
    for rollup in (sales_by_weekday, sales_by_month, sales_by_quarter, weekend_comparison):
        found = rollup(invoice, line).collect()
        assert [
            sum(r[c] for r in found)
            for c in (
                "total_canciones_vendidas",
                "cantidad_total",
                "numero_facturas",
                "monto_total",
            )
        ] == total


def test_weekend_comparison(spark, rows):
    invoice, line = frames(
        spark, [(7, "2023-05-12", 1), (8, "2023-05-13", 1), (9, "2023-05-14", 1)]
    )
    result = rows(weekend_comparison(invoice, line), "fin_de_semana")
    assert result[False]["numero_dias"] == 1
    assert result[True]["numero_dias"] == 2
    assert result[True]["clientes_unicos"] == 1
    assert result[True]["numero_facturas"] == 2


def test_weekday_averages(spark, rows):
    invoice, line = frames(
        spark, [(7, "2023-05-08", 1), (8, "2023-05-15", 1), (9, "2023-05-09", 1)]
    )
    result = rows(reports.weekday_normalized(sales_per_day(invoice, line)), "dia_semana")
    assert result["Monday"]["numero_dias"] == 2
    assert result["Monday"]["total_canciones_vendidas_por_dia"] == 1.5
    assert result["Monday"]["clientes_unicos_por_dia"] == 1.0


def test_month_reports(spark, rows):
    invoice, line = frames(
        spark, [(7, "2022-11-30", 1), (8, "2022-12-24", 1), (9, "2023-01-02", 1)]
    )
    ranking = rows(reports.month_ranking(invoice, line), "year_month")
    assert [ranking[m]["ranking"] for m in ("2022-11", "2022-12", "2023-01")] == [1, 3, 1]
    best = rows(reports.best_month_per_year(invoice, line), "año")
    assert {y: r["year_month"] for y, r in best.items()} == {2022: "2022-11", 2023: "2023-01"}
    quarters = rows(reports.quarter_ranking(invoice, line), "año", "trimestre")
    assert quarters[2022, 4]["ranking"] == 1
    trend = rows(reports.month_trend(invoice, line), "year_month")
    assert trend["2022-11"]["monto_anterior"] is None
    assert trend["2022-12"]["cambio_porcentual"] == pytest.approx(-80)
    assert trend["2023-01"]["media_movil_3"] == pytest.approx(6)


def test_ordered_reports(two_days):
    daily = sales_per_day(*two_days)
    assert [r["fecha"].day for r in reports.latest_days(daily).collect()] == [13, 12]
    after = reports.days_after(daily, datetime.date(2023, 5, 12)).collect()
    assert [r["fecha"].day for r in after] == [13]
