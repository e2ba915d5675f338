"""Sales by day, weekday, month and quarter.

All rollups start from ``invoice_totals``. Lines are summed per invoice before
the join, which shrinks the shuffle, flattens invoices with very many lines,
and leaves one distinct count (customers) instead of two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vinilo.functions.dates import day, is_weekend, weekday_name, year_month
from vinilo.functions.numbers import ratio

# Fixed names of the measures.
MEASURES = (
    "total_canciones_vendidas",
    "cantidad_total",
    "numero_facturas",
    "clientes_unicos",
    "monto_total",
)


def valid_dates(invoice: DataFrame, column: str = "InvoiceDate") -> DataFrame:
    """Rows whose date can be read, with the date as ``fecha``."""
    return invoice.withColumn("fecha", day(invoice, column)).filter(
        F.col("fecha").isNotNull()
    )


# What is told of invoices whose dates cannot be read; amounts only where invoices have them.
DROPPED = "invoices long, without_date long, unreadable long, dropped_amount double"


def watched_dates(invoice: DataFrame) -> tuple[DataFrame, Observation]:
    """The invoices, and what is seen of their dates while a job reads them.

    ``Observation.get`` waits for that job and has the columns of ``DROPPED``. The
    figures come from the job's own pass and need no other.
    """
    lost = day(invoice, "InvoiceDate").isNull()
    missing = F.col("InvoiceDate").isNull()
    amount = F.col("Total") if "Total" in invoice.columns else F.lit(0.0)
    seen = Observation("dates")
    zero = F.lit(0).cast("long")
    return (
        invoice.observe(
            seen,
            F.count(F.lit(1)).alias("invoices"),
            F.coalesce(F.count_if(missing), zero).alias("without_date"),
            F.coalesce(F.count_if(lost & ~missing), zero).alias("unreadable"),
            F.coalesce(F.sum(F.when(lost, amount)).cast("double"), F.lit(0.0)).alias(
                "dropped_amount"
            ),
        ),
        seen,
    )


def line_sums(line: DataFrame) -> DataFrame:
    """Songs, quantity and amount per invoice."""
    return line.groupBy("InvoiceId").agg(
        F.count("TrackId").alias("canciones"),
        F.sum("Quantity").alias("cantidad"),
        F.sum(F.col("UnitPrice") * F.col("Quantity")).alias("monto"),
    )


def invoice_totals(invoice: DataFrame, line: DataFrame) -> DataFrame:
    """One row per invoice with a readable date and at least one line.

    ``InvoiceId`` is the key of ``invoice``; ``audit.constraint_audit`` finds
    repeats.
    """
    dated = valid_dates(invoice).select("InvoiceId", "CustomerId", "fecha")
    return line_sums(line).join(dated, "InvoiceId")


def rollup(totals: DataFrame, **keys: Column) -> DataFrame:
    """The five measures of ``invoice_totals`` rows by the given keys."""
    return totals.groupBy(*[expr.alias(name) for name, expr in keys.items()]).agg(
        F.sum("canciones").alias("total_canciones_vendidas"),
        F.sum("cantidad").alias("cantidad_total"),
        F.count(F.lit(1)).alias("numero_facturas"),
        F.count_distinct("CustomerId").alias("clientes_unicos"),
        F.sum("monto").alias("monto_total"),
    )


def with_invoice_ratios(measures: DataFrame, round_to: int | None = None) -> DataFrame:
    invoices = F.col("numero_facturas")
    return measures.withColumns(
        {
            "avg_canciones_por_factura": ratio(
                F.col("total_canciones_vendidas"), invoices, round_to
            ),
            "ticket_promedio": ratio(F.col("monto_total"), invoices, round_to),
        }
    )


def sales_per_day(
    invoice: DataFrame, line: DataFrame, round_to: int | None = None
) -> DataFrame:
    return per_day(invoice_totals(invoice, line), round_to)


def per_day(totals: DataFrame, round_to: int | None = None) -> DataFrame:
    """``sales_per_day`` of ``invoice_totals`` rows."""
    daily = rollup(totals, fecha=F.col("fecha"))
    date = F.col("fecha")
    dated = daily.withColumns(
        {
            "dia_semana": weekday_name(date),
            "mes": F.month(date),
            "año": F.year(date),
            "trimestre": F.quarter(date),
        }
    )
    return with_invoice_ratios(dated, round_to)


def sales_by_weekday(
    invoice: DataFrame, line: DataFrame, round_to: int | None = None
) -> DataFrame:
    totals = invoice_totals(invoice, line)
    return with_invoice_ratios(
        rollup(totals, dia_semana=weekday_name(F.col("fecha"))), round_to
    )


def sales_by_month(
    invoice: DataFrame, line: DataFrame, round_to: int | None = None
) -> DataFrame:
    totals = invoice_totals(invoice, line)
    return with_invoice_ratios(
        rollup(totals, year_month=year_month(F.col("fecha"))), round_to
    )


def sales_by_quarter(
    invoice: DataFrame, line: DataFrame, round_to: int | None = None
) -> DataFrame:
    totals = invoice_totals(invoice, line)
    date = F.col("fecha")
    return with_invoice_ratios(
        rollup(totals, **{"año": F.year(date), "trimestre": F.quarter(date)}), round_to
    )


def weekend_comparison(
    invoice: DataFrame, line: DataFrame, round_to: int | None = None
) -> DataFrame:
    """Weekdays against weekends, with the number of dates behind each."""
    per_customer_day = (
        invoice_totals(invoice, line)
        .groupBy("fecha", "CustomerId")
        .agg(
            F.sum("canciones").alias("canciones"),
            F.sum("cantidad").alias("cantidad"),
            F.count(F.lit(1)).alias("facturas"),
            F.sum("monto").alias("monto"),
        )
    )
    compared = per_customer_day.groupBy(
        is_weekend(F.col("fecha")).alias("fin_de_semana")
    ).agg(
        F.sum("canciones").alias("total_canciones_vendidas"),
        F.sum("cantidad").alias("cantidad_total"),
        F.sum("facturas").alias("numero_facturas"),
        F.count_distinct("CustomerId").alias("clientes_unicos"),
        F.sum("monto").alias("monto_total"),
        F.count_distinct("fecha").alias("numero_dias"),
    )
    return with_invoice_ratios(compared, round_to)
