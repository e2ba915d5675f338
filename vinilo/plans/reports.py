"""Reports on top of the rollups."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vinilo.functions.numbers import percentage, ratio
from vinilo.operators.sales import MEASURES, sales_by_month, sales_by_quarter


def latest_days(daily: DataFrame, days: int = 10) -> DataFrame:
    return (
        daily.select("fecha", "total_canciones_vendidas", "monto_total")
        .orderBy(F.col("fecha").desc())
        .limit(days)
    )


def days_after(daily: DataFrame, date: datetime.date) -> DataFrame:
    """Days after a date, those with most songs sold first."""
    return daily.filter(F.col("fecha") > F.lit(date)).orderBy(
        F.col("total_canciones_vendidas").desc(), F.col("fecha").desc()
    )


def top_artists(top_per_month: DataFrame) -> DataFrame:
    """The best artists of each month, newest month first."""
    return top_per_month.select(
        "mes", "nombre_artista", "total_canciones_vendidas"
    ).orderBy(F.col("mes").desc(), F.col("total_canciones_vendidas").desc())


def weekday_normalized(daily: DataFrame, round_to: int | None = None) -> DataFrame:
    """Averages per day of each weekday, over the days that had sales."""
    sums = daily.groupBy("dia_semana").agg(
        F.count(F.lit(1)).alias("numero_dias"), *[F.sum(m).alias(m) for m in MEASURES]
    )
    averages = [
        ratio(F.col(m), F.col("numero_dias"), round_to).alias(f"{m}_por_dia")
        for m in MEASURES
    ]
    return sums.select("dia_semana", "numero_dias", *averages)


# The three windows below have no partition: they run over months or quarters,
# of which a calendar holds few however large the tables are.


def month_ranking(invoice: DataFrame, line: DataFrame) -> DataFrame:
    """Months ranked by songs sold, equal months sharing a rank."""
    best_first = Window.orderBy(F.col("total_canciones_vendidas").desc())
    return sales_by_month(invoice, line).withColumn("ranking", F.rank().over(best_first))


def best_month_per_year(invoice: DataFrame, line: DataFrame) -> DataFrame:
    """The month of each year with most songs sold, the earlier one on a tie."""
    best_first = Window.partitionBy("año").orderBy(
        F.col("total_canciones_vendidas").desc(), "year_month"
    )
    return (
        sales_by_month(invoice, line)
        .withColumn("año", F.substring("year_month", 1, 4).cast("int"))
        .withColumn("rk", F.row_number().over(best_first))
        .filter(F.col("rk") == 1)
        .drop("rk")
    )


def quarter_ranking(invoice: DataFrame, line: DataFrame) -> DataFrame:
    """Quarters ranked by songs sold, equal quarters sharing a rank."""
    best_first = Window.orderBy(F.col("total_canciones_vendidas").desc())
    return sales_by_quarter(invoice, line).withColumn("ranking", F.rank().over(best_first))


def month_trend(invoice: DataFrame, line: DataFrame) -> DataFrame:
    """Change of the amount to the month before, and its average over three months.

    Months are those of the calendar: after a month without sales there is nothing to
    compare with, and the average is that of the months with sales among the three.
    """
    amount = F.col("monto_total").cast("double")
    number = F.substring("year_month", 1, 4).cast("int") * 12 + F.substring("year_month", 6, 2).cast("int")
    in_order = Window.orderBy("_month")
    before = F.sum(amount).over(in_order.rangeBetween(-1, -1))
    return (
        sales_by_month(invoice, line)
        .select("year_month", "total_canciones_vendidas", "monto_total", number.alias("_month"))
        .withColumns(
            {
                "monto_anterior": before,
                "cambio_porcentual": percentage(amount - before, before),
                "media_movil_3": F.avg(amount).over(in_order.rangeBetween(-2, 0)),
            }
        )
        .drop("_month")
    )
