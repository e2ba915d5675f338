"""Daily sales that months, weekdays and quarters are merged from.

Counts of different customers do not add up, so a day keeps its customers as
bitmaps: ids are cut into ranges of 32,768, and each range a day has customers of
is one bitmap of 4 KB. Bitmaps of days merge to the exact number of customers of
any group of days, and lines and invoices are never read again. A day has a bitmap
for few customers too, so days are what they suit: the few groups with many ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinilo.operators.sales import MEASURES
from vinilo.plans.session import checkpoint


def numbered(values: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): a number for each of the column's different values, NULL aside.

    Numbers are given once and written out, so that a lost task cannot give others.
    """
    distinct = values.select(column).filter(F.col(column).isNotNull()).distinct()
    return checkpoint(distinct.withColumn(name, F.monotonically_increasing_id()))


@dataclass(frozen=True)
class DayBase:
    """``measures``: a row per day; ``customers``: bitmaps per day and range of ids."""

    measures: DataFrame
    customers: DataFrame

    @classmethod
    def of(cls, totals: DataFrame) -> DayBase:
        """From ``sales.invoice_totals`` rows. Text ids go by a table of numbers."""
        ident = F.col("CustomerId")
        if not isinstance(totals.schema["CustomerId"].dataType, T.IntegralType):
            numbers = numbered(totals, "CustomerId", "_number")
            known = totals.select("fecha", "CustomerId").join(numbers, "CustomerId")
            ident = F.col("_number")
        else:
            known = totals.filter(ident.isNotNull())
        measures = totals.groupBy("fecha").agg(
            F.sum("canciones").alias("total_canciones_vendidas"),
            F.sum("cantidad").alias("cantidad_total"),
            F.count(F.lit(1)).alias("numero_facturas"),
            F.sum("monto").alias("monto_total"),
        )
        customers = known.groupBy("fecha", F.bitmap_bucket_number(ident).alias("rango")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(ident)).alias("clientes")
        )
        return cls(measures, customers)

    def merged(self, **keys: Column) -> DataFrame:
        """The five measures by keys made of ``fecha``, with the number of days behind each."""
        named = [expr.alias(name) for name, expr in keys.items()]
        sums = self.measures.groupBy(*named).agg(
            *[F.sum(m).alias(m) for m in MEASURES if m != "clientes_unicos"],
            F.count(F.lit(1)).alias("numero_dias"),
        )
        customers = (
            self.customers.groupBy(*named, "rango")
            .agg(F.bitmap_count(F.bitmap_or_agg("clientes")).alias("_n"))
            .groupBy(*keys)
            .agg(F.sum("_n").alias("clientes_unicos"))
        )
        return sums.join(customers, list(keys), "left").select(
            *keys,
            *[
                F.coalesce(m, F.lit(0)).alias(m) if m == "clientes_unicos" else F.col(m)
                for m in MEASURES
            ],
            "numero_dias",
        )
