"""Jobs that copy the tables to the lake and write the sales rollups.

    spark-submit vinilo/plans/rollup_job.py --root s3a://bucket --job ventas_por_dia
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vinilo.operators.artists import artist_month_metrics, top_artist_per_month
from vinilo.operators.history import customer_employee_history
from vinilo.operators.sales import sales_by_month, sales_by_weekday, sales_per_day, watched_dates
from vinilo.plans.session import job_session, size_shuffles
from vinilo.sources.jdbc import RANGE_ROWS, JdbcSource, read_balanced
from vinilo.sources.lake import (
    raw_bytes,
    read_raw_tables,
    usable_snapshot,
    write_snapshot,
)
from vinilo.sources.layout import COPIED_TABLES, HISTORY, LakeLayout, new_snapshot
from vinilo.sources.manifest import write_manifest
from vinilo.sources.schema import PRIMARY_KEYS


def _top_artists(*tables: DataFrame) -> DataFrame:
    return top_artist_per_month(artist_month_metrics(*tables))


# Dataset: (tables it reads, in the order of the function's arguments; function).
ROLLUPS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "ventas_por_dia": (("Invoice", "InvoiceLine"), sales_per_day),
    "artista_mes": (("Invoice", "InvoiceLine", "Track", "Album", "Artist"), _top_artists),
    "dia_semana": (("Invoice", "InvoiceLine"), sales_by_weekday),
    "mes_ventas": (("Invoice", "InvoiceLine"), sales_by_month),
}
COPY = "full_copy"


def run_rollup(
    spark: SparkSession,
    layout: LakeLayout,
    dataset: str,
    output_snapshot: str,
    input_snapshot: str | None = None,
    report: Callable[[dict], None] | None = None,
) -> str:
    """Compute one dataset from a snapshot of the raw tables; returns its folder.

    ``report`` is given what ``sales.watched_dates`` has seen of dropped invoices.
    """
    names, compute = ROLLUPS[dataset]
    snapshot = usable_snapshot(spark, [layout.raw(n) for n in names], input_snapshot)
    size_shuffles(spark, raw_bytes(spark, layout, names, snapshot))
    tables = read_raw_tables(spark, layout, names, snapshot)
    tables["Invoice"], dates = watched_dates(tables["Invoice"])
    result = compute(*[tables[name] for name in names])
    path = write_snapshot(result, layout.processed(dataset), output_snapshot)
    if report is not None:
        report(dates.get)
    return path


def print_dropped(seen: dict) -> None:
    """Tell how many invoices have no part in the result, and their amount."""
    print(
        f"{seen['invoices']} invoices read; left out for their dates: {seen['without_date']} without, "
        f"{seen['unreadable']} unreadable, amount {seen['dropped_amount']:.2f}"
    )


def run_full_copy(
    spark: SparkSession, reader: Callable[[str], DataFrame], layout: LakeLayout, snapshot: str
) -> dict[str, str]:
    """Copy all tables and join the customer history from the copies; both are listed together."""
    folders: dict[str, str] = {}

    def copied(table: str) -> DataFrame:
        if table != HISTORY:
            return reader(table)
        customer, employee = (spark.read.parquet(folders[t]) for t in ("Customer", "Employee"))
        return customer_employee_history(customer, employee)

    for table in (*COPIED_TABLES, HISTORY):
        folders[table] = write_snapshot(
            copied(table), layout.raw(table), snapshot, "errorifexists", listed=False
        )
    write_manifest(spark, snapshot, [layout.raw(table) for table in folders])
    return folders


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Copy tables or write a sales rollup")
    parser.add_argument("--root", required=True, help="root folder of the lake")
    parser.add_argument("--job", required=True, choices=[COPY, *ROLLUPS])
    parser.add_argument("--snapshot", help="snapshot to read, by default the latest")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--db-user")
    parser.add_argument("--db-password")
    parser.add_argument("--jdbc-rows", type=int, default=RANGE_ROWS, help="rows read by a task")
    args = parser.parse_args(argv)
    if args.job == COPY and not (args.jdbc_url and args.db_user and args.db_password):
        parser.error(f"{COPY} needs --jdbc-url, --db-user and --db-password")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = job_session(f"sales-{args.job}")
    layout, snapshot = LakeLayout(args.root), new_snapshot()
    try:
        if args.job == COPY:
            source = JdbcSource(args.jdbc_url, args.db_user, args.db_password)
            run_full_copy(
                spark,
                lambda table: read_balanced(
                    spark, source, table, PRIMARY_KEYS[table], args.jdbc_rows
                ),
                layout,
                snapshot,
            )
        else:
            run_rollup(spark, layout, args.job, snapshot, args.snapshot, print_dropped)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
