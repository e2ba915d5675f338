"""Customer segmentation from the raw tables to saved clusters.

    spark-submit vinilo/plans/segmentation_job.py --s3-bucket lake --k 5
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vinilo.operators import segments
from vinilo.operators.features import MAIN_GENRES, customer_features, feature_columns
from vinilo.plans.session import checkpoint, job_session, size_shuffles
from vinilo.sources.jdbc import RANGE_ROWS, JdbcSource, read_balanced
from vinilo.sources.lake import raw_bytes, read_raw_tables, usable_snapshot
from vinilo.sources.layout import LakeLayout
from vinilo.sources.schema import PRIMARY_KEYS

TABLES = ("Customer", "Invoice", "InvoiceLine", "Track", "Genre")


@dataclass(frozen=True)
class Segmentation:
    k: int
    predictions: DataFrame
    profile: DataFrame
    quality: segments.KScore
    sweep: list[segments.KScore]


def load_tables(
    spark: SparkSession,
    source: str,
    layout: LakeLayout | None = None,
    database: JdbcSource | None = None,
    snapshot: str | None = None,
    range_rows: int = RANGE_ROWS,
) -> dict[str, DataFrame]:
    """The five tables from the lake (``s3``) or the database (``mysql``)."""
    if source == "s3":
        snapshot = usable_snapshot(spark, [layout.raw(t) for t in TABLES], snapshot)
        size_shuffles(spark, raw_bytes(spark, layout, TABLES, snapshot))
        return read_raw_tables(spark, layout, TABLES, snapshot)
    if source == "mysql":
        return {
            t: read_balanced(spark, database, t, PRIMARY_KEYS[t], range_rows) for t in TABLES
        }
    raise ValueError(f"unknown data source: {source}")


def segment_features(
    features: DataFrame,
    columns: Sequence[str],
    k: int | None = None,
    find_optimal: bool = True,
    ks: Iterable[int] = segments.K_RANGE,
    output_path: str | None = None,
) -> Segmentation:
    """Scale, choose ``k`` where none is given, cluster, profile and save.

    The features are checkpointed first: the fits below read them many times,
    and each would otherwise join the sales again.
    """
    scaled, scaler = segments.scale(checkpoint(features), columns)
    sweep: list[segments.KScore] = []
    if k is None and find_optimal:
        sweep = segments.sweep_k(scaled, ks)
        k = segments.best_k(sweep)
    model, predictions, quality = segments.train_kmeans(scaled, k or segments.DEFAULT_K)
    profile = segments.cluster_profile(predictions, columns)
    if output_path:
        segments.save_results(predictions, profile, model, scaler, output_path)
    return Segmentation(quality.k, predictions, profile, quality, sweep)


def run_segmentation(
    tables: dict[str, DataFrame],
    main_genres: Sequence[str] = MAIN_GENRES,
    **options,
) -> Segmentation:
    features = customer_features(*[tables[t] for t in TABLES], main_genres=main_genres)
    return segment_features(features, feature_columns(main_genres), **options)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Cluster customers by their purchases")
    parser.add_argument("--data-source", choices=["s3", "mysql"], default="s3")
    parser.add_argument("--s3-bucket", help="bucket of the lake, needed for s3")
    parser.add_argument("--snapshot", help="snapshot to read, by default the latest")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--db-user")
    parser.add_argument("--db-password")
    parser.add_argument("--jdbc-rows", type=int, default=RANGE_ROWS, help="rows read by a task")
    parser.add_argument("--k", type=int, help="number of clusters, searched if left out")
    parser.add_argument("--no-optimize", action="store_true", help="do not search for k")
    parser.add_argument("--output-path", help="folder for the results")
    args = parser.parse_args(argv)
    if args.data_source == "s3" and not args.s3_bucket:
        parser.error("--s3-bucket is needed with --data-source s3")
    if args.data_source == "mysql" and not (
        args.jdbc_url and args.db_user and args.db_password
    ):
        parser.error("--jdbc-url, --db-user and --db-password are needed for mysql")
    return args


def main(
    argv: list[str] | None = None,
    session: Callable[[str], SparkSession] = job_session,
) -> None:
    args = arguments(argv)
    spark = session("customer-segmentation")
    try:
        lake = args.data_source == "s3"
        tables = load_tables(
            spark,
            args.data_source,
            layout=LakeLayout.from_bucket(args.s3_bucket) if lake else None,
            database=None
            if lake
            else JdbcSource(args.jdbc_url, args.db_user, args.db_password),
            snapshot=args.snapshot,
            range_rows=args.jdbc_rows,
        )
        result = run_segmentation(
            tables,
            k=args.k,
            find_optimal=not args.no_optimize,
            output_path=args.output_path,
        )
        print(f"k={result.k} silhouette={result.quality.silhouette} cost={result.quality.cost}")
        result.profile.orderBy("cluster").show(truncate=False)
        segments.cluster_examples(result.predictions).show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
