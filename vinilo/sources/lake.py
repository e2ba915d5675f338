"""Reading and writing snapshots of the lake."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinilo.sources.layout import SNAPSHOT_FORMAT, LakeLayout, check_snapshot
from vinilo.sources.manifest import finished, withdraw, write_manifest

# Left by Spark's writer when all of a folder has been written.
SUCCESS = "_SUCCESS"


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def _folders(spark: SparkSession, path: str) -> list[str]:
    if not _exists(spark, path):
        return []
    fs, hadoop_path = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]


def list_snapshots(spark: SparkSession, dataset_path: str) -> list[str]:
    """Finished snapshots of a dataset, oldest first, from folder names only.

    A snapshot counts once its writer has left the mark of success and the run's
    manifest lists it, so a run that failed or was cut short is never read, not even
    those of its tables that were finished.
    """
    listed = finished(spark, dataset_path)
    prefix = "snapshot="
    names = (
        name.removeprefix(prefix)
        for name in _folders(spark, dataset_path)
        if name.startswith(prefix)
    )
    return sorted(
        name
        for name in names
        if SNAPSHOT_FORMAT.fullmatch(name)
        and name in listed
        and _exists(spark, f"{dataset_path}/{prefix}{name}/{SUCCESS}")
    )


def latest_common_snapshot(spark: SparkSession, dataset_paths: Iterable[str]) -> str:
    """The newest snapshot that all the datasets have."""
    paths = list(dataset_paths)
    shared = set.intersection(*[set(list_snapshots(spark, p)) for p in paths])
    if not shared:
        raise FileNotFoundError(f"no common snapshot under {', '.join(paths)}")
    return max(shared)


def usable_snapshot(
    spark: SparkSession, dataset_paths: Iterable[str], snapshot: str | None = None
) -> str:
    """The snapshot asked for, which all the datasets need to have finished, or their newest."""
    paths = list(dataset_paths)
    if snapshot is None:
        return latest_common_snapshot(spark, paths)
    for path in paths:
        if check_snapshot(snapshot) not in finished(spark, path):
            raise FileNotFoundError(f"no finished snapshot {snapshot} under {path}")
    return snapshot


def read_snapshot(
    spark: SparkSession, dataset_path: str, snapshot: str | None = None
) -> DataFrame:
    """One snapshot of a dataset, by default the latest, without its partition column.

    Only that snapshot's folder is listed and read. A snapshot asked for by name
    has to be finished as well.
    """
    snapshot = usable_snapshot(spark, [dataset_path], snapshot)
    return spark.read.parquet(f"{dataset_path}/snapshot={snapshot}")


def read_raw_tables(
    spark: SparkSession,
    layout: LakeLayout,
    tables: Iterable[str],
    snapshot: str | None = None,
) -> dict[str, DataFrame]:
    """Several raw tables, all from the same snapshot."""
    tables = list(tables)
    snapshot = usable_snapshot(spark, [layout.raw(t) for t in tables], snapshot)
    return {t: read_snapshot(spark, layout.raw(t), snapshot) for t in tables}


def raw_bytes(
    spark: SparkSession, layout: LakeLayout, tables: Iterable[str], snapshot: str
) -> int:
    """Size of the files that ``read_raw_tables`` would read."""
    return sum(folder_bytes(spark, f"{layout.raw(t)}/snapshot={snapshot}") for t in tables)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder, from the file system's own count."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def write_snapshot(
    df: DataFrame, dataset_path: str, snapshot: str, mode: str = "overwrite", listed: bool = True
) -> str:
    """Write one snapshot and return its folder; other snapshots stay as they are.

    It can be read once it is listed; a run of several tables lists them together
    at its end. While a snapshot is written again it is not listed.
    """
    spark = df.sparkSession
    path = f"{dataset_path}/snapshot={check_snapshot(snapshot)}"
    if mode == "overwrite":
        withdraw(spark, snapshot, dataset_path)
    df.write.mode(mode).parquet(path)
    if listed:
        write_manifest(spark, snapshot, [dataset_path])
    return path


def full_copy(
    reader,
    layout: LakeLayout,
    tables: Iterable[str],
    snapshot: str,
) -> dict[str, str]:
    """Copy every table to the lake under one snapshot name; returns the folders.

    ``reader(table)`` gives the table as a DataFrame. A snapshot that is
    already there is an error, so a rerun cannot mix two states of a table. The
    copies can be read once all of them are there.
    """
    folders = {}
    for table in tables:
        df = reader(table)
        spark = df.sparkSession
        folders[table] = write_snapshot(df, layout.raw(table), snapshot, "errorifexists", listed=False)
    if folders:
        write_manifest(spark, snapshot, [layout.raw(table) for table in folders])
    return folders


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each of the frames."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionAll(more)
    return result
