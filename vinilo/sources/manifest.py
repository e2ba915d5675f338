"""What a finished run has written: its tables with their rows and bytes.

A run's manifest is written after all its tables, under another name first and then
renamed, so it is there as a whole or not at all. A table's snapshot counts only once
a manifest lists it; what a run left that was cut short between two tables is never read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession

RUNS = "_runs"


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _folder_and_table(dataset_path: str) -> tuple[str, str]:
    folder, _, table = dataset_path.rstrip("/").rpartition("/")
    return f"{folder}/{RUNS}", table


def write_manifest(spark: SparkSession, snapshot: str, paths: Iterable[str]) -> None:
    """List the snapshot of each dataset as finished, in one file per folder of datasets.

    Rows come from the files' footers and bytes from the file system.
    """
    runs: dict[str, dict[str, dict[str, int]]] = {}
    for path in paths:
        folder, table = _folder_and_table(path)
        data = f"{path}/snapshot={snapshot}"
        fs, place = _hadoop(spark, data)
        runs.setdefault(folder, {})[table] = {
            "rows": spark.read.parquet(data).count(),
            "bytes": fs.getContentSummary(place).getLength(),
        }
    for folder, tables in runs.items():
        name = f"{folder}/{snapshot}.{min(tables)}.json"
        fs, draft = _hadoop(spark, f"{folder}/.{snapshot}.{min(tables)}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps({"snapshot": snapshot, "tables": tables}).encode()))
        out.close()
        final = _hadoop(spark, name)[1]
        fs.delete(final, False)
        if not fs.rename(draft, final):
            raise OSError(f"cannot name the manifest {name}")


def withdraw(spark: SparkSession, snapshot: str, dataset_path: str) -> None:
    """Forget one dataset's snapshot, before it is written again."""
    for name, run in _manifests(spark, dataset_path):
        if run["snapshot"] == snapshot and _folder_and_table(dataset_path)[1] in run["tables"]:
            fs, place = _hadoop(spark, name)
            del run["tables"][_folder_and_table(dataset_path)[1]]
            fs.delete(place, False)
            if run["tables"]:
                out = fs.create(place, True)
                out.write(bytearray(json.dumps(run).encode()))
                out.close()


def _manifests(spark: SparkSession, dataset_path: str) -> list[tuple[str, dict]]:
    """The runs that wrote into the dataset's folder."""
    fs, folder = _hadoop(spark, _folder_and_table(dataset_path)[0])
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().toString()
        if name.endswith(".json"):
            stream = fs.open(status.getPath())
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            found.append((name, json.loads(text)))
    return found


def finished(spark: SparkSession, dataset_path: str) -> dict[str, dict[str, int]]:
    """Snapshots of the dataset that a manifest lists, with their rows and bytes."""
    table = _folder_and_table(dataset_path)[1]
    return {
        run["snapshot"]: run["tables"][table]
        for _, run in _manifests(spark, dataset_path)
        if table in run["tables"]
    }
