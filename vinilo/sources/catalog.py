"""Registering the lake's datasets as external tables ``dl_<dataset>``."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from vinilo.sources.lake import list_snapshots, read_snapshot
from vinilo.sources.layout import LakeLayout

TABLE_PREFIX = "dl_"
PARTITION = "snapshot"


class TypeConflict(ValueError):
    """Columns of one name whose types have no common one."""


# Whole numbers by width, with the digits that their values may have.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that files of both types can be read as without loss, if any.

    Whole numbers widen to longer ones, to decimals with enough digits, and up to
    ``int`` to doubles; decimals to more digits before and behind the point, floats to
    doubles, dates to times without a zone.
    """
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.get)
    if isinstance(b, T.DecimalType) or (a in _WHOLE and b not in _WHOLE):
        a, b = b, a
    if isinstance(a, T.DecimalType):
        if b in _WHOLE:
            whole, scale = _WHOLE[b], 0
        elif isinstance(b, T.DecimalType):
            whole, scale = b.precision - b.scale, b.scale
        else:
            return None
        scale = max(scale, a.scale)
        digits = max(whole, a.precision - a.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    if a == T.DoubleType() and (b == T.FloatType() or _WHOLE.get(b, 99) <= 10):
        return a
    if {a, b} == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    if {a, b} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return None


def _columns(schemas: Iterable[StructType]) -> dict[str, str]:
    """Columns of all the schemas, each of the type that holds all of its values."""
    kinds: dict[str, T.DataType] = {}
    names: dict[str, str] = {}
    for schema in schemas:
        for column in schema.fields:
            if column.name == PARTITION:
                continue
            name = names.setdefault(column.name.lower(), column.name)
            before = kinds.get(name, column.dataType)
            both = common_type(before, column.dataType)
            if both is None:
                raise TypeConflict(
                    f"column {name} is {column.dataType.simpleString()} in one snapshot "
                    f"and {before.simpleString()} in another"
                )
            kinds[name] = both
    return {name: kind.simpleString() for name, kind in kinds.items()}


def _create(spark: SparkSession, table: str, path: str, columns: dict[str, str]) -> None:
    listed = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({listed}, {PARTITION} STRING) USING parquet "
        f"PARTITIONED BY ({PARTITION}) LOCATION '{quoted}'"
    )


def _register(spark: SparkSession, table: str, path: str) -> str:
    """Bring one table in line with its folder; returns what was done.

    All files of a snapshot have one schema, so a file of each is enough to
    know the columns, and a file of the newest is enough once a table exists.
    """
    newest_first = list_snapshots(spark, path)[::-1]
    exists = spark.catalog.tableExists(table)
    if not newest_first:
        if not exists:
            return "absent"
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('deprecated' = 'true')")
        return "deprecated"
    outcome = "unchanged"
    if exists:
        known = spark.table(table).schema
        columns = _columns([read_snapshot(spark, path, newest_first[0]).schema, known])
        if sorted(columns.items()) != sorted(_columns([known]).items()):
            # The table is external: dropping it leaves the files alone.
            spark.sql(f"DROP TABLE {table}")
            _create(spark, table, path, columns)
            outcome = "updated"
    else:
        columns = _columns(read_snapshot(spark, path, s).schema for s in newest_first)
        _create(spark, table, path, columns)
        outcome = "created"
    # Only finished snapshots, which a search for folders would not tell apart.
    added = " ".join(f"PARTITION ({PARTITION} = '{s}')" for s in newest_first)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    spark.sql(f"REFRESH TABLE {table}")
    return outcome


def register_lake(
    spark: SparkSession,
    layout: LakeLayout,
    database: str,
    datasets: Iterable[str] | None = None,
    dry_run: bool = False,
) -> dict[str, Any]:
    """Create the database and one table per dataset; safe to repeat.

    New columns in newer snapshots are taken over and columns of several types get the
    type that holds them all; where there is none, that is an error. Datasets whose folder has
    gone are marked deprecated, and an error on one table does not stop the
    others. With ``dry_run`` nothing is touched.
    """
    folders = layout.datasets()
    wanted = list(folders) if datasets is None else list(datasets)
    result: dict[str, Any] = {
        "database_name": database,
        "database_created": False,
        "tables": {},
        "errors": [],
        "dry_run": dry_run,
    }
    if dry_run:
        result["database_created"] = True
        result["tables"] = {f"{TABLE_PREFIX}{d}": "created" for d in wanted}
        return result
    if not spark.catalog.databaseExists(database):
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {database} "
            f"LOCATION '{layout.root.rstrip('/')}/catalog/{database}'"
        )
        result["database_created"] = True
    for dataset in wanted:
        name = f"{TABLE_PREFIX}{dataset}".lower()
        try:
            result["tables"][name] = _register(spark, f"{database}.{name}", folders[dataset])
        except Exception as error:
            result["errors"].append(f"{name}: {error}")
    return result
