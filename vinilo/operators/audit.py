"""Constraint audit of the transactional tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.sources.schema import RAW_SCHEMAS

# Fixed length limits of the text columns.
MAX_LENGTHS = {
    "Artist": {"Name": 120},
    "Album": {"Title": 160},
    "Genre": {"Name": 120},
    "MediaType": {"Name": 120},
    "Track": {"Name": 200, "Composer": 220},
    "Employee": {
        "LastName": 20,
        "FirstName": 20,
        "Title": 30,
        "Address": 70,
        "City": 40,
        "State": 40,
        "Country": 40,
        "PostalCode": 10,
        "Phone": 24,
        "Fax": 24,
        "Email": 60,
    },
    "Customer": {
        "FirstName": 40,
        "LastName": 20,
        "Company": 80,
        "Address": 70,
        "City": 40,
        "State": 40,
        "Country": 40,
        "PostalCode": 10,
        "Phone": 24,
        "Fax": 24,
        "Email": 60,
    },
    "Invoice": {
        "BillingAddress": 70,
        "BillingCity": 40,
        "BillingState": 40,
        "BillingCountry": 40,
        "BillingPostalCode": 10,
    },
    "InvoiceLine": {},
}

# Fixed keys: unique columns of each table, then (table, column, parent, key).
UNIQUE = {table: [schema.fields[0].name] for table, schema in RAW_SCHEMAS.items()}
UNIQUE["Customer"] = ["CustomerId", "Email"]

FOREIGN_KEYS = (
    ("Album", "ArtistId", "Artist", "ArtistId"),
    ("Track", "AlbumId", "Album", "AlbumId"),
    ("Track", "MediaTypeId", "MediaType", "MediaTypeId"),
    ("Track", "GenreId", "Genre", "GenreId"),
    ("Employee", "ReportsTo", "Employee", "EmployeeId"),
    ("Customer", "SupportRepId", "Employee", "EmployeeId"),
    ("Invoice", "CustomerId", "Customer", "CustomerId"),
    ("InvoiceLine", "InvoiceId", "Invoice", "InvoiceId"),
    ("InvoiceLine", "TrackId", "Track", "TrackId"),
)


def _row_rules(name: str, df: DataFrame) -> DataFrame | None:
    """Counts of NULLs and of too long texts, all in one pass over the table."""
    bad = {
        f"{f.name} not null": F.col(f.name).isNull()
        for f in RAW_SCHEMAS[name].fields
        if not f.nullable and f.name in df.columns
    } | {
        f"{column} length {longest}": F.length(column) > longest
        for column, longest in MAX_LENGTHS[name].items()
        if column in df.columns
    }
    if not bad:
        return None
    counted = df.agg(*[F.count_if(c).alias(rule) for rule, c in bad.items()])
    return counted.unpivot([], list(bad), "rule", "violations").select(
        F.lit(name).alias("table_name"), "rule", "violations"
    )


def _unique_rule(name: str, df: DataFrame, column: str) -> DataFrame:
    """Number of rows beyond the first one of each value."""
    repeats = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return repeats.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(f"{column} unique").alias("rule"), "violations"
    )


def _foreign_key_rule(
    name: str, child: DataFrame, column: str, parent_name: str, parent: DataFrame, key: str
) -> DataFrame:
    """Number of rows whose key is missing in the parent.

    Rows are counted per key before the join, so a key with very many rows
    is one row there.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(key)).count()
    orphans = keys.join(parent.select(key), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("table_name"),
        F.lit(f"{column} references {parent_name}").alias("rule"),
        "violations",
    )


def constraint_audit(
    tables: dict[str, DataFrame], skip: set[tuple[str, str]] = frozenset()
) -> DataFrame:
    """(table_name, rule, violations) for every rule on the given tables.

    Rules on columns or tables that are not given are left out, and so are the
    unique rules named in ``skip`` as (table, column).
    """
    results = []
    for name, df in tables.items():
        if (rows := _row_rules(name, df)) is not None:
            results.append(rows)
        results += [
            _unique_rule(name, df, column)
            for column in UNIQUE[name]
            if column in df.columns and (name, column) not in skip
        ]
    results += [
        _foreign_key_rule(child, tables[child], column, parent, tables[parent], key)
        for child, column, parent, key in FOREIGN_KEYS
        if child in tables and parent in tables and column in tables[child].columns
    ]
    return reduce(DataFrame.unionByName, results)
