"""Schemas of the raw tables and the columns of the output datasets."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed columns of the transactional tables. A trailing ! marks NOT NULL.
_COLUMNS = {
    "Artist": "ArtistId int!, Name string!",
    "Album": "AlbumId int!, Title string!, ArtistId int!",
    "Genre": "GenreId int!, Name string!",
    "MediaType": "MediaTypeId int!, Name string!",
    "Track": (
        "TrackId int!, Name string!, AlbumId int, MediaTypeId int!, GenreId int, "
        "Composer string, Milliseconds int!, Bytes int, UnitPrice money!"
    ),
    "Employee": (
        "EmployeeId int!, LastName string!, FirstName string!, Title string, "
        "ReportsTo int, BirthDate time, HireDate time, Address string, City string, "
        "State string, Country string, PostalCode string, Phone string, Fax string, "
        "Email string"
    ),
    "Customer": (
        "CustomerId int!, FirstName string!, LastName string!, Company string, "
        "Address string, City string, State string, Country string, "
        "PostalCode string, Phone string, Fax string, Email string!, SupportRepId int"
    ),
    "Invoice": (
        "InvoiceId int!, CustomerId int!, InvoiceDate time!, BillingAddress string, "
        "BillingCity string, BillingState string, BillingCountry string, "
        "BillingPostalCode string, Total money!"
    ),
    "InvoiceLine": (
        "InvoiceLineId int!, InvoiceId int!, TrackId int!, UnitPrice money!, "
        "Quantity int!"
    ),
}

_TYPES = {
    "int": T.IntegerType(),
    "string": T.StringType(),
    "money": T.DecimalType(10, 2),
    "time": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    fields = []
    for column in columns.split(", "):
        name, kind = column.split(" ")
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


RAW_SCHEMAS = {table: _schema(columns) for table, columns in _COLUMNS.items()}

# Integer primary key of each table, used to read it in ranges.
PRIMARY_KEYS = {table: schema.fields[0].name for table, schema in RAW_SCHEMAS.items()} | {
    "Playlist": "PlaylistId",
    "PlaylistTrack": "PlaylistId",
}

CHECKOUT_REQUEST = T.StructType(
    [
        T.StructField("CheckoutId", T.LongType(), False),
        T.StructField("CustomerId", T.LongType()),
        T.StructField("BillingAddress", T.StringType()),
        T.StructField("BillingCity", T.StringType()),
        T.StructField("BillingCountry", T.StringType()),
        T.StructField(
            "Items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("TrackId", T.LongType()),
                        T.StructField("Quantity", T.IntegerType()),
                        T.StructField("UnitPrice", T.DecimalType(10, 2)),
                    ]
                )
            ),
        ),
    ]
)
