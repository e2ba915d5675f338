"""Folders of the lake.

    {root}/raw/{table}/snapshot={YYYYMMDD_HHMMSS}/
    {root}/processed/{dataset}/snapshot={YYYYMMDD_HHMMSS}/
    {root}/analytics/informes/
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from datetime import datetime

# Fixed names of the tables and datasets.
COPIED_TABLES = (
    "Album",
    "Artist",
    "Customer",
    "Employee",
    "Genre",
    "Invoice",
    "InvoiceLine",
    "MediaType",
    "Playlist",
    "PlaylistTrack",
    "Track",
)
HISTORY = "customer_employee_history"
RAW_DATASETS = (*COPIED_TABLES, HISTORY)
PROCESSED_DATASETS = ("ventas_por_dia", "artista_mes", "dia_semana", "mes_ventas")
REPORTS = "analytics/informes"

SNAPSHOT_FORMAT = re.compile(r"\d{8}_\d{6}")


def new_snapshot(now: datetime | None = None) -> str:
    """Name of a snapshot taken now. Take it once per run and pass it on."""
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S")


def check_snapshot(snapshot: str) -> str:
    if not SNAPSHOT_FORMAT.fullmatch(snapshot):
        raise ValueError(f"snapshot must look like 20240101_000000, not {snapshot!r}")
    return snapshot


@dataclass(frozen=True)
class LakeLayout:
    root: str

    @classmethod
    def from_bucket(cls, bucket: str | None = None) -> LakeLayout:
        """Lake in an object store bucket, by default the one in ``S3_BUCKET``."""
        bucket = bucket or os.getenv("S3_BUCKET")
        if not bucket:
            raise ValueError("name a bucket or set S3_BUCKET")
        return cls(f"s3a://{bucket}")

    def raw(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/raw/{table}"

    def processed(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/processed/{dataset}"

    def reports(self) -> str:
        return f"{self.root.rstrip('/')}/{REPORTS}"

    def datasets(self) -> dict[str, str]:
        """Every raw and processed dataset with its folder."""
        return {name: self.raw(name) for name in RAW_DATASETS} | {
            name: self.processed(name) for name in PROCESSED_DATASETS
        }

    def folders(self) -> list[str]:
        return [*self.datasets().values(), self.reports()]
