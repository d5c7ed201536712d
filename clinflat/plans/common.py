"""Shared pieces of the models."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinflat.functions.text import AMOUNT_PLACES


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None, microsecond=0)


@dataclass(frozen=True)
class RunInfo:
    """Values that are the same on every row of a run."""

    data_source: str = "synthea"
    ingest_datetime: datetime = field(default_factory=_now)
    default_days_supply: int = 30
    amount_places: int = AMOUNT_PLACES

    def columns(self) -> list[Column]:
        stamp = F.lit(self.ingest_datetime.strftime("%Y-%m-%d %H:%M:%S"))
        return [
            stamp.cast("timestamp_ntz").alias("ingest_datetime"),
            F.lit(self.data_source).alias("data_source"),
        ]


def empty(name: str, dtype: str = "string") -> Column:
    """A contract column that has no source."""
    return F.lit(None).cast(dtype).alias(name)


def text(c: Column | str, name: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").alias(name)


def person_columns(patient_id: str = "patient_id") -> list[Column]:
    return [text(patient_id, "person_id"), text(patient_id, "patient_id")]
