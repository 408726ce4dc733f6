"""Times of one run: every row of a run is stamped by the same instant, which the caller may give."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(now: datetime | None = None) -> datetime:
    """``now`` in UTC, or the present; a time without a zone is taken as UTC."""
    now = now or datetime.now(UTC)
    return now.astimezone(UTC) if now.tzinfo else now.replace(tzinfo=UTC)


def utc_iso(now: datetime | None = None) -> Column:
    return F.lit(instant(now).strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z")


def epoch_seconds(now: datetime | None = None) -> Column:
    return F.lit(int(instant(now).timestamp())).cast("long")


def epoch_millis(now: datetime | None = None) -> Column:
    return F.lit(int(instant(now).timestamp() * 1000)).cast("long")


def stamped(column: str, now: datetime | None = None) -> Column:
    """A timestamp column of that name."""
    return F.timestamp_micros(F.lit(int(instant(now).timestamp() * 1_000_000))).alias(column)
