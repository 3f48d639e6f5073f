"""Time expressions: parsing, formatting, durations and buckets.

All of them are built-in expressions. Arithmetic goes through microseconds since the epoch and back as an
interval, so a ``timestamp`` stays a ``timestamp`` and a ``timestamp_ntz`` stays a ``timestamp_ntz``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorpipe.constants import ISO_Z, NO_BOUND

_FIXED = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
    "w": 604_800_000_000,
}
_CALENDAR = {"mo": "month", "q": "quarter", "y": "year"}
_MONTHS = {"mo": 1, "q": 3, "y": 12}
_DURATION = re.compile(r"(\d+)(us|ms|mo|[smhdwqy])")


@dataclass(frozen=True)
class Duration:
    """``10s``, ``5m`` (minutes), ``1h``, ``1d``, ``1w``, ``1mo`` (months), ``1q``, ``1y``."""

    count: int
    unit: str

    @classmethod
    def of(cls, text: str | Duration) -> Duration:
        if isinstance(text, Duration):
            return text
        match = _DURATION.fullmatch(text.strip())
        if not match or int(match[1]) == 0:
            raise ValueError(f"not a duration: {text!r}")
        return cls(int(match[1]), match[2])

    @property
    def micros(self) -> int | None:
        """Length in microseconds, or None for calendar units."""
        return self.count * _FIXED[self.unit] if self.unit in _FIXED else None

    @property
    def months(self) -> int | None:
        return self.count * _MONTHS[self.unit] if self.unit in _MONTHS else None


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def plus_micros(ts: Column, n: Column) -> Column:
    return ts + F.expr("INTERVAL '0.000001' SECOND") * n


def truncate_seconds(ts: Column) -> Column:
    return plus_micros(ts, -F.pmod(micros(ts), F.lit(1_000_000)))


def time_bucket(ts: Column, level: str | Duration) -> Column:
    """Start of the window that holds ``ts``: epoch-aligned, weeks from Monday, calendar units from their first day."""
    size = Duration.of(level)
    if size.unit == "w" or size.unit in _CALENDAR:
        if size.count != 1:
            raise ValueError(f"only single weeks, months, quarters and years can be buckets, not {level!r}")
        start = F.date_trunc("week" if size.unit == "w" else _CALENDAR[size.unit], ts.cast("timestamp"))
        return plus_micros(ts, micros(start) - micros(ts))
    return plus_micros(ts, -F.pmod(micros(ts), F.lit(size.micros)))


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end, cut toward zero, as a double."""
    return ((micros(end) - micros(start)) / 1_000_000).cast("bigint").cast("double")


def parse_time(text: Column, zone: str = "convert") -> Column:
    """Text to ``timestamp_ntz`` in UTC at whole seconds (fractions are cut); null where it is no full date.

    ``zone="convert"`` moves a time with an offset to UTC; ``zone="wall"`` keeps its wall clock.
    """
    if zone not in ("convert", "wall"):
        raise ValueError(f"zone must be 'convert' or 'wall', not {zone!r}")
    trimmed = F.btrim(text)
    # A bare cast would read '12:30' and 'today' as the current date, so only full dates get there.
    full_date = trimmed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}")
    kind = "timestamp" if zone == "convert" else "timestamp_ntz"
    parsed = F.when(full_date, trimmed.try_cast(kind).cast("timestamp")).when(
        trimmed.rlike(r"^\d{8}$"), F.try_to_timestamp(trimmed, F.lit("yyyyMMdd"))
    )
    return F.date_trunc("second", parsed).cast("timestamp_ntz")


def format_time(ts: Column) -> Column:
    return F.date_format(ts, ISO_Z)


def normalize_time_text(text: Column, zone: str = "convert", keep_unparsable: bool = True) -> Column:
    """Text to ISO text ending in ``Z``. Blank becomes null; other unreadable text is kept or becomes null."""
    iso = format_time(parse_time(text, zone))
    if not keep_unparsable:
        return iso
    return F.coalesce(iso, F.nullif(F.btrim(text), F.lit("")))


def parse_bound(text: str | datetime | None, end: bool = False) -> datetime | None:
    """One end of a configured range. A bare date covers its whole day; placeholder or unreadable text is no bound."""
    if text is None or isinstance(text, datetime):
        return text
    text = text.strip()
    if not text or text == NO_BOUND:
        return None
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        text += "T23:59:59" if end else "T00:00:00"
    try:
        return datetime.fromisoformat(text.removesuffix("Z")).replace(tzinfo=None)
    except ValueError:
        return None


def time_literal(value: datetime, ltz: bool = False) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp" if ltz else "timestamp_ntz")
