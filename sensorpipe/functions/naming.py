"""What a file name or path says about its rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(file_name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", "")


def substitute(name: Column, replacements: Sequence[Mapping[str, str]]) -> Column:
    """Apply ``[{"src": ..., "target": ...}, ...]`` one after the other."""
    for item in replacements:
        if item.get("src"):
            name = F.replace(name, F.lit(item["src"]), F.lit(item.get("target") or ""))
    return name


def name_part(stem_col: Column, index: int, at_least: int) -> Column:
    """The ``_``-separated part at ``index``, null when the name has fewer than ``at_least`` parts."""
    parts = F.split(stem_col, "_")
    return F.when(F.size(parts) >= at_least, F.get(parts, F.lit(index)))


def device_of(stem_col: Column, pattern: str | None = None) -> Column:
    if pattern:
        return F.nullif(F.regexp_extract(stem_col, pattern, 1), F.lit(""))
    return name_part(stem_col, 1, 2)


def experience_of(stem_col: Column) -> Column:
    return name_part(stem_col, 0, 3)


def day_of(stem_col: Column) -> Column:
    """First ``_``-separated part that is a date."""
    dates = F.transform(
        F.split(stem_col, "_"),
        lambda p: F.when(p.rlike(r"^\d{1,4}-\d{1,2}-\d{1,4}$") & (F.length(p) == 10), p.try_cast("date")),
    )
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))


def closing_date_of(stem_col: Column) -> Column:
    """The date that ends the name after an underscore, null when there is none."""
    return F.nullif(F.regexp_extract(stem_col, r"^.*_(\d{4}-\d{2}-\d{2})$", 1), F.lit("")).try_cast("date")


def partition_value(path: Column, key: str) -> Column:
    """Value of the ``key=`` folder nearest to the file."""
    return F.nullif(F.regexp_extract(path, rf"^.*/{key}=([^/]*)/", 1), F.lit(""))


def aggregation_level_of(stem_col: Column) -> Column:
    """``10s`` out of ``..._agg10s_...``; seconds are looked for first, then minutes, hours, days."""
    found = [
        F.nullif(F.regexp_extract(stem_col, rf"(?i)_agg(\d+){unit}_", 1), F.lit("")) for unit in ("s", "m", "h", "d")
    ]
    return F.coalesce(*[F.concat(n, F.lit(unit)) for n, unit in zip(found, ("s", "m", "h", "d"))])
