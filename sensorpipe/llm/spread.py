"""Attach per-key values to rows without gathering the rows of a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorpipe.session import staged

SALTS = 64
#: A frame of at most so many rows (of a few hundred bytes each) may be broadcast, once it has been counted.
BROADCAST_ROWS = 20_000


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], by: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``df`` with ``per_key``, which has one row per key; keys are not null.

    ``by`` differs between rows of a key. Rows of a key are dealt over ``salts`` tasks; ``per_key`` is copied only to
    those pairs of key and salt that occur. ``df`` is read twice, so it should be staged or cheap.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    there = salted.select(*keys, "_salt").distinct().join(per_key, list(keys))
    return salted.join(there, [*keys, "_salt"], how).drop("_salt")


def attach_small(df: DataFrame, per_key: DataFrame, keys: Sequence[str], by: Column, how: str = "inner") -> DataFrame:
    """As ``attach``; a staged ``per_key`` that a count shows to be small is broadcast instead."""
    if per_key.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(per_key), list(keys), how)
    return attach(df, per_key, keys, by, how)


#: Row numbers (eight bytes each) that may be broadcast, once they have been counted.
BROADCAST_NUMBERS = 500_000


def free_name(docs: DataFrame) -> str:
    """A name for a column of row numbers that no column of ``docs`` has."""
    name, taken = "_row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written once with the number of each row as a column, and the name of that column.

    A number that is computed anew may follow other file splits, as these depend on how many executors there are.
    """
    number = free_name(docs)
    return staged(docs.withColumn(number, F.monotonically_increasing_id()), compression="zstd"), number


def without(docs: DataFrame, dropped: DataFrame, number: str | None = None) -> DataFrame:
    """The rows of ``docs`` but those whose number is in ``dropped`` (row); all columns but the number stay.

    ``number`` is the column that ``numbered`` stored. Without it rows are counted anew, which is right only while the
    same files are split in the same way as when ``dropped`` was found.
    """
    if number is None:
        number = free_name(docs)
        docs = docs.withColumn(number, F.monotonically_increasing_id())
    gone = staged(dropped.select(F.col("row").alias(number)))
    if gone.limit(BROADCAST_NUMBERS + 1).count() <= BROADCAST_NUMBERS:
        gone = F.broadcast(gone)
    return docs.join(gone, number, "left_anti").select(*[c for c in docs.columns if c != number])
