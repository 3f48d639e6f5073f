"""Derived columns, by name. Register more with ``register``."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def log_positive(x: Column) -> Column:
    return F.when(x > 0, F.ln(x))


def sqrt_inverse(x: Column) -> Column:
    return F.when(x > 0, F.sqrt(F.lit(1.0) / x))


def celsius_to_fahrenheit(x: Column) -> Column:
    return x * (9.0 / 5.0) + 32.0


# Names used in configurations.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "log": log_positive,
    "sqrt_inv": sqrt_inverse,
    "celsius_to_fahrenheit": celsius_to_fahrenheit,
}


def register(name: str, function: Callable[[Column], Column]) -> None:
    TRANSFORMS[name] = function


def derive(df: DataFrame, columns: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Add ``{source: {output: transform}}`` columns in order; an output can feed a later source."""
    for source, outputs in columns.items():
        if source not in df.columns:
            log.warning("source column %s is absent", source)
            continue
        x = F.col(source)
        known = {out: TRANSFORMS[kind](x) for out, kind in outputs.items() if kind in TRANSFORMS}
        for out in outputs.keys() - known.keys():
            log.warning("unknown transform %s for %s", outputs[out], out)
        df = df.withColumns(known)
    return df


def gaussianise(df: DataFrame, exclude: Sequence[str] = ("Time",)) -> DataFrame:
    """sqrt(1/x) where x > 0, otherwise x, on every integer or floating column that is not excluded."""
    numeric = (T.IntegralType, T.FractionalType)
    columns = {
        f.name: F.when(F.col(f.name) > 0, F.sqrt(F.lit(1.0) / F.col(f.name))).otherwise(F.col(f.name).cast("double"))
        for f in df.schema.fields
        if isinstance(f.dataType, numeric) and not isinstance(f.dataType, T.DecimalType) and f.name not in exclude
    }
    return df.withColumns(columns)
