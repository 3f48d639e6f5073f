"""Sensor time series on Spark: parse, clean, reshape, resample, aggregate and publish.

Every operator is a function ``f(df, ...) -> DataFrame`` made of Spark SQL expressions and can be
used with ``df.transform``. Times are compared in UTC, so the session time zone must be UTC.
"""
