"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(frame: DataFrame, *keep: str, **item: Column) -> DataFrame:
    """``keep`` and one row per element of the array given as ``name=array``.

    For a plain ``explode`` Spark adds a test for empty arrays below whatever computed
    the array, which works the texts through twice. The outer form has no such test; the
    rows it makes of empty arrays are dropped here. Elements must not be null.
    """
    [(name, array)] = item.items()
    rows = frame.select(*keep, array.alias(name)).withColumn(name, F.explode_outer(name))
    return rows.where(F.col(name).isNotNull())


def listed(frame: DataFrame, *keep: str, **item: Column) -> DataFrame:
    """``keep``, the ``place`` and one row per element of a parsed list ``name=array``.

    A list that could not be parsed gives one row with ``unread`` true; an empty one none.
    """
    [(name, array)] = item.items()
    parsed = frame.select(*keep, array.alias(name))
    rows = parsed.select(*keep, F.col(name).isNull().alias("unread"), F.posexplode_outer(name).alias("place", name))
    return rows.where(F.col("unread") | F.col("place").isNotNull())
