"""Row generators that do not trigger inferred filters.

An inner ``explode``/``posexplode`` makes the optimizer infer ``size(arr) > 0``
and push that filter below projections, exchanges and Python UDFs, where it
re-evaluates the whole expression that builds the array (for text pipelines:
the splitting, tokenizing and even the Arrow UDFs a second time).  The
``*_outer`` generators infer nothing; the null row they emit for an empty
array is dropped right above the generator instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def posexplode_rows(df: DataFrame, keep: list, arr, pos: str, val: str) -> DataFrame:
    """One row per element (with its 0-based position); empty/null arrays yield no row."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    out = df.select(*keep, F.posexplode_outer(arr).alias(pos, val))
    return out.where(F.col(pos).isNotNull())


def explode_rows(df: DataFrame, keep: list, arr, val: str) -> DataFrame:
    """One row per element, position dropped."""
    return posexplode_rows(df, keep, arr, "_pos", val).drop("_pos")
