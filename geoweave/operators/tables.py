"""Everyday table operations: grouped counts, range projections, top-k, head."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, keys, alias: str = "count", order: bool = False,
                tie_keys: bool = True) -> DataFrame:
    """``GROUP BY keys`` with ``count(*)``; optionally ordered by the count, desc.

    Ties are broken by the keys so the order is total.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    if order:
        out = out.orderBy(F.col(alias).desc(), *([F.col(k).asc_nulls_first() for k in keys] if tie_keys else []))
    return out


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def project_range_top(df: DataFrame, columns: list[str], key: str, lo, hi, order: list[Column],
                      k: int) -> DataFrame:
    """``SELECT cols WHERE key BETWEEN lo AND hi ORDER BY ... LIMIT k`` (inclusive bounds)."""
    return df.where(F.col(key).between(lo, hi)).select(*columns).orderBy(*order).limit(k)


def head(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """``n`` rows; with ``order`` they are the first n of that order (deterministic)."""
    return (df.orderBy(*order) if order else df).limit(n)


def grouped_count_avg(df: DataFrame, key: str, value: str, count_alias: str = "record_count",
                      avg_alias: str = "avg_value", digits: int | None = 6) -> DataFrame:
    """count and average per key, ordered by the count desc then key."""
    avg = F.avg(value)
    if digits is not None:
        avg = F.round(avg, digits)
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_alias), avg.alias(avg_alias))
            .orderBy(F.col(count_alias).desc(), F.col(key)))
