"""Coordinate quality checks; every summary is one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geohash import valid_coordinates


def _pct(part: Column, total: Column) -> Column:
    # try_divide: an empty input gives NULL instead of a division error
    return F.round(F.try_divide(part.cast("double") * 100, total), 1)


def is_valid(lat: str = "lat", lng: str = "lng") -> Column:
    """Both present and inside the inclusive world bounds; never NULL."""
    return F.coalesce(valid_coordinates(lat, lng), F.lit(False))


def is_null(lat: str = "lat", lng: str = "lng") -> Column:
    return F.col(lat).isNull() | F.col(lng).isNull()


def is_invalid(lat: str = "lat", lng: str = "lng") -> Column:
    """Both present but at least one out of range (NaN counts as out of range)."""
    return ~is_null(lat, lng) & ~is_valid(lat, lng)


# The filters below use the bare range predicates (a NULL result drops the row
# in WHERE anyway): wrapped in coalesce(..., false) they would not reach the
# Parquet reader as pushed filters.

def null_or_invalid(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows needing repair: a null coordinate or one outside the bounds."""
    return df.where(is_null(lat, lng) | ~valid_coordinates(lat, lng))


def null_only(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    return df.where(is_null(lat, lng))


def invalid_only(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull() & ~valid_coordinates(lat, lng))


def valid_only(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    return df.where(valid_coordinates(lat, lng))


def quality_summary(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """total, valid, null, invalid and their percentages (1 decimal) in one pass."""
    s = df.agg(F.count(F.lit(1)).alias("total_records"),
               F.count_if(is_valid(lat, lng)).alias("valid_records"),
               F.count_if(is_null(lat, lng)).alias("null_records"),
               F.count_if(is_invalid(lat, lng)).alias("invalid_records"))
    t = F.col("total_records")
    return s.select("*", _pct(F.col("valid_records"), t).alias("valid_pct"),
                    _pct(F.col("null_records"), t).alias("null_pct"),
                    _pct(F.col("invalid_records"), t).alias("invalid_pct"))


def null_count_stats(df: DataFrame, column: str) -> DataFrame:
    """count(*), count(column) and the rows where it is NULL."""
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count(column).alias(f"records_with_{column}"),
                  (F.count(F.lit(1)) - F.count(column)).alias(f"records_without_{column}"))


def distinct_count_with_null(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """Number of distinct values counting NULL as one value (like ``distinct().count()``).

    One aggregation; ``approx=True`` uses HyperLogLog++ for very large domains.
    """
    d = F.approx_count_distinct(column) if approx else F.countDistinct(column)
    has_null = F.max(F.when(F.col(column).isNull(), 1).otherwise(0))
    return df.agg((d + has_null).cast("long").alias(f"distinct_{column}"))


def describe_columns(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Typed ``describe()``: one row per column with count, mean, stddev, min, max.

    All columns are summarised in a single aggregation, then unpivoted.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"{c}__count"), F.round(F.avg(x), digits).alias(f"{c}__mean"),
                 F.round(F.stddev_samp(x), digits).alias(f"{c}__stddev"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                              F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__stddev").alias("stddev"),
                              F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
                     for c in columns])
    return wide.select(F.inline(rows))


def remaining_nulls(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows still without a coordinate (after a fill)."""
    return df.agg(F.count_if(is_null(lat, lng)).alias("remaining_null_records"))
