"""Run reports as DataFrames (one aggregation each, no driver loops)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geohash import cell_to_geohash
from ..operators import enrich as en
from ..operators.quality import is_invalid, is_null


def has_match(enriched: DataFrame, prefix: str = "weather_") -> Column:
    """Whether an observation was joined: some observation column came through.

    An observation that has a cell has coordinates, so this is "the place's
    cell holds an observation", also where all its temperatures are NULL.
    """
    hit = F.lit(False)
    for c in enriched.columns:
        if c.startswith(prefix):
            hit = hit | F.col(c).isNotNull()
    return hit


def join_stats(enriched: DataFrame) -> DataFrame:
    """total, matched (see :func:`has_match`), unmatched, matched_pct."""
    m = has_match(enriched)
    s = enriched.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(m).alias("matched_records"),
                     F.count_if(~m).alias("unmatched_records"))
    return s.withColumn("matched_pct", F.round(F.try_divide(F.col("matched_records") * 100.0,
                                                            F.col("total_records")), 1))


def matched(enriched: DataFrame) -> DataFrame:
    return enriched.where(has_match(enriched))


def unmatched(enriched: DataFrame) -> DataFrame:
    return enriched.where(~has_match(enriched))


def cells_with_text(df: DataFrame, precision: int = 4) -> DataFrame:
    """Distinct cells of a frame (NULL cell kept as a value), with geohash text."""
    c = en.add_cell(df, precision).select(en.CELL).distinct()
    return c.select(en.CELL, cell_to_geohash(en.CELL, precision).alias("geohash"))


def dedupe_ratio(observations: DataFrame, precision: int = 4) -> DataFrame:
    """Observation rows with a cell before the reduction, and cells after it."""
    c = en.add_cell(observations, precision).where(F.col(en.CELL).isNotNull())
    return c.agg(F.count(F.lit(1)).alias("rows_before"), F.countDistinct(en.CELL).alias("rows_after"))


def top_cells(df: DataFrame, k: int = 10, precision: int = 4) -> DataFrame:
    """The k geohashes with most rows (ties by geohash), NULL geohash included as a group."""
    g = en.add_cell(df, precision).groupBy(en.CELL).agg(F.count(F.lit(1)).alias("count"))
    g = g.select(cell_to_geohash(en.CELL, precision).alias("geohash"), "count")
    return g.orderBy(F.col("count").desc(), F.col("geohash").asc_nulls_first()).limit(k)


def date_range(df: DataFrame, column: str = "wthr_date") -> DataFrame:
    """Earliest and latest value of a date column as it is stored (text compares as text)."""
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def cell_counts(df: DataFrame, precision: int = 4, extra: dict | None = None) -> DataFrame:
    """Rows per cell (the NULL cell is one group), plus optional extra aggregates.

    At most ``32 ** precision + 1`` rows whatever the input size; a hot cell
    is combined map-side.
    """
    aggs = [F.count(F.lit(1)).alias("n")] + [v.alias(k) for k, v in (extra or {}).items()]
    return en.add_cell(df, precision).groupBy(en.CELL).agg(*aggs)


def matching_cells(places: DataFrame, observations: DataFrame, precision: int = 4) -> DataFrame:
    """Geohashes present on both sides (set intersection on the bigint cell; NULL is a member).

    Both sides are reduced to their distinct cells (at most ``32**precision +
    1`` rows, combined map-side) before anything is joined.
    """
    a = en.add_cell(places, precision).select(en.CELL).distinct()
    b = en.add_cell(observations, precision).select(F.col(en.CELL).alias("_other")).distinct()
    return a.join(b, F.col(en.CELL).eqNullSafe(F.col("_other")), "left_semi").select(cell_to_geohash(en.CELL, precision).alias("geohash"))


def run_summary(places: DataFrame, observations: DataFrame, precision: int = 4) -> DataFrame:
    """The run report in long form: (metric, value).

    Each source is scanned once into per-cell counts (at most 32**precision
    rows each); a full outer join of the two on the cell (co-partitioned by
    the aggregations, so no further shuffle) and one aggregation give every
    figure.  Distinct geohash counts count the NULL geohash as a
    value and it matches itself in the overlap (set semantics), but a place
    without a cell never counts as enriched.
    """
    pc = cell_counts(places, precision, {"nulls": F.count_if(is_null()), "invalid": F.count_if(is_invalid())})
    oc = cell_counts(observations, precision).withColumnRenamed("n", "obs_n")
    # plain equality keeps the aggregations' hash partitioning (a null-safe key
    # would re-shuffle both sides); the NULL cell, which never joins, is
    # matched by hand below
    j = pc.join(oc, en.CELL, "full_outer")
    both = F.col("n").isNotNull() & F.col("obs_n").isNotNull()
    null_cell = F.col(en.CELL).isNull()
    null_on_both = (F.max(F.when(null_cell & F.col("n").isNotNull(), 1).otherwise(0)) *
                    F.max(F.when(null_cell & F.col("obs_n").isNotNull(), 1).otherwise(0)))
    matched = F.coalesce(F.sum(F.when(both, F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    figures = [
        ("places_total", total),
        ("observations_total", F.coalesce(F.sum("obs_n"), F.lit(0))),
        ("null_coordinates", F.coalesce(F.sum("nulls"), F.lit(0))),
        ("invalid_coordinates", F.coalesce(F.sum("invalid"), F.lit(0))),
        ("place_geohashes", F.count("n")),
        ("observation_geohashes", F.count("obs_n")),
        ("matching_geohashes", F.count_if(both) + null_on_both),
        ("enriched_total", total),
        ("matched", matched),
        ("unmatched", total - matched),
    ]
    row = j.agg(*[v.cast("long").alias(k) for k, v in figures])
    stacked = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k, _ in figures])
    return row.select(F.inline(stacked))
