"""Geohash enrichment: reduce observations to one row per cell, left-join places.

Plan shape (checked with ``explain``)::

    observations scan (pruned columns)
      -> cell id (native expression) -> isnotnull(cell)        [R15]
      -> left-semi broadcast join with the distinct place cells [R8]
      -> partial HashAggregate(cell)                            map-side combine
      -> Exchange hashpartitioning(cell)                        only partials move
      -> final HashAggregate(cell)
    places -> cell id -> left join on the bigint cell           [R7]
              (per-cell table broadcast when its size is proven:
               32**precision rows of fixed-width values within the byte limit)

The distinct place cells are bounded by ``32 ** precision`` (about 1M at
precision 4), which is what licenses the broadcast; at finer precisions, and
for per-cell tables with text columns, adaptive execution decides from real
sizes.  A cell that holds a third of all observations is folded to one row
per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geohash import cell_id, cell_to_geohash, geohash_to_cell, valid_coordinates
from . import dedupe as dd
from .sizing import broadcast_if_bounded

CELL = "_cell"
SALT = "_salt"


def cell_column(precision: int) -> str:
    """Name of a stored cell id of this precision (see :func:`bucket_observations`)."""
    return f"_cell_p{precision}"


def add_cell(df: DataFrame, precision: int = 4, lat: str = "lat", lng: str = "lng",
             geohash_col: str = "geohash", fit: str = "exact") -> DataFrame:
    """Add the packed cell id.

    Reuses, in this order, a stored cell id of the same precision (a bucketed
    table keeps its bucketing through the alias), an existing geohash
    column, or computes it from lat / lng.  A stored geohash of another
    length than ``precision`` fails the job unless ``fit="prefix"``.
    """
    stored = cell_column(precision)
    if stored in df.columns:
        return df.withColumn(CELL, F.col(stored))
    if geohash_col in df.columns:
        return df.withColumn(CELL, geohash_to_cell(geohash_col, precision, fit))
    return df.withColumn(CELL, cell_id(lat, lng, precision))


def bucket_observations(observations: DataFrame, table: str, path: str, precision: int = 4,
                        buckets: int = 200, fmt: str = "parquet", salts: int = 1, salt_key: str = "event_id") -> DataFrame:
    """Store observations bucketed (and sorted) by their cell id, once.

    Every later reduction by cell on this table reads bucket by bucket with
    no shuffle: the one expensive exchange is paid at ingest, not on every
    enrichment run.  Rows are dealt to the buckets before the write, so there
    is one file per bucket.  Choose ``buckets`` from the data volume.

    With ``salts`` above 1 buckets have two levels, cell and a salt from the
    hash of ``salt_key`` (a column that tells the rows of a cell apart): a
    cell that holds a third of the rows is written by up to ``salts`` tasks
    into as many files.  A reduction then combines each file's rows to one
    partial row per cell, and only these are exchanged and merged.
    """
    from ..sinks.files import save_bucketed
    stored = cell_column(precision)
    with_cell = observations.withColumn(stored, cell_id("lat", "lng", precision))
    keys = [stored]
    if salts > 1:
        with_cell = with_cell.withColumn(SALT, F.pmod(F.xxhash64(salt_key), F.lit(salts)).cast("int"))
        keys.append(SALT)
    save_bucketed(with_cell, table, path, keys, buckets, fmt)
    return observations.sparkSession.table(table)


def add_geohash(df: DataFrame, precision: int = 4, lat: str = "lat", lng: str = "lng",
                out: str = "geohash") -> DataFrame:
    """Add the geohash text column unless the frame already has one."""
    if out in df.columns:
        return df
    return df.withColumn(out, cell_to_geohash(cell_id(lat, lng, precision), precision))


def _cell_from_coordinates(df: DataFrame, precision: int) -> bool:
    return cell_column(precision) not in df.columns and "geohash" not in df.columns


def place_cells(places: DataFrame, precision: int = 4) -> DataFrame:
    """Distinct non-null cells of the places (a set bounded by 32**precision)."""
    cols = [c for c in ("lat", "lng", "geohash", cell_column(precision)) if c in places.columns]
    src = places.select(*cols)
    if _cell_from_coordinates(src, precision):
        src = src.where(valid_coordinates("lat", "lng"))  # pushable range predicates
    return add_cell(src, precision).select(CELL).where(F.col(CELL).isNotNull()).distinct()


def content_order(observations: DataFrame, used: list[str], lead=("wthr_date", "observation_date", "lat", "lng")) -> list[str]:
    """A total order for rows without a unique key: date, latitude, longitude, then the other used columns.

    Rows that tie agree in every used column, so any of them gives the same
    result; only columns that are read anyway take part.
    """
    first = [c for c in lead if c in observations.columns]
    return [*first, *sorted(c for c in used if c not in first)]


def reduce_observations(observations: DataFrame, precision: int = 4, order_key: str = "event_id",
                        mode: str = "avg", avg_columns=("avg_tmpr_f", "avg_tmpr_c"),
                        first_columns=("lat", "lng", "wthr_date"), columns: list[str] | None = None,
                        prefix: str = "weather_", keep_cells: DataFrame | None = None) -> DataFrame:
    """One deterministic row per cell, keyed by ``_cell``.

    ``mode="avg"`` averages ``avg_columns`` and takes first values of
    ``first_columns``; ``mode="first"`` takes the first non-null value of
    every column (or of ``columns``).  ``keep_cells`` restricts the
    observations to those cells before aggregating (semi-join reduction).
    Without ``order_key`` in the data (the real weather shape has none),
    "first" follows :func:`content_order`.  Without the average columns,
    ``avg`` falls back to ``first``.
    """
    if mode not in ("avg", "first"):
        raise ValueError(f"mode must be 'avg' or 'first', got {mode!r}")
    if mode == "avg" and not set(avg_columns) <= set(observations.columns):
        mode = "first"  # another observation shape: first value of every column
    if mode == "avg":
        averages = list(avg_columns)
        firsts = [c for c in first_columns if c in observations.columns]  # optional in a shape
    else:
        averages = []
        firsts = columns if columns is not None else [
            c for c in observations.columns if c not in (order_key, "geohash", SALT) and not c.startswith("_cell_p")]
    if order_key is None or order_key not in observations.columns:
        order_key = content_order(observations, [*firsts, *averages])
    source = observations
    if _cell_from_coordinates(observations, precision):
        # plain range predicates reach the Parquet reader (row-group skipping); the
        # inferred isnotnull(cell) alone is rewritten into a form that is not pushed
        source = observations.where(valid_coordinates("lat", "lng"))
    obs = with_cell = add_cell(source, precision).where(F.col(CELL).isNotNull())
    if keep_cells is not None:
        obs = obs.join(broadcast_if_bounded(keep_cells, 32 ** precision), CELL, "left_semi")
    if mode == "avg":
        return dd.dedupe_avg(obs, CELL, order_key, averages, firsts, prefix, null_keys=False, max_keys=32 ** precision,
                             all_rows=with_cell)
    return dd.dedupe_first(obs, CELL, order_key, firsts, prefix, null_keys=False, max_keys=32 ** precision, all_rows=with_cell)


def enrich(places: DataFrame, observations: DataFrame, precision: int = 4, order_key: str = "event_id",
           mode: str = "avg", avg_columns=("avg_tmpr_f", "avg_tmpr_c"),
           first_columns=("lat", "lng", "wthr_date"), columns: list[str] | None = None,
           prefix: str = "weather_", reduce: bool = True) -> DataFrame:
    """Places left-joined with per-cell observations; row count = places row count.

    Output: all place columns, ``geohash`` and the prefixed observation
    columns.  A place without a valid coordinate keeps NULL weather.
    """
    keep = place_cells(places, precision) if reduce else None
    right = reduce_observations(observations, precision, order_key, mode, avg_columns, first_columns,
                                columns, prefix, keep_cells=keep)
    return join_cells(places, right, precision)


def join_cells(places: DataFrame, per_cell: DataFrame, precision: int = 4) -> DataFrame:
    """Places with their geohash, left-joined with a table of one row per ``_cell``."""
    left = add_cell(places, precision)
    if "geohash" not in places.columns:
        left = left.withColumn("geohash", cell_to_geohash(CELL, precision))
    # when its bytes are proven (32**precision rows of fixed-width values), broadcasting the
    # per-cell table means the (possibly huge) places side is never shuffled
    return left.join(broadcast_if_bounded(per_cell, 32 ** precision), CELL, "left").drop(CELL)
