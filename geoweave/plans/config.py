"""Job settings."""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class EnrichConfig:
    """Where to read and write, and how to enrich.

    ``observations_path`` is required (one setting, no competing defaults).
    """

    places_path: str
    observations_path: str
    output_path: str
    places_format: str = "csv"  # csv (header) or parquet
    geohash_precision: int = 4
    dedupe: str = "avg"  # avg: average temperatures; first: first value of every column
    order_key: str = "event_id"
    fill_coordinates: bool = True
    lookup_path: str | None = None  # persisted (city, country, lookup_lat, lookup_lng) table
    attempts_path: str | None = None  # questions asked of a resolver; what had no answer is asked again after retry_days
    retry_days: float = 30.0
    state_path: str | None = None  # per-cell state: a run reads only the observation files that came since the last one
    observations_table: str | None = None  # catalog table (e.g. bucketed by cell) instead of the path
    fill_from_places: bool = False  # without a lookup: use the mean of a city's known places
    repair_invalid: bool = False
    partition_columns: tuple = ("country",)
    write_mode: str = "overwrite"
    run_id: str | None = None  # append the output as this run; the same id again replaces it
    max_records_per_file: int | None = None  # bound output file size
    app_name: str = "geoweave-enrich"


def from_base(base: str, **kw) -> EnrichConfig:
    """Conventional layout under one base folder."""
    return EnrichConfig(places_path=os.path.join(base, "restaurant_csv"),
                        observations_path=os.path.join(base, "weather_parquet"),
                        output_path=os.path.join(base, "output", "enriched_data"), **kw)
