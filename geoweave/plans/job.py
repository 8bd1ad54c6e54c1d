"""One object for the step-by-step use of the enrichment job.

Each method is one step of the job as a ``DataFrame -> DataFrame``
function bound to an :class:`EnrichConfig`; nothing runs until a write
or an action.  ``run()`` is the whole job (see ``plans.runner``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import enrich as en
from ..operators import quality as dq
from ..sinks.files import write_partitioned
from ..sources import files as src
from . import runner
from .config import EnrichConfig


class EnrichJob:
    def __init__(self, spark: SparkSession, cfg: EnrichConfig):
        self.spark, self.cfg = spark, cfg

    def read_places(self, path: str | None = None) -> DataFrame:
        """Places CSV (header, explicit schema)."""
        return src.read_places(self.spark, path or self.cfg.places_path)

    def read_observations(self, path: str | None = None) -> DataFrame:
        """Observations Parquet (partition directories become columns)."""
        return src.read_observations(self.spark, path or self.cfg.observations_path)

    def needs_repair(self, places: DataFrame) -> DataFrame:
        """Rows with a NULL or out-of-range coordinate."""
        return dq.null_or_invalid(places)

    def fill_coordinates(self, places: DataFrame, lookup: DataFrame | None = None, resolver=None) -> DataFrame:
        """Fill missing coordinates as the full job does (lookup table, resolver; else unchanged)."""
        return runner.prepare_places(self.spark, places, self.cfg, lookup, resolver)

    def add_geohash(self, df: DataFrame) -> DataFrame:
        """Geohash text column (kept if already present)."""
        return en.add_geohash(df, self.cfg.geohash_precision)

    def enrich(self, places: DataFrame, observations: DataFrame) -> DataFrame:
        """Per-cell observations left-joined onto the places (row count = places)."""
        return en.enrich(places, observations, precision=self.cfg.geohash_precision,
                         order_key=self.cfg.order_key, mode=self.cfg.dedupe)

    def write(self, df: DataFrame, path: str | None = None, mode: str | None = None) -> None:
        """Partitioned Parquet output."""
        write_partitioned(df, path or self.cfg.output_path, self.cfg.partition_columns,
                          mode or self.cfg.write_mode, max_records_per_file=self.cfg.max_records_per_file)

    def run(self, **kw) -> runner.RunResult:
        """The whole job: read, fill, geohash, reduce + join, write, read back."""
        return runner.run(self.spark, self.cfg, **kw)
