"""The full enrichment job: read -> check -> fill -> geohash -> reduce + join -> write.

All steps are ``DataFrame -> DataFrame`` functions chained into one plan;
the write is the only full action, and its figures (rows, matched rows)
come from ``observe`` on that same job instead of extra counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import enrich as en
from ..operators import lookup as lk
from ..operators.quality import is_valid
from ..operators.state import CellState
from ..sinks.files import append_run, write_partitioned
from ..sources import files as src
from . import report as rp
from .config import EnrichConfig


@dataclass
class RunResult:
    output: DataFrame  # the written table, read back
    weather_joined: bool  # False when the observations path does not exist
    metrics: dict


def read_places(spark: SparkSession, cfg: EnrichConfig) -> DataFrame:
    if cfg.places_format == "csv":
        return src.read_places(spark, cfg.places_path)
    return src.cast_columns(spark.read.format(cfg.places_format).load(cfg.places_path), schemas.PLACES)


def _is_missing_path(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (e.getCondition() or "") or "Path does not exist" in str(e)


def prepare_places(spark: SparkSession, places: DataFrame, cfg: EnrichConfig, lookup: DataFrame | None = None,
                   resolver=None) -> DataFrame:
    """Coordinate fill (if enabled) from the lookup table; without one, places stay as they are.

    With a ``resolver`` and a ``lookup_path``, keys that the table does not
    hold are resolved and appended to it first (see ``lookup.extend_lookup``).
    City means stand in for a lookup only if ``fill_from_places`` asks for it.
    """
    if not cfg.fill_coordinates:
        return places
    if lookup is None and cfg.lookup_path:
        if resolver is not None:
            lookup = lk.extend_lookup(spark, lk.lookup_keys(places), cfg.lookup_path, resolver, attempts_path=cfg.attempts_path,
                                      retry_after=timedelta(days=cfg.retry_days))
        else:
            lookup = spark.read.schema(schemas.LOOKUP).parquet(cfg.lookup_path)
    if lookup is None and cfg.fill_from_places:
        lookup = lk.lookup_from_places(places)
    return places if lookup is None else lk.fill_coordinates(places, lookup, repair_invalid=cfg.repair_invalid)


def build(spark: SparkSession, cfg: EnrichConfig, places: DataFrame | None = None,
          observations: DataFrame | None = None, lookup: DataFrame | None = None,
          resolver=None) -> tuple[DataFrame, bool]:
    """The enriched plan (lazy) and whether observations were found."""
    places = places if places is not None else read_places(spark, cfg)
    places = prepare_places(spark, places, cfg, lookup, resolver)
    if observations is None and cfg.state_path:
        return _from_state(spark, cfg, places)
    if observations is None and cfg.observations_table:
        observations = spark.table(cfg.observations_table)  # keeps a bucket spec
    if observations is None:
        try:
            observations = src.read_observations(spark, cfg.observations_path)
        except AnalysisException as e:  # only a missing path degrades; other errors surface
            if not _is_missing_path(e):
                raise
            return en.add_geohash(places, cfg.geohash_precision), False
    out = en.enrich(places, observations, precision=cfg.geohash_precision, order_key=cfg.order_key,
                    mode=cfg.dedupe)
    return out, True


def _from_state(spark: SparkSession, cfg: EnrichConfig, places: DataFrame) -> tuple[DataFrame, bool]:
    """Enrich from the stored per-cell state, after the new observation files have gone into it."""
    if cfg.dedupe != "avg" or cfg.observations_table:
        raise ValueError("a state holds averages of the files under observations_path (dedupe='avg', no table)")
    state = CellState(spark, cfg.state_path, cfg.geohash_precision, cfg.order_key)
    try:
        state.advance(cfg.observations_path)
    except AnalysisException as e:
        if not _is_missing_path(e):
            raise
        if state.content is None:
            return en.add_geohash(places, cfg.geohash_precision), False
    return en.join_cells(places, state.reduced(), cfg.geohash_precision), True


def run(spark: SparkSession, cfg: EnrichConfig, places: DataFrame | None = None,
        observations: DataFrame | None = None, lookup: DataFrame | None = None, resolver=None) -> RunResult:
    enriched, joined = build(spark, cfg, places, observations, lookup, resolver)
    obs = Observation("run")
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(is_valid()).alias("valid_coordinates")]
    if any(c.startswith("weather_") for c in enriched.columns):
        metrics.append(F.count_if(rp.has_match(enriched)).alias("matched"))
    if cfg.run_id is not None:
        append_run(enriched, cfg.output_path, cfg.run_id, cfg.partition_columns, max_records_per_file=cfg.max_records_per_file,
                   observe=(obs, metrics))
    else:
        write_partitioned(enriched, cfg.output_path, cfg.partition_columns, cfg.write_mode,
                          max_records_per_file=cfg.max_records_per_file, observe=(obs, metrics))
    out = spark.read.schema(enriched.schema).parquet(cfg.output_path)  # written types, also of partition values
    return RunResult(output=out.select(*enriched.columns), weather_joined=joined, metrics=dict(obs.get))
