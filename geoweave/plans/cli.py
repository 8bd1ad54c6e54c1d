"""Command-line job (``spark-submit -m geoweave.plans.cli`` or ``python -m``).

Flags follow the original job: --restaurant-path --weather-path
--output-path --no-geocode --generate-weather --weather-records.
"""

from __future__ import annotations

import argparse
import json

from ..session import get_session
from ..operators.enrich import bucket_observations
from ..sources.files import read_observations, read_places
from ..sources.synth import synth_observations
from .config import EnrichConfig
from .runner import build, run


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Enrich places with per-geohash observations")
    p.add_argument("--restaurant-path", required=True, help="places CSV (header)")
    p.add_argument("--weather-path", required=True, help="observations Parquet")
    p.add_argument("--weather-table", default=None,
                   help="read observations from this catalog table instead (e.g. bucketed by cell)")
    p.add_argument("--output-path", required=True, help="output Parquet, partitioned by country")
    p.add_argument("--no-geocode", action="store_true", help="skip the coordinate fill")
    p.add_argument("--lookup-path", default=None, help="persisted (city, country) coordinate table")
    p.add_argument("--fill-from-places", action="store_true",
                   help="without a lookup table: fill from the mean of a city's known places")
    p.add_argument("--repair-invalid", action="store_true",
                   help="also replace out-of-range coordinates from the lookup (default: only NULLs)")
    p.add_argument("--precision", type=int, default=4)
    p.add_argument("--dedupe", choices=["avg", "first"], default="avg")
    p.add_argument("--order-key", default="event_id")
    p.add_argument("--generate-weather", action="store_true",
                   help="write synthetic observations near the places to --weather-path first")
    p.add_argument("--weather-records", type=int, default=1000, help="this many synthetic rows")
    p.add_argument("--bucket-into", default=None,
                   help="first write the observations as a table bucketed by cell (then read from it)")
    p.add_argument("--bucket-path", default=None, help="storage path of the --bucket-into table")
    p.add_argument("--buckets", type=int, default=200, help="number of buckets for --bucket-into")
    p.add_argument("--state-path", default=None,
                   help="keep a per-cell state there, so that a run reads only new observation files")
    p.add_argument("--run-id", default=None, help="append the output as this run; the same id again replaces it")
    p.add_argument("--explain", action="store_true", help="print the formatted physical plan to stderr first")
    p.add_argument("--master", default=None)
    return p.parse_args(argv)


def main(argv=None) -> int:
    a = parse(argv)
    spark = get_session(a.master, "geoweave-enrich")
    if a.generate_weather:
        synth = synth_observations(read_places(spark, a.restaurant_path), records=a.weather_records,
                                   precision=a.precision)
        synth.write.mode("overwrite").parquet(a.weather_path)
    if a.bucket_into:
        if not a.bucket_path:
            raise SystemExit("--bucket-into needs --bucket-path")
        bucket_observations(read_observations(spark, a.weather_path), a.bucket_into, a.bucket_path,
                            precision=a.precision, buckets=a.buckets)
        a.weather_table = a.bucket_into
    cfg = EnrichConfig(places_path=a.restaurant_path, observations_path=a.weather_path,
                       output_path=a.output_path, fill_coordinates=not a.no_geocode,
                       lookup_path=a.lookup_path, fill_from_places=a.fill_from_places, repair_invalid=a.repair_invalid,
                       observations_table=a.weather_table, state_path=a.state_path, run_id=a.run_id,
                       geohash_precision=a.precision, dedupe=a.dedupe,
                       order_key=a.order_key)
    if a.explain:
        import contextlib
        import sys
        enriched, _ = build(spark, cfg)
        with contextlib.redirect_stdout(sys.stderr):
            enriched.explain("formatted")
    res = run(spark, cfg)
    print(json.dumps({"weather_joined": res.weather_joined, **{k: int(v) for k, v in res.metrics.items()}}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
