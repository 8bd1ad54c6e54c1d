"""Coordinate lookup, fill, JSON extraction and the resolver path (stub, never a network call)."""

import pandas as pd
from pyspark.sql import functions as F

from geoweave import schemas
from geoweave.operators import lookup as lk


def test_lookup_keys_dedupe_and_skip(spark):
    rows = [(1, "Porto", "PT", None), (2, "Porto", "PT", None), (3, "Utrecht", "NL", None),
            (4, None, "PT", None), (5, "Utrecht", None, None), (6, "", "NL", None), (7, "Odense", "DK", 1.0)]
    df = spark.createDataFrame(rows, "id int, city string, country string, lat double") \
        .withColumn("lng", F.col("lat"))
    keys = {(r.city, r.country, r.query) for r in lk.lookup_keys(df).collect()}
    assert keys == {("Porto", "PT", "Porto, PT"), ("Utrecht", "NL", "Utrecht, NL")}


def test_fill_coordinates_per_column(spark, places):
    lookup = spark.createDataFrame([("Evora", "PT", 38.57, -7.91), ("Aarhus", "DK", 56.16, 10.2)],
                                   schemas.LOOKUP)
    got = {r.id: (r.lat, r.lng) for r in lk.fill_coordinates(places, lookup).collect()}
    assert got[4] == (38.57, -7.91)
    assert got[5] == (95.5, 10.2)  # out-of-range value is kept by default
    got2 = {r.id: (r.lat, r.lng) for r in lk.fill_coordinates(places, lookup, repair_invalid=True).collect()}
    assert got2[5] == (56.16, 10.2)
    assert got[1] == (41.15, -8.61)


def test_coords_from_json(spark):
    df = spark.createDataFrame([('{"results":[{"geometry":{"lat":41.15,"lng":-8.61}}]}',),
                                ('{"results":[]}',), ("not json",)], "body string")
    r = df.select(lk.coords_from_json("body").alias("c")).collect()
    assert (r[0].c.lat, r[0].c.lng) == (41.15, -8.61)
    assert (r[1].c.lat, r[1].c.lng) == (None, None)
    assert (r[2].c.lat, r[2].c.lng) == (None, None)


def test_resolver_runs_only_for_unknown_keys(spark, tmp_path):
    keys = spark.createDataFrame([("Porto", "PT"), ("Utrecht", "NL")], "city string, country string")
    known = spark.createDataFrame([("Utrecht", "NL", 52.09, 5.12)], schemas.LOOKUP)

    def stub(pdf: pd.DataFrame) -> pd.DataFrame:
        assert set(pdf.city) == {"Porto"}  # Utrecht is already known
        return pdf.assign(lookup_lat=41.15, lookup_lng=-8.6)

    new = lk.resolve_missing(keys, known, stub, batch_partitions=2)
    rows = new.collect()
    assert [(r.city, r.lookup_lat) for r in rows] == [("Porto", 41.15)]
    # persisted: a rerun against the extended table calls nothing
    path = str(tmp_path / "lookup")
    known.unionByName(new).write.parquet(path)
    table = spark.read.parquet(path)

    def never(pdf):
        raise AssertionError("resolver must not be called")

    assert lk.resolve_missing(keys, table, never).count() == 0


def test_lookup_from_places_uses_valid_rows(places):
    got = {(r.city, r.country): (r.lookup_lat, r.lookup_lng) for r in lk.lookup_from_places(places).collect()}
    assert ("Aarhus", "DK") not in got and ("Evora", "PT") not in got
    assert got[("Utrecht", "NL")] == (52.09, 5.12)


def test_resolver_errors_fail_unless_asked(spark):
    import pytest
    keys = spark.createDataFrame([("Atlantis", "XX")], "city string, country string")

    def down(pdf):
        raise ConnectionError("service down")

    def bug(pdf):
        raise KeyError("a bug, not a failed request")

    with pytest.raises(Exception):
        lk.resolve_missing(keys, None, down).collect()
    rows = lk.resolve_missing(keys, None, down, on_error="null").collect()
    assert [(r.city, r.lookup_lat, r.lookup_lng) for r in rows] == [("Atlantis", None, None)]
    with pytest.raises(Exception):
        lk.resolve_missing(keys, None, bug, on_error="null").collect()


def test_duplicate_lookup_keys_keep_the_row_count(spark, places):
    rows = [("Evora", "PT", 38.57, -7.91), ("Evora", "PT", 38.57, -7.95), ("Evora", "PT", 39.0, -9.0), ("Evora", "PT", None, 1.0)]
    out = lk.fill_coordinates(places, spark.createDataFrame(rows, schemas.LOOKUP)).collect()
    assert len(out) == 5 and [(r.lat, r.lng) for r in out if r.id == 4] == [(38.57, -7.95)]


def test_lookup_step_resolves_appends_and_asks_once(spark, places, places_csv, obs_real_shape, tmp_path):
    from geoweave.plans.config import EnrichConfig
    from geoweave.plans.runner import run
    cfg = EnrichConfig(places_path=places_csv, observations_path="unused", output_path=str(tmp_path / "o"),
                       lookup_path=str(tmp_path / "lookup"))

    def stub(pdf: pd.DataFrame) -> pd.DataFrame:
        assert list(pdf.city) == ["Evora"]
        return pdf.assign(lookup_lat=38.57, lookup_lng=-7.91)

    def never(pdf):
        raise AssertionError("known keys must not be asked again")

    first = run(spark, cfg, observations=obs_real_shape, resolver=stub)
    assert first.output.where("id = 4").first().lat == 38.57 and first.metrics["matched"] == 4
    again = run(spark, cfg, observations=obs_real_shape, resolver=never)
    assert again.output.where("id = 4").first().lat == 38.57
    assert spark.read.parquet(cfg.lookup_path).count() == 1
