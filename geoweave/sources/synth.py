"""Synthetic observations around the places of a table.

The original generator loops on the driver, unseeded.  Here every place
with valid coordinates anchors ``per_place`` observations, fanned out with
``sequence`` + ``explode`` inside the tasks; all "random" values are taken
from the MD5 of (place id, draw number, salt), so they are independent of each
other, and a rerun or a retried task writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geohash import geohash, valid_coordinates

# Wind directions and weather conditions of the generator.
WIND_DIRECTIONS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
CONDITIONS = ["Sunny", "Cloudy", "Rainy", "Partly Cloudy", "Foggy", "Snowy", "Windy"]


def _draw(key: Column, i: Column, salt: int, modulus: int) -> Column:
    """Deterministic integer in [0, modulus): 32 bits of the MD5 of (key, i, salt)."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), i.cast("string"), F.lit(str(salt))).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(modulus))


def _uniform(key: Column, i: Column, salt: int, lo: float, hi: float, steps: int = 10000) -> Column:
    return F.lit(lo) + _draw(key, i, salt, steps + 1).cast("double") * F.lit((hi - lo) / steps)


def _numbered(rows: DataFrame, buckets: int = 1024) -> DataFrame:
    """Adds ``_number`` (gapless from 1) and ``_places`` (how many rows there are).

    Rows are numbered inside hash buckets and shifted by the counts of the
    buckets before; the table of counts has at most ``buckets`` rows.  Rows that
    agree in every column are interchangeable, so a retried task changes nothing.
    """
    from ..operators.sizing import broadcast_if_bounded
    cols = rows.columns
    b = rows.withColumn("_bucket", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_bucket")  # over at most ``buckets`` rows
    counts = counts.select(F.col("_bucket").alias("_b"), (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
                           F.sum("_n").over(Window.partitionBy()).alias("_places"))
    ranked = b.withColumn("_nth", F.row_number().over(Window.partitionBy("_bucket").orderBy(*cols)))
    return ranked.join(broadcast_if_bounded(counts, buckets), F.col("_bucket") == F.col("_b")) \
        .select(*cols, "_places", (F.col("_before") + F.col("_nth")).alias("_number"))


def synth_observations(places: DataFrame, per_place: int = 4, seed: int = 0, precision: int = 4,
                       jitter_deg: float = 0.1, start_date: str = "2024-01-01", days: int = 366,
                       records: int | None = None) -> DataFrame:
    """``per_place`` jittered weather rows per valid place, in the generator's schema.

    With ``records`` exactly that many rows, dealt evenly: every place gets
    the same number and some places, numbered first by a hash of the row, one
    more (no rows without a valid place).  Places are counted and numbered
    inside the plan, bucket by bucket; no job runs while it is built.
    """
    base = places.where(valid_coordinates("lat", "lng")).select("id", "lat", "lng", "city", "country")
    if records is None:
        wanted = F.lit(per_place)
    else:
        base = _numbered(base)
        wanted = F.expr(f"{records}L div _places") + (F.col("_number") <= F.lit(records) % F.col("_places")).cast("int")
    draws = base.withColumn("_draws", wanted.cast("int")).where("_draws > 0") \
        .select("id", "lat", "lng", "city", "country", F.explode(F.sequence(F.lit(1), F.col("_draws"))).alias("draw"))
    k, i = F.col("id"), F.col("draw")
    s = seed * 31
    lat = F.least(F.greatest(F.col("lat") + _uniform(k, i, s + 1, -jitter_deg, jitter_deg), F.lit(-90.0)), F.lit(90.0))
    lng = F.least(F.greatest(F.col("lng") + _uniform(k, i, s + 2, -jitter_deg, jitter_deg), F.lit(-180.0)), F.lit(180.0))
    wind = F.array(*[F.lit(x) for x in WIND_DIRECTIONS])
    cond = F.array(*[F.lit(x) for x in CONDITIONS])
    out = draws.select(
        F.round(lat, 6).alias("lat"), F.round(lng, 6).alias("lng"),
        F.round(_uniform(k, i, s + 3, -10.0, 35.0, 450), 1).alias("temperature_c"),
        (F.lit(20) + _draw(k, i, s + 4, 81)).cast("int").alias("humidity_pct"),
        F.round(_uniform(k, i, s + 5, 980.0, 1030.0, 500), 1).alias("pressure_mb"),
        F.round(_uniform(k, i, s + 6, 0.0, 50.0, 500), 1).alias("wind_speed_kmh"),
        F.element_at(wind, (_draw(k, i, s + 7, len(WIND_DIRECTIONS)) + 1).cast("int")).alias("wind_direction"),
        F.element_at(cond, (_draw(k, i, s + 8, len(CONDITIONS)) + 1).cast("int")).alias("condition"),
        F.date_format(F.date_add(F.to_date(F.lit(start_date)), _draw(k, i, s + 9, days).cast("int")),
                      "yyyy-MM-dd").alias("observation_date"),
        "city", "country",
    )
    return out.withColumn("geohash", geohash("lat", "lng", precision)).select(
        "lat", "lng", "geohash", "temperature_c", "humidity_pct", "pressure_mb", "wind_speed_kmh",
        "wind_direction", "condition", "observation_date", "city", "country")
