"""Fill missing coordinates from a (city, country) lookup table.

The original job calls a web geocoder in a driver loop, one request per
second.  Here the lookup is a table: known coordinates per (city,
country), optionally extended by a caller-supplied resolver that runs in
``mapInPandas`` over the keys not yet in the table (so reruns make no
calls), then a left join and ``coalesce``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from .quality import is_null, is_valid


def lookup_key_text(city: str = "city", country: str = "country") -> Column:
    """The geocoder query text ``"<city>, <country>"``."""
    return F.concat_ws(", ", F.col(city), F.col(country))


def has_key(city: str = "city", country: str = "country") -> Column:
    """Both key parts present and non-empty (null and '' are skipped)."""
    return (F.col(city).isNotNull() & (F.col(city) != "") &
            F.col(country).isNotNull() & (F.col(country) != ""))


def lookup_keys(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Distinct (city, country) of rows with a missing coordinate, plus query text."""
    return (df.where(is_null(lat, lng) & has_key()).select("city", "country").distinct()
            .withColumn("query", lookup_key_text()))


def lookup_from_places(places: DataFrame, digits: int = 6) -> DataFrame:
    """Known coordinates per (city, country): the mean of its valid places."""
    return (places.where(is_valid() & has_key()).groupBy("city", "country")
            .agg(F.round(F.avg("lat"), digits).alias("lookup_lat"),
                 F.round(F.avg("lng"), digits).alias("lookup_lng")))


def one_per_key(lookup: DataFrame) -> DataFrame:
    """One row per (city, country): its smallest known coordinate pair, so a repeated append changes nothing."""
    known = F.col("lookup_lat").isNotNull() & F.col("lookup_lng").isNotNull()
    # the pair stays together: the smallest latitude, then the smallest longitude on it
    lat = lookup.where(known).groupBy("city", "country").agg(F.min("lookup_lat").alias("lookup_lat"))
    return lookup.where(known).join(lat, ["city", "country", "lookup_lat"]) \
        .groupBy("city", "country", "lookup_lat").agg(F.min("lookup_lng").alias("lookup_lng")) \
        .select("city", "country", "lookup_lat", "lookup_lng")


def fill_coordinates(df: DataFrame, lookup: DataFrame, repair_invalid: bool = False) -> DataFrame:
    """Fill NULL lat / lng from ``lookup`` (columns city, country, lookup_lat, lookup_lng).

    Each coordinate is filled on its own (``coalesce``), as in the
    original job.  By default an out-of-range value is kept (original
    behaviour); ``repair_invalid=True`` nulls it first so it is filled too.
    The lookup is reduced to one row per key first, so the row count never
    changes; the optimizer and adaptive execution choose the join from sizes.
    """
    cols = df.columns
    base = df
    if repair_invalid:
        bad = ~is_valid()
        base = base.withColumn("lat", F.when(bad, None).otherwise(F.col("lat"))) \
                   .withColumn("lng", F.when(bad, None).otherwise(F.col("lng")))
    joined = base.join(one_per_key(lookup), ["city", "country"], "left")
    out = [F.coalesce(F.col("lat"), F.col("lookup_lat")).alias("lat") if c == "lat" else
           F.coalesce(F.col("lng"), F.col("lookup_lng")).alias("lng") if c == "lng" else F.col(c)
           for c in cols]
    return joined.select(*out)


def coords_from_json(body: str | Column) -> Column:
    """``results[0].geometry.{lat,lng}`` of a geocoder JSON body; NULLs when absent."""
    b = F.col(body) if isinstance(body, str) else body
    return F.struct(F.get_json_object(b, "$.results[0].geometry.lat").try_cast("double").alias("lat"),
                    F.get_json_object(b, "$.results[0].geometry.lng").try_cast("double").alias("lng"))


def resolve_missing(keys: DataFrame, lookup: DataFrame | None,
                    resolver: Callable[[pd.DataFrame], pd.DataFrame],
                    batch_partitions: int | None = None, on_error: str = "raise") -> DataFrame:
    """New lookup rows for keys the table does not know yet.

    ``resolver`` takes a pandas frame (city, country) and returns (city,
    country, lookup_lat, lookup_lng).  It runs inside ``mapInPandas`` on
    the executors, only for keys absent from ``lookup`` (anti-join), so a
    rerun after the rows were appended calls nothing.  ``batch_partitions``
    bounds the concurrent callers (e.g. to respect an API rate limit).
    An exception fails the job.  ``on_error="null"`` turns failed *requests*
    (``OSError``, which covers connection and time-out errors, and
    ``ValueError`` from an answer that cannot be parsed) into NULL coordinates
    for the keys of the batch; other exceptions still fail.
    """
    todo = keys.select("city", "country")
    if lookup is not None:
        todo = todo.join(lookup.select("city", "country"), ["city", "country"], "left_anti")
    return _resolve(todo, resolver, batch_partitions, on_error).drop("outcome")


def _resolve(todo: DataFrame, resolver: Callable[[pd.DataFrame], pd.DataFrame], batch_partitions: int | None,
             on_error: str) -> DataFrame:
    """Ask for every key of ``todo``: lookup rows with an ``outcome`` (found, none, error)."""
    if on_error not in ("null", "raise"):
        raise ValueError("on_error must be 'null' or 'raise'")
    if batch_partitions:
        todo = todo.repartition(batch_partitions, "city", "country")

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            failed = False
            try:
                out = resolver(pdf[["city", "country"]].copy())
            except (OSError, ValueError):
                if on_error == "raise":
                    raise
                out, failed = pdf[["city", "country"]].assign(lookup_lat=None, lookup_lng=None), True
            out = out[["city", "country", "lookup_lat", "lookup_lng"]].astype({"lookup_lat": "float64", "lookup_lng": "float64"})
            known = out["lookup_lat"].notna() & out["lookup_lng"].notna()
            yield out.assign(outcome=["found" if k else "error" if failed else "none" for k in known])

    return todo.mapInPandas(run, schema=StructType([*schemas.LOOKUP.fields, StructField("outcome", StringType())]))


def _table(spark, path: str, schema: StructType) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return None


def extend_lookup(spark, keys: DataFrame, path: str, resolver: Callable[[pd.DataFrame], pd.DataFrame],
                  batch_partitions: int | None = None, on_error: str = "raise", attempts_path: str | None = None,
                  retry_after: timedelta = timedelta(days=30), now: datetime | None = None) -> DataFrame:
    """Resolve the keys that the table at ``path`` does not hold, append them, return the table.

    Only keys with coordinates are appended.  Without ``attempts_path`` a
    rerun asks again for the keys without an answer and for nothing else.
    With it every question is written to that table (city, country, answer,
    outcome, asked_at) before its answer is used, and a key whose last
    question, answered or not, is younger than ``retry_after`` is not asked
    again; answers that a broken run did not append are taken from the
    attempts.  ``now`` is the time of this run (by default the clock's, UTC).
    The tables are made on first use.
    """
    known = _table(spark, path, schemas.LOOKUP)
    if attempts_path is None:
        new = resolve_missing(keys, known, resolver, batch_partitions, on_error)
    else:
        asked_at = F.lit((now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")
        before = _table(spark, attempts_path, schemas.ATTEMPTS)
        todo = keys.select("city", "country").distinct()
        if known is not None:
            todo = todo.join(known.select("city", "country"), ["city", "country"], "left_anti")
        if before is not None:
            young = before.where(F.col("asked_at") > asked_at - F.expr(f"make_dt_interval(0, 0, 0, {retry_after.total_seconds()!r})"))
            todo = todo.join(young.select("city", "country"), ["city", "country"], "left_anti")
        (_resolve(todo, resolver, batch_partitions, on_error).withColumn("asked_at", asked_at)
         .write.mode("append").parquet(attempts_path))
        new = spark.read.schema(schemas.ATTEMPTS).parquet(attempts_path).where("outcome = 'found'").select(*schemas.LOOKUP.names)
        if known is not None:
            new = new.join(known.select("city", "country"), ["city", "country"], "left_anti")
    new.where(F.col("lookup_lat").isNotNull() & F.col("lookup_lng").isNotNull()).write.mode("append").parquet(path)
    return spark.read.schema(schemas.LOOKUP).parquet(path)
