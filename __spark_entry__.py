"""

Every query reads the benchmark tables under ``sf_dir`` in full (or data
Spark derives from them and writes to the shared checkpoint folder).
Each oracle is independent DuckDB SQL over the same tables: the geohash
there is computed bit by bit with integer division, and joins use the
geohash text, not the packed cell id of the Spark side.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from geoweave import schemas  # noqa: E402
from geoweave.functions import geohash as gh  # noqa: E402
from geoweave.operators import enrich as en  # noqa: E402
from geoweave.operators import lookup as lk  # noqa: E402
from geoweave.operators import mutate as mu  # noqa: E402
from geoweave.operators import quality as dq  # noqa: E402
from geoweave.operators import tables as tb  # noqa: E402
from geoweave.operators.state import CellState  # noqa: E402
from geoweave.plans import report as rp  # noqa: E402
from geoweave.plans.config import EnrichConfig  # noqa: E402
from geoweave.plans.runner import run as run_job  # noqa: E402
from geoweave.sinks import files as sk  # noqa: E402
from geoweave.session import scratch_path  # noqa: E402
from geoweave.sources import files as src  # noqa: E402
from geoweave.sources import testdata as td  # noqa: E402
from geoweave.sources.synth import CONDITIONS, WIND_DIRECTIONS, synth_observations  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
AVG = {"weather_avg_tmpr_f", "weather_avg_tmpr_c"}
PLACE_COLS = ["id", "franchise_id", "franchise_name", "restaurant_franchise_id", "country", "city", "lat", "lng"]
OBS_COLS = ["event_id", "lat", "lng", "avg_tmpr_f", "avg_tmpr_c", "wthr_date", "year", "month", "day"]
ENRICHED_COLS = PLACE_COLS + ["geohash", "weather_lat", "weather_lng", "weather_wthr_date",
                              "weather_avg_tmpr_f", "weather_avg_tmpr_c"]


def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _places(spark, sf):
    return td.places(spark, sf)


def _obs(spark, sf):
    return td.observations(spark, sf)


def _enriched(spark, sf):
    return en.enrich(_places(spark, sf), _obs(spark, sf))


def _with_geohash(df, precision=4):
    return df.withColumn("geohash", gh.geohash("lat", "lng", precision))


def _lookup(spark, sf):
    """Stand-in for the geocoder: one row per distinct (city, country) of the places.

    A geocoder answers for any city, so this table covers every key, with
    coordinates from a fixed arithmetic rule on the city and nation numbers.
    (The city means of the places cannot serve here: in this data a city
    either has all its coordinates or none.)
    """
    city_n = F.substring("city", 5, 10).try_cast("int")
    nation_n = F.substring("country", 8, 10).try_cast("int")
    keys = _places(spark, sf).where(lk.has_key()).select("city", "country").distinct()
    return keys.select("city", "country",
                       (F.lit(30.0) + ((city_n * 37 + nation_n * 11) % 1000).cast("double") / 100)
                       .alias("lookup_lat"),
                       (F.lit(-10.0) + ((city_n * 53 + nation_n * 7) % 997).cast("double") / 100)
                       .alias("lookup_lng"))


def _filled(spark, sf):
    return lk.fill_coordinates(_places(spark, sf), _lookup(spark, sf))


def _places_by_country(spark, sf, name):
    """Places in one file per country."""
    path = scratch_path(spark, name)
    sk.write_partitioned(_places(spark, sf).repartition(8, "country"), path, ("country",), rebalance=False)
    return path


def _real_shape(spark, sf):
    """Observations as the real weather files hold them: without a unique key."""
    return _obs(spark, sf).drop("event_id")


def _text_shape(spark, sf):
    """Observations in the generator's shape, with text columns and gaps, from the events."""
    k = F.col("event_id")
    pick = [F.array(*[F.lit(x) for x in v]) for v in (CONDITIONS, WIND_DIRECTIONS)]
    return _obs(spark, sf).select(
        k, "lat", "lng", F.when(k % 5 != 0, F.element_at(pick[0], (k % 7 + 1).cast("int"))).alias("condition"),
        F.when(k % 3 != 0, F.element_at(pick[1], (k % 8 + 1).cast("int"))).alias("wind_direction"),
        F.concat(F.lit("City"), (k % 50).cast("string")).alias("city"), F.col("avg_tmpr_c").alias("temperature_c"))


# ------------------------------------------------------------- core enrichment

def q_enrich_left_join(spark, sf):
    return _round(_enriched(spark, sf), AVG)


def q_enrich_job(spark, sf):
    csv = scratch_path(spark, "places_csv")
    _places(spark, sf).write.option("header", True).csv(csv)
    cfg = EnrichConfig(places_path=csv, observations_path="(given)", output_path=scratch_path(spark, "enriched"))
    res = run_job(spark, cfg, observations=_obs(spark, sf), lookup=_lookup(spark, sf))
    return _round(res.output.select(*ENRICHED_COLS), AVG)


def q_job_without_lookup(spark, sf):
    csv = scratch_path(spark, "places_csv")
    _places(spark, sf).write.option("header", True).csv(csv)
    cfg = EnrichConfig(places_path=csv, observations_path="(given)", output_path=scratch_path(spark, "enriched"))
    return _round(run_job(spark, cfg, observations=_obs(spark, sf)).output.select(*ENRICHED_COLS), AVG)


def q_enrich_real_shape(spark, sf):
    return _round(en.enrich(_places(spark, sf), _real_shape(spark, sf)), AVG)


def q_enrich_incremental(spark, sf):
    """Observations come in two deliveries; the second run reads only the files of the second."""
    src_path, root = scratch_path(spark, "obs_deliveries"), scratch_path(spark, "cell_state")
    early = F.col("event_id") % 3 == 0
    for part in (_obs(spark, sf).where(early), _obs(spark, sf).where(~early)):
        part.write.mode("append").partitionBy("year", "month").parquet(src_path)
        CellState(spark, root).advance(src_path)
    return _round(en.join_cells(_places(spark, sf), CellState(spark, root).reduced()), AVG)


def q_dedupe_real_shape(spark, sf):
    r = en.reduce_observations(_real_shape(spark, sf))
    return _round(r.select(gh.cell_to_geohash(en.CELL).alias("geohash"), "weather_lat", "weather_lng",
                           "weather_wthr_date", "weather_avg_tmpr_f", "weather_avg_tmpr_c"), AVG)


def q_dedupe_text_dates(spark, sf):
    """Dates in more than one text form: the winning row's text comes through as it is."""
    k = F.col("event_id")
    iso = F.col("wthr_date")
    us = F.concat_ws("/", F.substring(iso, 6, 2), F.substring(iso, 9, 2), F.substring(iso, 1, 4))
    mixed = _obs(spark, sf).withColumn("wthr_date", F.when(k % 3 == 0, us).when(k % 7 == 0, F.lit(None)).otherwise(iso))
    r = en.reduce_observations(mixed)
    return r.select(gh.cell_to_geohash(en.CELL).alias("geohash"), "weather_wthr_date")


def q_dedupe_first_text(spark, sf):
    cols = ["condition", "wind_direction", "city", "temperature_c"]
    r = en.reduce_observations(_text_shape(spark, sf), mode="first", columns=cols)
    return r.select(gh.cell_to_geohash(en.CELL).alias("geohash"), *[f"weather_{c}" for c in cols])


def q_enrich_unmatched(spark, sf):
    return rp.unmatched(_enriched(spark, sf)).select(*PLACE_COLS, "geohash")


def q_dedupe_avg(spark, sf):
    r = en.reduce_observations(_obs(spark, sf))
    return _round(r.select(gh.cell_to_geohash(en.CELL).alias("geohash"), "weather_lat", "weather_lng",
                           "weather_wthr_date", "weather_avg_tmpr_f", "weather_avg_tmpr_c"), AVG)


def q_dedupe_first_prefixed(spark, sf):
    cols = ["lat", "lng", "avg_tmpr_f", "avg_tmpr_c", "wthr_date", "year", "month", "day"]
    r = en.reduce_observations(_obs(spark, sf), mode="first", columns=cols)
    return r.select(gh.cell_to_geohash(en.CELL).alias("geohash"), *[f"weather_{c}" for c in cols])


def q_key_overlap(spark, sf):
    return rp.matching_cells(_places(spark, sf), _obs(spark, sf))


def q_join_stats(spark, sf):
    return rp.join_stats(_enriched(spark, sf))


def q_records_by_country(spark, sf):
    return tb.group_count(_enriched(spark, sf), "country", alias="records", order=True)


def q_avg_temp_by_country(spark, sf):
    return tb.grouped_count_avg(rp.matched(_enriched(spark, sf)), "country", "weather_avg_tmpr_c",
                                "record_count", "avg_temperature_c")


def q_run_summary(spark, sf):
    return rp.run_summary(_places(spark, sf), _obs(spark, sf))


def q_dedupe_ratio(spark, sf):
    return rp.dedupe_ratio(_obs(spark, sf))


def q_top_cells(spark, sf):
    return rp.top_cells(_obs(spark, sf), 10)


def q_date_range(spark, sf):
    return rp.date_range(_obs(spark, sf))


# ----------------------------------------------------------------- quality

def q_dq_null_or_invalid(spark, sf):
    return dq.null_or_invalid(_places(spark, sf))


def q_dq_null_only(spark, sf):
    return dq.null_only(_places(spark, sf))


def q_dq_invalid_only(spark, sf):
    return dq.invalid_only(_places(spark, sf))


def q_dq_valid(spark, sf):
    return dq.valid_only(_places(spark, sf))


def q_dq_summary(spark, sf):
    return dq.quality_summary(_places(spark, sf))


def q_null_count_stats(spark, sf):
    return dq.null_count_stats(_with_geohash(_places(spark, sf)), "geohash")


def q_describe_columns(spark, sf):
    return dq.describe_columns(_places(spark, sf), ["lat", "lng"])


def q_distinct_locations(spark, sf):
    return _places(spark, sf).select("city", "country").distinct()


def q_distinct_count_with_null(spark, sf):
    return dq.distinct_count_with_null(_with_geohash(_places(spark, sf)), "geohash")


def q_row_counts(spark, sf):
    p = _places(spark, sf).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("places").alias("source"), "rows")
    o = _obs(spark, sf).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("observations").alias("source"), "rows")
    return p.unionAll(o)


# ----------------------------------------------------------- lookup / fill

def q_lookup_keys(spark, sf):
    return lk.lookup_keys(_places(spark, sf))


def q_fill_coordinates(spark, sf):
    return _filled(spark, sf)


def q_fill_remaining_nulls(spark, sf):
    return dq.remaining_nulls(_filled(spark, sf))


def q_fill_duplicate_keys(spark, sf):
    """A lookup that holds its keys twice (a repeated append) fills as one that holds them once."""
    lookup = _lookup(spark, sf)
    again = lookup.withColumn("lookup_lng", F.col("lookup_lng") + 1)
    return lk.fill_coordinates(_places(spark, sf), lookup.unionByName(again).unionByName(lookup))


def q_lookup_from_places(spark, sf):
    return lk.lookup_from_places(_places(spark, sf))


def q_json_path_array(spark, sf):
    """Geocoder answers (one per observation, some without a result): the first result's coordinates."""
    o = _obs(spark, sf)
    body = F.to_json(F.struct(F.array(F.struct(F.struct("lat", "lng").alias("geometry"))).alias("results")))
    o = o.select("event_id", F.when(F.col("event_id") % 10 == 0, F.lit('{"results":[]}')).otherwise(body).alias("body"))
    return o.select("event_id", lk.coords_from_json("body").alias("c")).select("event_id", "c.lat", "c.lng")


def q_json_extract(spark, sf):
    e = td.table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
                    F.get_json_object("props", "$.missing").alias("missing"))


# ------------------------------------------------------------------ geohash

def q_geohash_encode(spark, sf):
    return _with_geohash(_places(spark, sf)).select("id", "lat", "lng", "geohash")


def q_geohash_sql_function(spark, sf):
    gh.register_sql_functions(spark, 4, "geohash4")
    view = f"places_{uuid.uuid4().hex[:8]}"
    _places(spark, sf).createOrReplaceTempView(view)
    return spark.sql(f"SELECT id, lat, lng, geohash4(lat, lng) AS geohash FROM {view}")


def q_geohash_precision6(spark, sf):
    return _obs(spark, sf).select("event_id", gh.geohash("lat", "lng", 6).alias("geohash6"),
                               gh.geohash("lat", "lng", 8).alias("geohash8"))


def q_geohash_decode(spark, sf):
    g = rp.cells_with_text(_obs(spark, sf)).select("geohash")
    d = gh.decode("geohash")
    return g.select("geohash", d.lat.alias("center_lat"), d.lng.alias("center_lng"))


def q_geohash_neighbors(spark, sf):
    g = _with_geohash(_places(spark, sf)).select("geohash").where("geohash IS NOT NULL").distinct()
    return gh.explode_neighbours(g, "geohash")


# ------------------------------------------------------------ sources / sinks

def q_scan_csv_typed(spark, sf):
    path = scratch_path(spark, "places_csv")
    _places(spark, sf).write.option("header", True).csv(path)
    return src.read_places(spark, path)


def q_cast_columns(spark, sf):
    path = scratch_path(spark, "places_csv")
    _places(spark, sf).write.option("header", True).csv(path)
    return src.cast_columns(src.read_csv_strings(spark, path), schemas.PLACES)


def q_scan_parquet(spark, sf):
    return _obs(spark, sf)


def q_scan_partitioned(spark, sf):
    path = scratch_path(spark, "obs_by_day")
    sk.write_partitioned(_obs(spark, sf), path, ("year", "month", "day"))
    df = src.read_observations(spark, path)
    return df.where(F.col("day").between(10, 12)).select(*OBS_COLS)


def q_scan_delimited_ctrl_a(spark, sf):
    path = scratch_path(spark, "places_ctrl_a")
    src.write_delimited(_places(spark, sf), path)
    return src.read_delimited(spark, path, schemas.PLACES)


def q_repair_multiline_records(spark, sf):
    cols = ["doc_id", "lang", "source", "n_chars", "text"]
    path = scratch_path(spark, "docs_ctrl_a")
    src.write_delimited(td.table(spark, sf, "documents").select(*cols), path)
    schema = td.table(spark, sf, "documents").select(*cols).schema
    return src.repair_multiline(spark, path, schema)


def q_scan_orc(spark, sf):
    path = scratch_path(spark, "places_orc")
    _places(spark, sf).write.orc(path)
    return src.read_orc(spark, path)


def q_ingest_append(spark, sf):
    o = td.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    table, staging = scratch_path(spark, "orders_table"), scratch_path(spark, "orders_staging")
    o.where(first).write.parquet(table)
    o.where(~first).write.parquet(staging)
    return src.ingest_files(spark, staging, table)


def q_ingest_twice(spark, sf):
    """Two deliveries into one folder, and a load after each and once more: every file is loaded once."""
    o = td.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    folder, table = scratch_path(spark, "orders_deliveries"), scratch_path(spark, "orders_loaded")
    for part in (o.where(first), o.where(~first), None):
        if part is not None:
            part.write.mode("append").parquet(folder)
        src.ingest_new(spark, folder, table)
    return src.read_ingested(spark, table)


def q_scan_delimited_quarantine(spark, sf):
    """Lines that do not fit the schema are kept beside the rows: every seventh payment has a broken amount."""
    o = td.table(spark, sf, "orders")
    amount = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("decimal(10,2)").cast("string"))
    path = scratch_path(spark, "payments_ctrl_a")
    src.write_delimited(o.select(F.col("o_custkey").cast("string"), F.concat(F.lit("C"), F.col("o_orderkey").cast("string")),
                                 F.date_format("o_orderdate", "yyyy-MM-dd"), amount).toDF(*schemas.PAYMENTS.names), path)
    r = src.read_delimited(spark, path, schemas.PAYMENTS, corrupt_column="broken")
    return r.select("customer_number", "check_number", F.col("payment_date").cast("string").alias("payment_date"), F.col("amount").cast("double").alias("amount"),
                    F.replace("broken", F.lit(src.CTRL_A), F.lit("|")).alias("broken"))


def _sales_table(spark, df, schema, name):
    """``df`` written as raw control-A text and read back with ``schema``."""
    path = scratch_path(spark, name)
    src.write_delimited(df.toDF(*schema.names), path)
    return src.read_delimited(spark, path, schema)


def q_scan_order_details(spark, sf):
    li = td.table(spark, sf, "lineitem")
    rows = li.select("l_orderkey", F.concat(F.lit("S"), F.col("l_partkey").cast("string")), F.col("l_quantity").cast("int"),
                     F.col("l_extendedprice").cast("decimal(10,2)"), "l_linenumber")
    return _sales_table(spark, rows, schemas.ORDERDETAILS, "orderdetails").withColumn("price_each", F.col("price_each").cast("double"))


def q_scan_products(spark, sf):
    p = td.table(spark, sf, "part")
    price = F.col("p_retailprice").cast("decimal(10,2)")
    rows = p.select(F.concat(F.lit("S"), F.col("p_partkey").cast("string")), "p_name", "p_type", F.lit(None).cast("string").alias("scale"),
                    "p_brand", F.lit('say "hi"').alias("description"), "p_size", price.alias("buy"), price.alias("msrp"))
    return _sales_table(spark, rows, schemas.PRODUCTS, "products").select(
        "product_code", "product_name", "product_line", "product_scale", "product_vendor", "product_description", "quantity_in_stock",
        F.col("buy_price").cast("double").alias("buy_price"))


def q_scan_offices(spark, sf):
    s = td.table(spark, sf, "supplier")
    rows = s.select("s_suppkey", "s_name", F.lit('+47 "55"').alias("phone"), F.col("s_nationkey").cast("string"), F.lit(None).cast("string").alias("line2"),
                    F.lit(None).cast("string").alias("state"), F.lit("Norway  ").alias("land"), F.lit("00100"), F.lit("EMEA"))
    return _sales_table(spark, rows, schemas.OFFICES, "offices")


def q_scan_employees(spark, sf):
    c = td.table(spark, sf, "customer")
    boss = F.when(F.col("c_custkey") % 10 > 0, F.col("c_custkey") - F.col("c_custkey") % 10)
    rows = c.select("c_custkey", "c_name", "c_mktsegment", F.concat(F.lit("x"), F.col("c_nationkey").cast("string")),
                    F.concat(F.col("c_name"), F.lit("@example.com")), "c_nationkey", boss.cast("int"), F.lit("Sales Rep"))
    return _sales_table(spark, rows, schemas.EMPLOYEES, "employees")


def q_geohash_when_absent(spark, sf):
    """Observations that carry a geohash keep it, others get theirs."""
    own = _obs(spark, sf).where("event_id % 2 = 0").withColumn("geohash", F.lit("kept"))
    other = _obs(spark, sf).where("event_id % 2 = 1")
    return en.add_geohash(own).select("event_id", "geohash").unionAll(en.add_geohash(other).select("event_id", "geohash"))


def q_lookup_attempts(spark, sf):
    """Three runs against a geocoder that does not know every city; what has no answer is asked again after a week."""
    def geocoder(keys):
        n = keys["city"].str[4:].astype(int)
        return keys.assign(lookup_lat=(40.0 + n / 100).where(n % 20 == 0), lookup_lng=(-5.0 - n / 100).where(n % 20 == 0))
    table, attempts = scratch_path(spark, "lookup"), scratch_path(spark, "attempts")
    keys = lk.lookup_keys(_places(spark, sf))
    for day in (1, 2, 9):
        lk.extend_lookup(spark, keys, table, geocoder, attempts_path=attempts, retry_after=timedelta(days=7),
                         now=datetime(2024, 1, day, tzinfo=timezone.utc))
    asked = spark.read.schema(schemas.ATTEMPTS).parquet(attempts).groupBy("city", "country").agg(
        F.count(F.lit(1)).alias("questions"), F.count_if(F.col("outcome") == "found").alias("answers"))
    known = spark.read.schema(schemas.LOOKUP).parquet(table)
    return asked.join(known, ["city", "country"], "left")


def q_write_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "obs_by_month")
    sk.write_partitioned(_obs(spark, sf), path, ("year", "month"))
    return spark.read.parquet(path).select(*OBS_COLS)


def q_append_mode(spark, sf):
    path = scratch_path(spark, "places_append")
    north = F.coalesce(F.col("lat") > 35, F.lit(False))
    sk.write_partitioned(_places(spark, sf).where(north), path, (), mode="overwrite")
    sk.write_partitioned(_places(spark, sf).where(~north), path, (), mode="append")
    return spark.read.parquet(path)


def q_dynamic_partition_insert(spark, sf):
    path = scratch_path(spark, "cust_country")
    sk.insert_dynamic_partitions(_places(spark, sf), path, "country")
    return spark.read.parquet(path).select(*PLACE_COLS)


def q_append_rerun(spark, sf):
    """Two runs append their places; each is run twice, the first time with rows that the second time drops."""
    path = scratch_path(spark, "places_runs")
    north = F.coalesce(F.col("lat") > 35, F.lit(False))
    for run_id, rows in (("north", _places(spark, sf)), ("rest", _places(spark, sf).where(~north)),
                         ("north", _places(spark, sf).where(north)), ("rest", _places(spark, sf).where(~north))):
        sk.append_run(rows, path, run_id, ("country",))
    return sk.read_back(spark, _places(spark, sf), path)


def q_insert_limited(spark, sf):
    """A limited, ordered sample into a partitioned table (the limit is the statement's own)."""
    path = scratch_path(spark, "places_sample")
    sk.insert_dynamic_partitions(_places(spark, sf), path, "country", limit=25, order_by=["franchise_name", "id"], run_id="sample")
    return sk.read_back(spark, _places(spark, sf), path)


def q_verify_partitions(spark, sf):
    """One partition of the written table loses rows and gains a changed one; it alone is named."""
    path, places = scratch_path(spark, "places_verify"), _places(spark, sf)
    sk.write_partitioned(places, path)
    hurt = (places.where((F.col("country") == "NATION_5") & (F.col("id") % 3 > 0))
            .withColumn("city", F.when(F.col("id") % 2 == 0, F.lit("elsewhere")).otherwise(F.col("city"))))
    sk.write_partitioned(hurt, path, dynamic_overwrite=True)
    return sk.differing_partitions(places, sk.read_back(spark, places, path))


def q_compression_codec(spark, sf):
    """Rows of a written table by the codec in its files' names."""
    path = scratch_path(spark, "places_codec")
    sk.write_partitioned(_places(spark, sf), path)
    codec = F.regexp_extract(F.col("_metadata.file_name"), r"[.]([a-z]+)[.]parquet$", 1).alias("codec")
    return spark.read.parquet(path).groupBy(codec).agg(F.count(F.lit(1)).alias("rows"))


def q_bucketed_hot_cell(spark, sf):
    """Observations bucketed by cell and salt, a third of them moved into one cell; reduced from the buckets."""
    hot = F.col("event_id") % 3 == 0
    obs = _obs(spark, sf).withColumn("lat", F.when(hot, 30.5).otherwise(F.col("lat"))) \
        .withColumn("lng", F.when(hot, -9.5).otherwise(F.col("lng")))
    name = f"obs_by_cell_{uuid.uuid4().hex[:8]}"
    table = en.bucket_observations(obs, name, scratch_path(spark, name), buckets=8, salts=4)
    r = en.reduce_observations(table)
    return _round(r.select(gh.cell_to_geohash(en.CELL).alias("geohash"), "weather_lat", "weather_lng",
                           "weather_wthr_date", "weather_avg_tmpr_f", "weather_avg_tmpr_c"), AVG)


def q_bucketed_table(spark, sf):
    name = f"places_bucketed_{uuid.uuid4().hex[:8]}"
    sk.save_bucketed(_places(spark, sf), name, scratch_path(spark, name), "id", 5, "orc")
    return spark.table(name)


def q_verify_roundtrip(spark, sf):
    return sk.verify_roundtrip(spark, _places(spark, sf), scratch_path(spark, "verify"), ("country",))


def q_idempotent_rerun(spark, sf):
    return sk.idempotent_rerun(spark, _places(spark, sf), scratch_path(spark, "rerun"), ("country",))


def q_partition_inventory(spark, sf):
    return sk.partition_inventory(spark, _places_by_country(spark, sf, "inventory"), "country")


def q_filter_partition_eq(spark, sf):
    path = _places_by_country(spark, sf, "by_country")
    return spark.read.parquet(path).where(F.col("country") == "NATION_3").select(*PLACE_COLS)


def q_input_lineage(spark, sf):
    path = _places_by_country(spark, sf, "lineage")
    df = spark.read.parquet(path).where(F.col("country").isin("NATION_3", "NATION_7"))
    return sk.input_lineage(df, "country").select("country", "rows", "files")


def q_overwrite_replaces_all(spark, sf):
    """A second overwrite with fewer countries leaves none of the first one's partitions."""
    path, p = scratch_path(spark, "overwrite"), _places(spark, sf)
    sk.write_partitioned(p, path, ("country",))
    sk.write_partitioned(p.where("country NOT IN ('NATION_3', 'NATION_4')"), path, ("country",))
    return sk.read_back(spark, p, path)


def q_partition_value_types(spark, sf):
    """Partition values such as 007 come back as the text they were."""
    path = scratch_path(spark, "codes")
    p = _places(spark, sf).select("id", "city", F.lpad(F.col("franchise_id").cast("string"), 3, "0").alias("code"))
    sk.write_partitioned(p, path, ("code",))
    return sk.read_back(spark, p, path)


# ------------------------------------------------------- HiveQL-style queries

def q_inline_values(spark, sf):
    """Inline rows (SQL VALUES) as a small dimension joined to a full table."""
    view = f"orders_{uuid.uuid4().hex[:8]}"
    td.table(spark, sf, "orders").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT o.o_orderpriority, u.urgency, count(*) AS orders_count
        FROM {view} o
        LEFT JOIN (VALUES ('1-URGENT', 'high'), ('2-HIGH', 'high'), ('3-MEDIUM', 'normal'),
                          ('4-NOT SPECIFIED', 'normal'), ('5-LOW', 'low')) AS u(priority, urgency)
          ON o.o_orderpriority = u.priority
        GROUP BY o.o_orderpriority, u.urgency""")


def q_insert_values(spark, sf):
    """INSERT ... SELECT from a table, then INSERT ... VALUES, into an external catalog table."""
    name, view = f"suppliers_{uuid.uuid4().hex[:8]}", f"supplier_{uuid.uuid4().hex[:8]}"
    td.table(spark, sf, "supplier").createOrReplaceTempView(view)
    spark.sql(f"CREATE TABLE {name} (s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE) "
              f"USING parquet LOCATION '{scratch_path(spark, name)}'")
    spark.sql(f"INSERT INTO {name} SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM {view}")
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'Supplier#new-1', 3, 10.5), (-2, 'Supplier#new-2', NULL, NULL)")
    return spark.table(name)


def q_select_star_limit(spark, sf):
    return tb.head(td.table(spark, sf, "supplier"), 10, ["s_suppkey"])


def q_project_between_sort(spark, sf):
    return tb.project_range_top(td.table(spark, sf, "supplier"), ["s_suppkey", "s_name", "s_acctbal"],
                                "s_acctbal", 1000, 6000, [F.col("s_name").desc(), F.col("s_suppkey")], 5)


def q_group_count_sorted(spark, sf):
    return tb.group_count(td.table(spark, sf, "orders"), "o_orderpriority", alias="orders_count", order=True)


def q_group_count(spark, sf):
    return tb.group_count(_places(spark, sf), "country", alias="customers_n")


# ---------------------------------------------------------------- mutations

def q_update_where(spark, sf):
    return mu.update_where(_places(spark, sf), F.col("lat") > 35, {"lat": 0.0})


def q_delete_where(spark, sf):
    return mu.delete_where(_places(spark, sf), F.col("lat") > 35)


def q_mutation_chain(spark, sf):
    s = td.table(spark, sf, "supplier")
    low = F.coalesce(F.col("s_acctbal") < 5000, F.lit(False))
    t = mu.CowTable.create(spark, scratch_path(spark, "my_emp"), s.where(low), fmt="orc",
                           bucket_col="s_suppkey", buckets=5, table=f"my_emp_{uuid.uuid4().hex[:8]}")
    t.update(F.col("s_nationkey") == 3, {"s_acctbal": 9000.0})
    t.insert(s.where(~low))
    t.delete(F.col("s_nationkey") == 7)
    return t.read()


def q_update_partitioned(spark, sf):
    """UPDATE and DELETE that rewrite only the partitions they touch."""
    t = mu.CowTable.create(spark, scratch_path(spark, "places_cow"), _places(spark, sf), fmt="parquet",
                           partition_col="country")
    t.update((F.col("country") == "NATION_3") & (F.col("id") % 2 == 0), {"city": "moved"})
    t.delete((F.col("country") == "NATION_7") & (F.col("lat") > 35))
    return t.read().select(*PLACE_COLS)


def q_synth_observations(spark, sf):
    return synth_observations(_places(spark, sf), per_place=4, seed=7)


# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: places enriched with per-geohash weather at sf0.001."""
    return q_enrich_left_join(spark, SMOKE_DIR)


def _llm():
    """The queries module of the training-data subpackage, or None where that package is not installed.

    Only its absence is tolerated: an error inside it is raised.
    """
    if importlib.util.find_spec("geoweave.llm") is None:
        return None
    return importlib.import_module("geoweave.llm.queries")


def _pipeline():
    if importlib.util.find_spec("geoweave.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
        return None
    return importlib.import_module("corpus_pipeline")


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k[2:]: v for k, v in globals().items() if k.startswith("q_") and callable(v)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = own_queries()
    if llm := _llm():
        found |= llm.QUERIES
    if pipeline := _pipeline():
        found["pipeline"] = pipeline.run
    return found


# ===================================================================== oracle

_B32 = "0123456789bcdefghjkmnpqrstuvwxyz"  # fixed value: geohash alphabet
_EPS = 1e-9


def _d_index(v: str, lo: float, hi: float, bits: int) -> str:
    """Band index by bisection, one halving of the interval per bit."""
    c = f"greatest(least({v}, CAST({hi - _EPS!r} AS DOUBLE)), CAST({lo + _EPS!r} AS DOUBLE))"
    first = f"{{'lo': CAST({lo!r} AS DOUBLE), 'hi': CAST({hi!r} AS DOUBLE), 'i': CAST(0 AS BIGINT)}}"
    steps = ", ".join([first] * (bits + 1))  # a start, and one element per step (its value is not used)
    mid = "((s.lo + s.hi) / 2)"
    return (f"list_reduce([{steps}], lambda s, step: CASE WHEN {c} >= {mid} "
            f"THEN {{'lo': {mid}, 'hi': s.hi, 'i': s.i * 2 + 1}} ELSE {{'lo': s.lo, 'hi': {mid}, 'i': s.i * 2}} END).i")


def _d_text(ti: str, li: str, p: int) -> str:
    """Geohash text from latitude / longitude band indexes: each bit by integer division."""
    nl, nt = (5 * p + 1) // 2, 5 * p // 2
    chars = []
    for k in range(p):
        terms = []
        for b in range(5):
            j = 5 * k + b
            if j % 2 == 0:
                bit = f"(({li} // {2 ** (nl - 1 - j // 2)}) % 2)"
            else:
                bit = f"(({ti} // {2 ** (nt - 1 - j // 2)}) % 2)"
            terms.append(f"{bit} * {2 ** (4 - b)}")
        chars.append(f"substr('{_B32}', CAST({' + '.join(terms)} + 1 AS INTEGER), 1)")
    return f"concat({', '.join(chars)})"


def _d_geohash(lat: str, lng: str, p: int = 4) -> str:
    nl, nt = (5 * p + 1) // 2, 5 * p // 2
    li, ti = _d_index(lng, -180.0, 180.0, nl), _d_index(lat, -90.0, 90.0, nt)
    return (f"CASE WHEN {lat} BETWEEN -90 AND 90 AND {lng} BETWEEN -180 AND 180 "
            f"THEN {_d_text(ti, li, p)} END")


def _d_band(g: str, axis: str, p: int = 4) -> str:
    """Band index of a p-char geohash along 'lat' or 'lng' from its characters."""
    n = (5 * p + 1) // 2 if axis == "lng" else 5 * p // 2
    terms, pos = [], n - 1
    for j in range(5 * p):
        if (j % 2 == 0) == (axis == "lng"):
            k, b = divmod(j, 5)
            v = f"(instr('{_B32}', substr({g}, {k + 1}, 1)) - 1)"
            terms.append(f"(({v} // {2 ** (4 - b)}) % 2) * {2 ** pos}")
            pos -= 1
    return " + ".join(terms)


PLACES_SQL = """
SELECT c_custkey AS id, c_nationkey AS franchise_id, c_mktsegment AS franchise_name,
       CAST(c_custkey % 100000 AS INTEGER) AS restaurant_franchise_id, n_name AS country,
       concat('City', CAST(c_custkey % 50 AS VARCHAR)) AS city,
       CASE WHEN c_custkey % 10 = 0 THEN NULL
            WHEN c_custkey % 17 = 0 THEN CAST(91 AS DOUBLE)
            ELSE 30 + CAST(c_custkey * 7919 % 1000 AS DOUBLE) / 100 END AS lat,
       CASE WHEN c_custkey % 10 = 0 THEN NULL
            ELSE -10 + CAST(c_custkey * 104729 % 997 AS DOUBLE) / 100 END AS lng
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

OBS_SQL = """
SELECT event_id,
       30 + CAST(event_id * 6007 % 800 AS DOUBLE) / 100 AS lat,
       -10 + CAST(event_id * 6011 % 997 AS DOUBLE) / 100 AS lng,
       value * 9 / 5 + 32 AS avg_tmpr_f, value AS avg_tmpr_c,
       strftime(ts, '%Y-%m-%d') AS wthr_date,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day
FROM events"""

_W = """SELECT geohash AS wg,
             arg_min(lat, event_id) FILTER (WHERE lat IS NOT NULL) AS weather_lat,
             arg_min(lng, event_id) FILTER (WHERE lng IS NOT NULL) AS weather_lng,
             arg_min(wthr_date, event_id) FILTER (WHERE wthr_date IS NOT NULL) AS weather_wthr_date,
             avg(avg_tmpr_f) AS weather_avg_tmpr_f, avg(avg_tmpr_c) AS weather_avg_tmpr_c
      FROM og WHERE geohash IS NOT NULL GROUP BY geohash"""

_PRE = f"""
WITH places AS ({PLACES_SQL}),
obs AS ({OBS_SQL}),
pg AS (SELECT *, {_d_geohash('lat', 'lng')} AS geohash FROM places),
og AS (SELECT *, {_d_geohash('lat', 'lng')} AS geohash FROM obs),
w AS ({_W}),
enriched AS (SELECT pg.*, w.weather_lat, w.weather_lng, w.weather_wthr_date,
                    w.weather_avg_tmpr_f, w.weather_avg_tmpr_c
             FROM pg LEFT JOIN w ON pg.geohash = w.wg),
lookup AS (SELECT city, country,
                  30 + CAST((TRY_CAST(substr(city, 5, 10) AS INTEGER) * 37
                             + TRY_CAST(substr(country, 8, 10) AS INTEGER) * 11) % 1000 AS DOUBLE) / 100 AS lookup_lat,
                  -10 + CAST((TRY_CAST(substr(city, 5, 10) AS INTEGER) * 53
                              + TRY_CAST(substr(country, 8, 10) AS INTEGER) * 7) % 997 AS DOUBLE) / 100 AS lookup_lng
           FROM (SELECT DISTINCT city, country FROM places
                 WHERE city IS NOT NULL AND city <> '' AND country IS NOT NULL AND country <> '')),
filled AS (SELECT p.id, p.franchise_id, p.franchise_name, p.restaurant_franchise_id, p.country, p.city,
                  coalesce(p.lat, l.lookup_lat) AS lat, coalesce(p.lng, l.lookup_lng) AS lng
           FROM places p LEFT JOIN lookup l ON p.city = l.city AND p.country = l.country),
fg AS (SELECT *, {_d_geohash('lat', 'lng')} AS geohash FROM filled),
fenriched AS (SELECT fg.*, w.weather_lat, w.weather_lng, w.weather_wthr_date,
                     w.weather_avg_tmpr_f, w.weather_avg_tmpr_c
              FROM fg LEFT JOIN w ON fg.geohash = w.wg)
"""

# the reduction of observations without a key: ordered by date, latitude, longitude, then the averages' columns
_RW = """ranked AS (SELECT *, row_number() OVER (PARTITION BY geohash ORDER BY wthr_date NULLS FIRST, lat NULLS FIRST,
              lng NULLS FIRST, avg_tmpr_c NULLS FIRST, avg_tmpr_f NULLS FIRST) AS rn
            FROM (SELECT geohash, lat, lng, wthr_date, avg_tmpr_c, avg_tmpr_f FROM og WHERE geohash IS NOT NULL)),
rw AS (SELECT geohash AS wg, arg_min(lat, rn) FILTER (WHERE lat IS NOT NULL) AS weather_lat,
              arg_min(lng, rn) FILTER (WHERE lng IS NOT NULL) AS weather_lng,
              arg_min(wthr_date, rn) FILTER (WHERE wthr_date IS NOT NULL) AS weather_wthr_date,
              avg(avg_tmpr_f) AS weather_avg_tmpr_f, avg(avg_tmpr_c) AS weather_avg_tmpr_c
       FROM ranked GROUP BY geohash)"""
_RW_COLS = ("weather_lat, weather_lng, weather_wthr_date, round(weather_avg_tmpr_f, 6) AS weather_avg_tmpr_f, "
            "round(weather_avg_tmpr_c, 6) AS weather_avg_tmpr_c")

_PLACE_COLS = ", ".join(PLACE_COLS)
_ENR = (f"{_PLACE_COLS}, geohash, weather_lat, weather_lng, weather_wthr_date, "
        "round(weather_avg_tmpr_f, 6) AS weather_avg_tmpr_f, round(weather_avg_tmpr_c, 6) AS weather_avg_tmpr_c")
_VALID = "(lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180)"
_NULL = "(lat IS NULL OR lng IS NULL)"
_INVALID = f"(NOT {_NULL} AND NOT coalesce({_VALID}, false))"
_OBS_COLS = ", ".join(OBS_COLS)


def _q(body: str) -> str:
    return _PRE + body


def _first_cols(cols):
    return ",\n".join(f"arg_min({c}, event_id) FILTER (WHERE {c} IS NOT NULL) AS weather_{c}" for c in cols)


def _synth_sql() -> str:
    def draw(salt, modulus):
        text = f"substr(md5(concat_ws('|', CAST(id AS VARCHAR), CAST(draw AS VARCHAR), '{salt}')), 1, 8)"
        value = " + ".join(f"(instr('0123456789abcdef', substr({text}, {i + 1}, 1)) - 1) * {16 ** (7 - i)}" for i in range(8))
        return f"(CAST({value} AS BIGINT) % {modulus})"

    def uni(salt, lo, hi, steps=10000):
        return f"({lo!r} + CAST({draw(salt, steps + 1)} AS DOUBLE) * {(hi - lo) / steps!r})"

    s = 7 * 31
    lat = f"round(least(greatest(lat + {uni(s + 1, -0.1, 0.1)}, -90.0), 90.0), 6)"
    lng = f"round(least(greatest(lng + {uni(s + 2, -0.1, 0.1)}, -180.0), 180.0), 6)"
    return _q(f""", d AS (
  SELECT *, unnest(range(1, 5)) AS draw FROM places
  WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180),
s AS (
  SELECT {lat} AS lat, {lng} AS lng,
         round({uni(s + 3, -10.0, 35.0, 450)}, 1) AS temperature_c,
         CAST(20 + {draw(s + 4, 81)} AS INTEGER) AS humidity_pct,
         round({uni(s + 5, 980.0, 1030.0, 500)}, 1) AS pressure_mb,
         round({uni(s + 6, 0.0, 50.0, 500)}, 1) AS wind_speed_kmh,
         {WIND_DIRECTIONS!r}[{draw(s + 7, 8)} + 1] AS wind_direction,
         {CONDITIONS!r}[{draw(s + 8, 7)} + 1] AS condition,
         strftime(DATE '2024-01-01' + CAST({draw(s + 9, 366)} AS INTEGER), '%Y-%m-%d') AS observation_date,
         city, country
  FROM d)
SELECT lat, lng, {_d_geohash('lat', 'lng')} AS geohash, temperature_c, humidity_pct, pressure_mb,
       wind_speed_kmh, wind_direction, condition, observation_date, city, country FROM s""")


def oracle_sql() -> dict[str, str]:
    found = own_oracle_sql()
    if llm := _llm():
        found |= llm.ORACLE_SQL
    pipeline = _pipeline()
    if pipeline and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found


def own_oracle_sql() -> dict[str, str]:
    first_cols = ["lat", "lng", "avg_tmpr_f", "avg_tmpr_c", "wthr_date", "year", "month", "day"]
    offsets = [("n", 1, 0), ("ne", 1, 1), ("e", 0, 1), ("se", -1, 1),
               ("s", -1, 0), ("sw", -1, -1), ("w", 0, -1), ("nw", 1, -1)]
    dirs = ", ".join(f"{{'direction': '{k}', 'dlat': {a}, 'dlng': {b}}}" for k, a, b in offsets)
    places_all = _q(f"SELECT {_PLACE_COLS} FROM places")
    return {
        "enrich_left_join": _q(f"SELECT {_ENR} FROM enriched"),
        "enrich_job": _q(f"SELECT {_ENR} FROM fenriched"),
        "enrich_unmatched": _q(f"SELECT {_PLACE_COLS}, geohash FROM enriched WHERE weather_lat IS NULL"),
        "dedupe_avg": _q("SELECT wg AS geohash, weather_lat, weather_lng, weather_wthr_date, "
                         "round(weather_avg_tmpr_f, 6) AS weather_avg_tmpr_f, "
                         "round(weather_avg_tmpr_c, 6) AS weather_avg_tmpr_c FROM w"),
        "dedupe_first_prefixed": _q(f"SELECT geohash, {_first_cols(first_cols)} FROM og "
                                    "WHERE geohash IS NOT NULL GROUP BY geohash"),
        "key_overlap": _q("SELECT geohash FROM pg INTERSECT SELECT geohash FROM og"),
        "join_stats": _q("""SELECT count(*) AS total_records,
            count(*) FILTER (WHERE weather_lat IS NOT NULL) AS matched_records,
            count(*) FILTER (WHERE weather_lat IS NULL) AS unmatched_records,
            round(CAST(count(*) FILTER (WHERE weather_lat IS NOT NULL) AS DOUBLE) * 100 / count(*), 1)
              AS matched_pct FROM enriched"""),
        "records_by_country": _q("SELECT country, count(*) AS records FROM enriched GROUP BY country"),
        "avg_temp_by_country": _q("""SELECT country, count(*) AS record_count,
            round(avg(weather_avg_tmpr_c), 6) AS avg_temperature_c
            FROM enriched WHERE weather_lat IS NOT NULL GROUP BY country"""),
        "run_summary": _q(f"""
            SELECT 'places_total' AS metric, count(*) AS value FROM places
            UNION ALL SELECT 'observations_total', count(*) FROM obs
            UNION ALL SELECT 'null_coordinates', count(*) FILTER (WHERE {_NULL}) FROM places
            UNION ALL SELECT 'invalid_coordinates', count(*) FILTER (WHERE {_INVALID}) FROM places
            UNION ALL SELECT 'place_geohashes', count(*) FROM (SELECT DISTINCT geohash FROM pg)
            UNION ALL SELECT 'observation_geohashes', count(*) FROM (SELECT DISTINCT geohash FROM og)
            UNION ALL SELECT 'matching_geohashes', count(*) FROM
                (SELECT geohash FROM pg INTERSECT SELECT geohash FROM og)
            UNION ALL SELECT 'enriched_total', count(*) FROM enriched
            UNION ALL SELECT 'matched', count(*) FILTER (WHERE weather_lat IS NOT NULL) FROM enriched
            UNION ALL SELECT 'unmatched', count(*) FILTER (WHERE weather_lat IS NULL) FROM enriched"""),
        "dedupe_ratio": _q("SELECT count(*) AS rows_before, count(DISTINCT geohash) AS rows_after "
                           "FROM og WHERE geohash IS NOT NULL"),
        "top_cells": _q("SELECT geohash, count(*) AS count FROM og GROUP BY geohash "
                        "ORDER BY count DESC, geohash ASC NULLS FIRST LIMIT 10"),
        "date_range": _q("SELECT min(wthr_date) AS min_date, max(wthr_date) AS max_date FROM obs"),
        "dq_null_or_invalid": _q(f"SELECT {_PLACE_COLS} FROM places WHERE NOT coalesce({_VALID}, false)"),
        "dq_null_only": _q(f"SELECT {_PLACE_COLS} FROM places WHERE {_NULL}"),
        "dq_invalid_only": _q(f"SELECT {_PLACE_COLS} FROM places WHERE {_INVALID}"),
        "dq_valid": _q(f"SELECT {_PLACE_COLS} FROM places WHERE coalesce({_VALID}, false)"),
        "dq_summary": _q(f"""SELECT total_records, valid_records, null_records, invalid_records,
              round(CAST(valid_records AS DOUBLE) * 100 / total_records, 1) AS valid_pct,
              round(CAST(null_records AS DOUBLE) * 100 / total_records, 1) AS null_pct,
              round(CAST(invalid_records AS DOUBLE) * 100 / total_records, 1) AS invalid_pct
            FROM (SELECT count(*) AS total_records,
                         count(*) FILTER (WHERE coalesce({_VALID}, false)) AS valid_records,
                         count(*) FILTER (WHERE {_NULL}) AS null_records,
                         count(*) FILTER (WHERE {_INVALID}) AS invalid_records FROM places)"""),
        "null_count_stats": _q("SELECT count(*) AS total_records, count(geohash) AS records_with_geohash, "
                               "count(*) - count(geohash) AS records_without_geohash FROM pg"),
        "describe_columns": _q("""
            SELECT 'lat' AS "column", count(lat) AS count, round(avg(lat), 6) AS mean,
                   round(stddev_samp(lat), 6) AS stddev, min(lat) AS min, max(lat) AS max FROM places
            UNION ALL
            SELECT 'lng', count(lng), round(avg(lng), 6), round(stddev_samp(lng), 6), min(lng), max(lng)
            FROM places"""),
        "distinct_locations": _q("SELECT DISTINCT city, country FROM places"),
        "distinct_count_with_null": _q("SELECT count(*) AS distinct_geohash FROM (SELECT DISTINCT geohash FROM pg)"),
        "row_counts": _q("SELECT 'places' AS source, count(*) AS rows FROM places "
                         "UNION ALL SELECT 'observations', count(*) FROM obs"),
        "lookup_keys": _q(f"""SELECT DISTINCT city, country, concat_ws(', ', city, country) AS query
            FROM places WHERE {_NULL} AND city IS NOT NULL AND city <> ''
              AND country IS NOT NULL AND country <> ''"""),
        "fill_coordinates": _q(f"SELECT {_PLACE_COLS} FROM filled"),
        "fill_remaining_nulls": _q(f"SELECT count(*) FILTER (WHERE {_NULL}) AS remaining_null_records FROM filled"),
        "json_extract": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
                        "json_extract_string(props, '$.missing') AS missing FROM events",
        "geohash_encode": _q("SELECT id, lat, lng, geohash FROM pg"),
        "geohash_sql_function": _q("SELECT id, lat, lng, geohash FROM pg"),
        "geohash_precision6": _q(f"SELECT event_id, {_d_geohash('lat', 'lng', 6)} AS geohash6, "
                                 f"{_d_geohash('lat', 'lng', 8)} AS geohash8 FROM obs"),
        "geohash_decode": _q(f"""SELECT geohash,
              -90 + (({_d_band('geohash', 'lat')}) + 0.5) * 180.0 / 1024 AS center_lat,
              -180 + (({_d_band('geohash', 'lng')}) + 0.5) * 360.0 / 1024 AS center_lng
            FROM (SELECT DISTINCT geohash FROM og)"""),
        "geohash_neighbors": _q(f""", g AS (
              SELECT DISTINCT geohash, {_d_band('geohash', 'lat')} AS ti, {_d_band('geohash', 'lng')} AS li
              FROM pg WHERE geohash IS NOT NULL),
            fan AS (SELECT geohash, ti, li, unnest([{dirs}]) AS d FROM g),
            nb AS (SELECT geohash, d.direction AS direction, ti + d.dlat AS ti2,
                          ((li + d.dlng) % 1024 + 1024) % 1024 AS li2 FROM fan)
            SELECT geohash, direction, {_d_text('ti2', 'li2', 4)} AS neighbour
            FROM nb WHERE ti2 >= 0 AND ti2 < 1024"""),
        "scan_csv_typed": places_all,
        "cast_columns": places_all,
        "scan_parquet": _q(f"SELECT {_OBS_COLS} FROM obs"),
        "scan_partitioned": _q(f"SELECT {_OBS_COLS} FROM obs WHERE day BETWEEN 10 AND 12"),
        "scan_delimited_ctrl_a": places_all,
        "repair_multiline_records": "SELECT doc_id, lang, source, n_chars, text FROM documents",
        "scan_orc": places_all,
        "ingest_append": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, "
                         "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders",
        "write_partitioned_roundtrip": _q(f"SELECT {_OBS_COLS} FROM obs"),
        "append_mode": places_all,
        "append_rerun": places_all,
        "insert_limited": _q(f"SELECT {_PLACE_COLS} FROM places ORDER BY franchise_name, id LIMIT 25"),
        "verify_partitions": _q("SELECT country, count(*) AS rows_expected, count(*) FILTER (id % 3 > 0) AS rows_actual "
                                "FROM places WHERE country = 'NATION_5' GROUP BY country"),
        "compression_codec": _q("SELECT 'snappy' AS codec, count(*) AS rows FROM places"),
        "bucketed_hot_cell": f"""WITH obs AS (
              SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 30.5 ELSE lat END AS lat,
                     CASE WHEN event_id % 3 = 0 THEN -9.5 ELSE lng END AS lng, avg_tmpr_f, avg_tmpr_c, wthr_date FROM ({OBS_SQL})),
            og AS (SELECT *, {_d_geohash('lat', 'lng')} AS geohash FROM obs), w AS ({_W})
            SELECT wg AS geohash, weather_lat, weather_lng, weather_wthr_date,
                   round(weather_avg_tmpr_f, 6) AS weather_avg_tmpr_f, round(weather_avg_tmpr_c, 6) AS weather_avg_tmpr_c FROM w""",
        "ingest_twice": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
        "scan_delimited_quarantine": """SELECT CAST(o_custkey AS INTEGER) AS customer_number, 'C' || o_orderkey AS check_number,
              strftime(o_orderdate, '%Y-%m-%d') AS payment_date,
              CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) END AS amount,
              CASE WHEN o_orderkey % 7 = 0 THEN o_custkey || '|C' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|n/a' END AS broken
            FROM orders""",
        "scan_order_details": """SELECT CAST(l_orderkey AS INTEGER) AS order_number, 'S' || l_partkey AS product_code,
              CAST(l_quantity AS INTEGER) AS quantity_ordered, CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price_each,
              CAST(l_linenumber AS INTEGER) AS order_line_number FROM lineitem""",
        "scan_products": """SELECT 'S' || p_partkey AS product_code, p_name AS product_name, p_type AS product_line,
              CAST(NULL AS VARCHAR) AS product_scale, p_brand AS product_vendor, 'say "hi"' AS product_description,
              CAST(p_size AS INTEGER) AS quantity_in_stock, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS buy_price FROM part""",
        "scan_offices": """SELECT CAST(s_suppkey AS INTEGER) AS office_code, s_name AS city, '+47 "55"' AS phone,
              CAST(s_nationkey AS VARCHAR) AS address_line1, CAST(NULL AS VARCHAR) AS address_line2, CAST(NULL AS VARCHAR) AS state,
              'Norway  ' AS country, '00100' AS postal_code, 'EMEA' AS territory FROM supplier""",
        "scan_employees": """SELECT CAST(c_custkey AS INTEGER) AS employee_id, c_name AS last_name, c_mktsegment AS first_name,
              'x' || c_nationkey AS extension, c_name || '@example.com' AS email, CAST(c_nationkey AS INTEGER) AS office_code,
              CASE WHEN c_custkey % 10 > 0 THEN CAST(c_custkey - c_custkey % 10 AS INTEGER) END AS reports_to,
              'Sales Rep' AS job_title FROM customer""",
        "geohash_when_absent": _q("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'kept' ELSE geohash END AS geohash FROM og"),
        "lookup_attempts": _q(f"""SELECT city, country, CASE WHEN n % 20 = 0 THEN 1 ELSE 2 END AS questions,
              CASE WHEN n % 20 = 0 THEN 1 ELSE 0 END AS answers,
              CASE WHEN n % 20 = 0 THEN 40.0 + CAST(n AS DOUBLE) / 100 END AS lookup_lat,
              CASE WHEN n % 20 = 0 THEN -5.0 - CAST(n AS DOUBLE) / 100 END AS lookup_lng
            FROM (SELECT DISTINCT city, country, CAST(substr(city, 5, 10) AS INTEGER) AS n FROM places
                  WHERE {_NULL} AND city IS NOT NULL AND city <> '' AND country IS NOT NULL AND country <> '')"""),
        "enrich_incremental": _q(f"SELECT {_ENR} FROM enriched"),
        "dynamic_partition_insert": places_all,
        "bucketed_table": places_all,
        "verify_roundtrip": _q("SELECT count(*) AS rows_written, count(*) AS rows_read, true AS rows_match, "
                               "true AS checksum_match FROM places"),
        "idempotent_rerun": _q("SELECT count(*) AS rows_first, count(*) AS rows_second, true AS same_rows, "
                               "true AS same_checksum FROM places"),
        "partition_inventory": _q("SELECT country, count(*) AS rows, CAST(1 AS BIGINT) AS files FROM places GROUP BY country"),
        "filter_partition_eq": _q(f"SELECT {_PLACE_COLS} FROM places WHERE country = 'NATION_3'"),
        "input_lineage": _q("SELECT country, count(*) AS rows, CAST(1 AS BIGINT) AS files FROM places "
                            "WHERE country IN ('NATION_3', 'NATION_7') GROUP BY country"),
        "inline_values": """SELECT o.o_orderpriority, u.urgency, count(*) AS orders_count
            FROM orders o
            LEFT JOIN (VALUES ('1-URGENT', 'high'), ('2-HIGH', 'high'), ('3-MEDIUM', 'normal'),
                              ('4-NOT SPECIFIED', 'normal'), ('5-LOW', 'low')) AS u(priority, urgency)
              ON o.o_orderpriority = u.priority
            GROUP BY o.o_orderpriority, u.urgency""",
        "insert_values": """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
            UNION ALL SELECT -1, 'Supplier#new-1', 3, 10.5
            UNION ALL SELECT -2, 'Supplier#new-2', NULL, NULL""",
        "select_star_limit": "SELECT * FROM supplier ORDER BY s_suppkey LIMIT 10",
        "project_between_sort": "SELECT s_suppkey, s_name, s_acctbal FROM supplier "
                                "WHERE s_acctbal BETWEEN 1000 AND 6000 ORDER BY s_name DESC, s_suppkey LIMIT 5",
        "group_count_sorted": "SELECT o_orderpriority, count(*) AS orders_count FROM orders "
                              "GROUP BY o_orderpriority ORDER BY orders_count DESC",
        "group_count": _q("SELECT country, count(*) AS customers_n FROM places GROUP BY country"),
        "update_where": _q("SELECT id, franchise_id, franchise_name, restaurant_franchise_id, country, city, "
                           "CASE WHEN coalesce(lat > 35, false) THEN 0.0 ELSE lat END AS lat, lng FROM places"),
        "delete_where": _q(f"SELECT {_PLACE_COLS} FROM places WHERE NOT coalesce(lat > 35, false)"),
        "job_without_lookup": _q(f"SELECT {_ENR} FROM enriched"),
        "enrich_real_shape": _q(f""", {_RW} SELECT {_PLACE_COLS}, geohash, {_RW_COLS} FROM pg
            LEFT JOIN rw ON pg.geohash = rw.wg"""),
        "dedupe_real_shape": _q(f", {_RW} SELECT wg AS geohash, {_RW_COLS} FROM rw"),
        "dedupe_text_dates": _q("""SELECT geohash, arg_min(d, event_id) FILTER (WHERE d IS NOT NULL) AS weather_wthr_date
            FROM (SELECT geohash, event_id, CASE
                    WHEN event_id % 3 = 0 THEN concat(substr(wthr_date, 6, 2), '/', substr(wthr_date, 9, 2), '/', substr(wthr_date, 1, 4))
                    WHEN event_id % 7 = 0 THEN NULL ELSE wthr_date END AS d FROM og)
            WHERE geohash IS NOT NULL GROUP BY geohash"""),
        "dedupe_first_text": _q(f"""SELECT geohash, {_first_cols(["condition", "wind_direction", "city", "temperature_c"])}
            FROM (SELECT geohash, event_id, avg_tmpr_c AS temperature_c, concat('City', CAST(event_id % 50 AS VARCHAR)) AS city,
                         CASE WHEN event_id % 5 <> 0 THEN {CONDITIONS!r}[event_id % 7 + 1] END AS condition,
                         CASE WHEN event_id % 3 <> 0 THEN {WIND_DIRECTIONS!r}[event_id % 8 + 1] END AS wind_direction
                  FROM og) WHERE geohash IS NOT NULL GROUP BY geohash"""),
        "fill_duplicate_keys": _q(f"SELECT {_PLACE_COLS} FROM filled"),
        "lookup_from_places": _q(f"""SELECT city, country, round(avg(lat), 6) AS lookup_lat, round(avg(lng), 6) AS lookup_lng
            FROM places WHERE {_VALID} AND city IS NOT NULL AND city <> '' AND country IS NOT NULL AND country <> ''
            GROUP BY city, country"""),
        "json_path_array": _q("""SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN lat END AS lat,
            CASE WHEN event_id % 10 <> 0 THEN lng END AS lng FROM obs"""),
        "overwrite_replaces_all": _q(f"SELECT {_PLACE_COLS} FROM places WHERE country NOT IN ('NATION_3', 'NATION_4')"),
        "partition_value_types": _q("SELECT id, city, lpad(CAST(franchise_id AS VARCHAR), 3, '0') AS code FROM places"),
        "update_partitioned": _q("""SELECT id, franchise_id, franchise_name, restaurant_franchise_id, country,
            CASE WHEN country = 'NATION_3' AND id % 2 = 0 THEN 'moved' ELSE city END AS city, lat, lng FROM places
            WHERE NOT coalesce(country = 'NATION_7' AND lat > 35, false)"""),
        "mutation_chain": """
            SELECT s_suppkey, s_name, s_nationkey,
                   CASE WHEN s_acctbal < 5000 AND s_nationkey = 3 THEN 9000.0 ELSE s_acctbal END AS s_acctbal
            FROM supplier WHERE s_nationkey IS DISTINCT FROM 7""",
        "synth_observations": _synth_sql(),
    }
