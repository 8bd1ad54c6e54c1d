"""Explicit schemas: no inference pass over the data."""

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()

# Places (restaurants) as read from CSV.
PLACES = _s(("id", L), ("franchise_id", I), ("franchise_name", S), ("restaurant_franchise_id", I),
            ("country", S), ("city", S), ("lat", D), ("lng", D))

# Observations (weather), real shape; partition columns year/month/day come from directories.
OBSERVATIONS = _s(("lng", D), ("lat", D), ("avg_tmpr_f", D), ("avg_tmpr_c", D), ("wthr_date", S))

# Synthetic observations written by the generator.
SYNTH_OBSERVATIONS = _s(("lat", D), ("lng", D), ("geohash", S), ("temperature_c", D), ("humidity_pct", I),
                        ("pressure_mb", D), ("wind_speed_kmh", D), ("wind_direction", S), ("condition", S),
                        ("observation_date", S), ("city", S), ("country", S))

# Coordinate lookup table, keyed by (city, country).
LOOKUP = _s(("city", S), ("country", S), ("lookup_lat", D), ("lookup_lng", D))

# Questions asked for the lookup table, with their answers and outcome (found, none, error).
ATTEMPTS = _s(*[(f.name, f.dataType) for f in LOOKUP.fields], ("outcome", S), ("asked_at", TimestampType()))

# The six control-A delimited tables of the sample sales database.
CUSTOMERS = _s(("customer_id", I), ("business_name", S), ("last_name", S), ("first_name", S),
               ("phone_number", S), ("address_line1", S), ("address_line2", S), ("city", S), ("state", S),
               ("postal_code", S), ("country", S), ("country_code", I), ("credit_limit", DecimalType(15, 2)))
EMPLOYEES = _s(("employee_id", I), ("last_name", S), ("first_name", S), ("extension", S), ("email", S),
               ("office_code", I), ("reports_to", I), ("job_title", S))
OFFICES = _s(("office_code", I), ("city", S), ("phone", S), ("address_line1", S), ("address_line2", S),
             ("state", S), ("country", S), ("postal_code", S), ("territory", S))
ORDERDETAILS = _s(("order_number", I), ("product_code", S), ("quantity_ordered", I),
                  ("price_each", DecimalType(10, 2)), ("order_line_number", I))
PAYMENTS = _s(("customer_number", I), ("check_number", S), ("payment_date", DateType()),
              ("amount", DecimalType(10, 2)))
PRODUCTS = _s(("product_code", S), ("product_name", S), ("product_line", S), ("product_scale", S),
              ("product_vendor", S), ("product_description", S), ("quantity_in_stock", I),
              ("buy_price", DecimalType(10, 2)), ("msrp", DecimalType(10, 2)))

# Small bucketed ORC table of the update/delete exercise.
MY_EMP = _s(("id", I), ("name", S), ("salary", I))
