"""Geohash column functions: known vectors, edges, properties."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoweave.functions import geohash as G

ALPHA = "0123456789bcdefghjkmnpqrstuvwxyz"


def bisect_encode(lat, lng, p):
    """Plain bisection encoder used only as a test oracle."""
    lat = min(max(lat, -90 + 1e-9), 90 - 1e-9)
    lng = min(max(lng, -180 + 1e-9), 180 - 1e-9)
    lo_t, hi_t, lo_l, hi_l = -90.0, 90.0, -180.0, 180.0
    bits, out, even = [], [], True
    while len(out) < p:
        if even:
            mid = (lo_l + hi_l) / 2
            if lng >= mid:
                bits.append(1)
                lo_l = mid
            else:
                bits.append(0)
                hi_l = mid
        else:
            mid = (lo_t + hi_t) / 2
            if lat >= mid:
                bits.append(1)
                lo_t = mid
            else:
                bits.append(0)
                hi_t = mid
        even = not even
        if len(bits) == 5:
            out.append(ALPHA[int("".join(map(str, bits)), 2)])
            bits = []
    return "".join(out)


def encode_rows(spark, rows, p=4):
    df = spark.createDataFrame(rows, "lat double, lng double")
    return [r.g for r in df.select(G.geohash("lat", "lng", p).alias("g")).collect()]


def test_known_cities(spark):
    g = encode_rows(spark, [(40.7128, -74.0060), (48.8566, 2.3522), (51.5074, -0.1278)])
    assert g[0] == "dr5r"
    assert g[1].startswith("u09") and g[1] == "u09t"
    assert g[2] == "gcpv"


def test_null_and_out_of_range(spark):
    rows = [(None, 0.0), (0.0, None), (None, None), (91.0, 0.0), (-91.0, 0.0), (0.0, 181.0),
            (0.0, -181.0), (float("nan"), 0.0), (0.0, float("nan"))]
    assert encode_rows(spark, rows) == [None] * len(rows)


def test_bounds_encode(spark):
    g = encode_rows(spark, [(90.0, 0.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -180.0), (0.0, 0.0)])
    assert g == ["upbp", "h000", "xbpb", "8000", "s000"]


def test_precision_prefix(spark):
    df = spark.createDataFrame([(40.7128, -74.0060)], "lat double, lng double")
    r = df.select(*[G.geohash("lat", "lng", p).alias(f"g{p}") for p in (4, 6, 8, 12)]).first()
    assert len(r.g6) == 6 and len(r.g8) == 8 and len(r.g12) == 12
    assert r.g6 == "dr5reg" and r.g8.startswith(r.g6) and r.g12.startswith(r.g8) and r.g6.startswith(r.g4)


def test_precision_range():
    with pytest.raises(ValueError):
        G.bit_split(0)
    with pytest.raises(ValueError):
        G.bit_split(13)


def test_decode(spark):
    df = spark.createDataFrame([("dr5r",), ("",), (None,), ("DR5R",), ("a1",)], "g string")
    r = df.select(G.decode("g").alias("d")).collect()
    assert (r[0].d.lat, r[0].d.lng) == (40.693359375, -74.00390625)
    assert 40 < r[0].d.lat < 41 and -75 < r[0].d.lng < -73
    for i in (1, 2, 4):  # empty, NULL, invalid -> (None, None)
        assert (r[i].d.lat, r[i].d.lng) == (None, None)
    assert r[3].d == r[0].d


def test_neighbours(spark):
    df = spark.createDataFrame([("dr5r",), ("",), ("upbp",), ("xbpb",)], "g string")
    r = df.select(G.neighbours("g").alias("m")).collect()
    assert r[0].m == {"n": "dr72", "ne": "dr78", "e": "dr5x", "se": "dr5w",
                      "s": "dr5q", "sw": "dr5n", "w": "dr5p", "nw": "dr70"}
    assert r[1].m == {}
    assert set(r[2].m) == {"e", "se", "s", "sw", "w"}
    assert r[3].m["e"] == "8000"


def test_explode_neighbours_matches_map(spark):
    df = spark.createDataFrame([("dr5r",), ("upbp",), ("bad!",), (None,), ("u09tvw",)], "g string")
    long = {(r.g, r.direction, r.neighbour) for r in G.explode_neighbours(df, "g").collect()}
    via_map = {(r.g, k, v) for r in df.select("g", G.neighbours("g").alias("m")).collect()
               for k, v in (r.m or {}).items()}
    assert long == via_map and len(long) == 8 + 5 + 8


def test_sql_function_agrees(spark):
    G.register_sql_functions(spark, 5, "gh5_test")
    df = spark.range(0, 2000).select(((F.col("id") * 37 % 1801) / 10.0 - 90).alias("lat"),
                                     ((F.col("id") * 91 % 3601) / 10.0 - 180).alias("lng"))
    df.createOrReplaceTempView("pts_test")
    a = df.select(G.geohash("lat", "lng", 5).alias("g"))
    b = spark.sql("SELECT gh5_test(lat, lng) AS g FROM pts_test")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cell_roundtrip(spark):
    df = spark.createDataFrame([(40.7128, -74.0060), (-33.9, 151.2)], "lat double, lng double")
    for p in (1, 4, 7, 12):
        r = df.select(G.cell_id("lat", "lng", p).alias("c"), G.geohash("lat", "lng", p).alias("g")) \
              .select("c", "g", G.geohash_to_cell("g", p).alias("c2"), G.cell_to_geohash("c", p).alias("g2")).collect()
        for x in r:
            assert x.c == x.c2 and x.g == x.g2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-90, 90, allow_nan=False), st.floats(-180, 180, allow_nan=False)),
                min_size=1, max_size=60),
       st.integers(1, 12))
def test_matches_bisection_and_cell_contains_point(spark, pts, p):
    df = spark.createDataFrame(pts, "lat double, lng double")
    rows = df.select("lat", "lng", G.geohash("lat", "lng", p).alias("g")) \
             .select("lat", "lng", "g", G.decode("g").alias("d")).collect()
    nl, nt = G.bit_split(p)
    for r in rows:
        assert r.g == bisect_encode(r.lat, r.lng, p)
        half_t, half_l = 90.0 / 2 ** nt, 180.0 / 2 ** nl
        assert abs(r.d.lat - r.lat) <= half_t + 1e-9 and abs(r.d.lng - r.lng) <= half_l + 1e-9


def test_neighbour_symmetry(spark):
    df = spark.range(0, 300).select(((F.col("id") * 7 % 160) - 80.0 + 0.123).alias("lat"),
                                    ((F.col("id") * 13 % 350) - 175.0 + 0.456).alias("lng"))
    g = df.select(G.geohash("lat", "lng", 4).alias("g")).distinct()
    n = g.select("g", G.neighbours("g").alias("m")).select(
        "g", F.col("m")["n"].alias("n"), F.col("m")["e"].alias("e"))
    back = n.select("g", G.neighbours("n")["s"].alias("n_s"), G.neighbours("e")["w"].alias("e_w"))
    assert back.where("n_s <> g OR e_w <> g").count() == 0


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "lat double, lng double")
    plan = df.select(G.geohash("lat", "lng"), G.decode(G.geohash("lat", "lng")))._jdf.queryExecution() \
             .executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_math_of_band_width():
    nl, nt = G.bit_split(4)
    assert (nl, nt) == (10, 10)
    assert math.isclose(360 / 2 ** nl, 0.3515625)


def test_geohash_to_cell_uses_prefix_of_finer_geohash(spark):
    df = spark.createDataFrame([("dr5reg",), ("dr5r",), ("dr5",), ("dr5r!x",), ("DR5REG",)], "g string")
    got = [r.c for r in df.select(G.geohash_to_cell("g", 4, fit="prefix").alias("c")).collect()]
    assert got[0] == got[1] == got[4] == 761133 and got[2] is None and got[3] is None


def test_neighbour_cells_match_text_neighbours(spark):
    df = spark.createDataFrame([(40.7128, -74.006), (89.99, 0.0), (0.0, 179.99)], "lat double, lng double")
    rows = df.select(G.geohash("lat", "lng", 5).alias("g"), G.cell_id("lat", "lng", 5).alias("c")) \
             .select("g", F.transform(G.neighbour_cells("c", 5), lambda x: G.cell_to_geohash(x, 5)).alias("nb"),
                     G.neighbours("g").alias("m")).collect()
    for r in rows:
        assert sorted(r.nb) == sorted(r.m.values())
