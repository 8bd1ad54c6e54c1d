"""The reduction: one scan, no sort, and the same values as sorting every key's rows."""

import random

import pytest
from pyspark.sql import functions as F

from geoweave.operators import dedupe as dd
from geoweave.operators import enrich as en
from geoweave.sources import testdata as td
from scripts.plan_lint import executed_scans, shuffle_records

SF = "/root/testdata/sf0.001"
NAN = float("nan")


def _brute(rows, key, order, columns):
    """First non-null value per column after sorting by ``order`` (None first), ties by the value."""
    def rank(v):
        return (v is not None, (v != v, 0 if v != v else v) if isinstance(v, float) else v) if v is not None else (False,)
    out = {}
    for k in {r[key] for r in rows}:
        own = [r for r in rows if r[key] == k]
        out[k] = tuple(next((r[c] for r in sorted((r for r in own if r[c] is not None), key=lambda r: (*map(rank, (r[o] for o in order)), rank(r[c])))), None)
                       for c in columns)
    return out


def _first(df, key, order, columns, **kw):
    return {r[0]: tuple(r[1:]) for r in dd.dedupe_first(df, key, order, columns, **kw).collect()}


def _rows(n, seed, coordinate, date):
    rng = random.Random(seed)
    return [{"k": 0 if rng.random() < 0.35 else rng.randrange(12), "d": date(rng), "x": coordinate(rng), "y": coordinate(rng),
             "t": rng.choice([None, "a", "b", "a rather long text"]), "v": rng.choice([None, 1.5, 2.5, -3.0])} for _ in range(n)]


def _iso(rng):
    return rng.choice([None, *[f"2024-01-{d:02d}" for d in range(1, 5)]])


SHAPES = {
    "two decimals": (lambda r: round(r.uniform(-170, 170), 2) if r.random() < 0.9 else None, _iso),
    "full precision": (lambda r: r.uniform(-1e-3, 1e-3), _iso),
    "neighbouring doubles": (lambda r: 0.1 + r.randrange(3) * 2.0 ** -56, _iso),
    "few values": (lambda r: r.choice([None, 0.0, 0.25, -0.17, -0.16999999999999993]), _iso),
    "dates that are none": (lambda r: round(r.uniform(-9, 9), 3),
                            lambda r: r.choice(["2024-01-02", "01/02/2024", "", "0000-00-00", None, "2024-01-02T00"])),
    "out of range": (lambda r: r.choice([400.0, -181.0, 12.5, NAN, None, float("inf")]), _iso),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_content_order_equals_sorting(spark, shape):
    rows = _rows(600, 7, *SHAPES[shape])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "k int, d string, x double, y double, t string, v double")
    order = ["d", "x", "y", "t", "v"]
    for columns in (["x", "y", "d"], ["v", "t", "y"], order):
        want = _brute(rows, "k", order, columns)
        for part in (df.repartition(5), df.orderBy(F.rand(3))):
            got = _first(part, "k", order, columns)
            assert {k: tuple("nan" if v != v else v for v in t) for k, t in got.items()} == \
                {k: tuple("nan" if v != v else v for v in t) for k, t in want.items()}
        assert _first(df, "k", order, columns, null_keys=False, max_keys=100).keys() == want.keys()
    plan = dd.dedupe_first(df, "k", order, ["x", "y", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_order_without_packed_columns(spark):
    rows = _rows(300, 3, SHAPES["few values"][0], _iso)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "k int, d string, x double, y double, t string, v double")
    for order in (["x", "y"], ["t", "x"], ["v"], ["d"], ["x", "t", "y"]):
        full = [*order, *[c for c in ("d", "t", "v", "x", "y") if c not in order]]
        assert _first(df, "k", full, ["x", "y", "t"]) == _brute(rows, "k", full, ["x", "y", "t"])


def test_text_codes_are_lossless(spark):
    texts = ["", "a", "1", "Sunny", "Partly Cloudy", "2024-02-30", "0000-00-00", "9999-12-31", "2024-1-01", "2024-01-01\n", "héé",
             "ünï", "\x00", "\x00\x00a", "1234567", "12345678", "日本", "日本語", " ", "-", "+1", "2024-01-0１", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    got = {r.i: r for r in df.select("i", "t", dd.text_code(F.col("t")).alias("c"), dd.text_of(dd.text_code(F.col("t"))).alias("b")).collect()}
    for i, t in enumerate(texts):
        short = t is not None and (len(t.encode()) <= 7 or t in ("2024-02-30", "0000-00-00", "9999-12-31"))
        assert got[i].b == (t if short else None)
        assert (got[i].c is None) == (t is None) and (short or t is None or got[i].c == 0)
    # and as first values, where the codes do not reach too
    rows = [(i % 4, i, t) for i, t in enumerate(texts * 3)]
    d = spark.createDataFrame(rows, "k int, o int, t string").repartition(4)
    want = {}
    for k, _, t in rows:
        want.setdefault(k, t) if t is not None else None
    assert {k: v[0] for k, v in _first(d, "k", "o", ["t"]).items()} == want


def test_ties_of_the_order_key_give_one_of_the_tied_values(spark):
    d = spark.createDataFrame([(1, 5, "a long text, b"), (1, 5, "a long text, a"), (1, 6, "later"), (2, 1, "x"), (2, 1, "y")], "k int, o int, t string")
    got = {k: v[0] for k, v in _first(d, "k", "o", ["t"]).items()}
    assert got[1] in ("a long text, a", "a long text, b") and got[2] in ("x", "y")
    # a list of columns has no ties: equal order, then the value
    assert {k: v[0] for k, v in _first(d, "k", ["o"], ["t"]).items()} == {1: "a long text, a", 2: "x"}


def test_null_key_is_a_group(spark):
    d = spark.createDataFrame([(None, 2, "a text that is long"), (None, 1, None), (1, 1, "z")], "k int, o int, t string")
    assert _first(d, "k", "o", ["t"]) == {None: ("a text that is long",), 1: ("z",)}
    assert _first(d, "k", ["o"], ["t"]) == {None: ("a text that is long",), 1: ("z",)}


@pytest.mark.parametrize("shape", ["unique key", "no key"])
def test_enrichment_scans_the_observations_once(spark, tmp_path, shape):
    p, o = td.places(spark, SF), td.observations(spark, SF)
    path = str(tmp_path / "obs")
    o = o.withColumn("lat", F.round("lat", 2)).withColumn("lng", F.round("lng", 2))  # decimals, as files have them
    (o if shape == "unique key" else o.drop("event_id")).write.parquet(path)
    df = en.enrich(p, spark.read.parquet(path))
    assert len(df.collect()) == p.count()
    assert executed_scans(df, "avg_tmpr_c") == 1
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_short_texts_need_no_second_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4000).select((F.col("id") % 20).alias("k"), F.col("id").alias("o"), F.lit("Sunny").alias("a"),
                             F.concat(F.lit("a long text "), F.col("id").cast("string")).alias("b")).write.parquet(path)
    df = spark.read.parquet(path)
    one = dd.dedupe_first(df, "k", "o", ["a"], max_keys=20)
    two = dd.dedupe_first(df, "k", "o", ["a", "b"], max_keys=20)
    assert {tuple(r) for r in one.collect()} == {(k, "Sunny") for k in range(20)}
    assert {tuple(r) for r in two.collect()} == {(k, "Sunny", f"a long text {k}") for k in range(20)}
    assert executed_scans(one, "a") == 1 and executed_scans(two, "a") == 2


def test_hot_cell_is_spread_over_files_and_reduced_from_partials(spark, tmp_path):
    n, buckets, salts = 90_000, 12, 6
    hot = F.col("id") % 3 == 0
    obs = spark.range(0, n, numPartitions=6).select(
        F.col("id").alias("event_id"), F.when(hot, 40.71).otherwise(30.0 + (F.col("id") * 6007 % 800) / 100).alias("lat"),
        F.when(hot, -74.01).otherwise(-10.0 + (F.col("id") * 6011 % 997) / 100).alias("lng"),
        (F.col("id") % 40).cast("double").alias("avg_tmpr_c"), F.lit("2024-01-01").alias("wthr_date")) \
        .withColumn("avg_tmpr_f", F.col("avg_tmpr_c") * 2)
    t = en.bucket_observations(obs, "obs_salted", str(tmp_path / "obs_salted"), buckets=buckets, salts=salts)
    files = t.where("lat = 40.71").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < n / 6  # the hot third is in no one file
    r = en.reduce_observations(t)
    got = sorted(map(tuple, r.collect()))
    assert got == sorted(map(tuple, en.reduce_observations(obs).select(*r.columns).collect()))
    assert max(shuffle_records(r)) <= len(got) * salts  # partial rows only
    spark.sql("DROP TABLE obs_salted")
