"""Quality checks, dedupe and the enrichment join: behaviour, invariants, plan shape."""

from pyspark.sql import functions as F

from geoweave.operators import dedupe as dd
from geoweave.operators import enrich as en
from geoweave.operators import quality as dq
from geoweave.plans import report as rp
from geoweave.sinks.files import checksum

from geo_cells import cell_text


def test_quality_counts(places):
    assert dq.null_or_invalid(places).count() == 2
    assert dq.null_only(places).count() == 1
    assert dq.invalid_only(places).count() == 1
    assert dq.valid_only(places).count() == 3
    s = dq.quality_summary(places).first()
    assert (s.total_records, s.valid_records, s.null_records, s.invalid_records) == (5, 3, 1, 1)
    assert (s.valid_pct, s.null_pct, s.invalid_pct) == (60.0, 20.0, 20.0)


def test_quality_summary_empty_input(places):
    s = dq.quality_summary(places.limit(0)).first()
    assert s.total_records == 0 and s.valid_pct is None


def test_distinct_count_counts_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "g string")
    assert dq.distinct_count_with_null(df, "g").first()[0] == 3 == df.select("g").distinct().count()


def test_describe_columns(places):
    rows = {r.column: r for r in dq.describe_columns(places, ["lat", "lng"]).collect()}
    assert rows["lat"]["count"] == 4 and rows["lat"]["max"] == 95.5 and rows["lng"]["min"] == -8.61


def test_left_join_keeps_rows_test_shape(places, obs_test_shape):
    out = en.enrich(places, obs_test_shape, mode="first")
    assert out.count() == 5
    got = {r.id: r for r in out.collect()}
    assert all(got[i].weather_temperature_c is not None for i in (1, 2, 3))
    assert got[4].weather_temperature_c is None and got[5].weather_temperature_c is None
    assert got[1].geohash == cell_text(41.15, -8.61) and got[4].geohash is None
    assert set(places.columns) <= set(out.columns)
    assert got[1].weather_observation_date == "2023-05-11"


def test_left_join_real_shape_avg(places, obs_real_shape):
    out = en.enrich(places, obs_real_shape).collect()
    r = {x.id: x for x in out}
    assert len(out) == 5 and r[1].weather_avg_tmpr_c == 17.5 and r[1].weather_wthr_date == "2023-05-11"
    assert round(r[1].weather_avg_tmpr_f, 6) == round(17.5 * 9 / 5 + 32, 6)


def test_hot_cell_skew_and_first_semantics(spark, places):
    # one cell holds most rows; NULLs in the earliest rows must be skipped per column
    rows = [(i, 41.16, -8.62, None if i < 3 else float(i), None if i == 0 else f"2024-01-{(i % 28) + 1:02d}")
            for i in range(5000)]
    rows += [(10000, 52.08, 5.11, 1.0, "2024-02-01")]
    obs = spark.createDataFrame(rows, "event_id long, lat double, lng double, avg_tmpr_c double, wthr_date string")
    obs = obs.withColumn("avg_tmpr_f", F.col("avg_tmpr_c") * 9 / 5 + 32).repartition(7)
    r = {x.id: x for x in en.enrich(places, obs).collect()}
    assert r[1].weather_wthr_date == "2024-01-02"  # first non-null date: event 1
    assert r[1].weather_lat == 41.16
    assert abs(r[1].weather_avg_tmpr_c - sum(range(3, 5000)) / 4997) < 1e-9
    f = en.reduce_observations(obs, mode="first", columns=["avg_tmpr_c", "wthr_date"]).collect()
    first = {x.weather_wthr_date: x.weather_avg_tmpr_c for x in f}
    assert first["2024-01-02"] == 3.0  # from different rows, each column's own first non-null


def test_rerun_is_deterministic_under_shuffled_input(spark, places):
    obs = spark.range(0, 20000).select(
        F.col("id").alias("event_id"), (F.lit(40.0) + (F.col("id") % 97) / 100.0).alias("lat"),
        (F.lit(-74.5) + (F.col("id") % 89) / 100.0).alias("lng"),
        (F.col("id") % 31).cast("double").alias("avg_tmpr_c"),
        F.format_string("2024-01-%02d", (F.col("id") % 28 + 1).cast("int")).alias("wthr_date"))
    obs = obs.withColumn("avg_tmpr_f", F.col("avg_tmpr_c") * 2)

    def digest(o):
        out = en.reduce_observations(o, mode="first", columns=["lat", "lng", "avg_tmpr_c", "wthr_date"])
        return out.agg(checksum(out.columns)).first()[0]

    a = digest(obs)
    b = digest(obs.repartition(13).orderBy(F.rand(3)))
    c = digest(obs.repartition(3, "wthr_date"))
    assert a == b == c


def test_semi_join_reduction_does_not_change_result(spark):
    from geoweave.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    p, o = td.places(spark, sf), td.observations(spark, sf)
    a, b = en.enrich(p, o, reduce=True), en.enrich(p, o, reduce=False)
    assert a.agg(checksum(a.columns)).first()[0] == b.agg(checksum(b.columns)).first()[0]
    assert a.count() == p.count()


def test_plan_shape(spark):
    from geoweave.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    df = en.enrich(td.places(spark, sf), td.observations(spark, sf))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert "LeftSemi" in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    # the observation scan reads only the columns it needs
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in scan and "user_id" not in scan


def test_matching_cells_null_is_member_and_distinct_first(spark, places):
    obs = spark.createDataFrame([(None, None), (41.16, -8.62), (41.16, -8.62), (0.0, 0.0)], "lat double, lng double")
    got = {r.geohash for r in rp.matching_cells(places, obs).collect()}
    assert got == {None, cell_text(41.15, -8.61)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rp.matching_cells(places, obs)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    aggregates = [i for i, line in enumerate(plan) if "HashAggregate" in line]
    assert at and all(any(a > i for a in aggregates) for i in at)  # an aggregate lies below every exchange


def test_reports(places, obs_real_shape):
    e = en.enrich(places, obs_real_shape)
    s = rp.join_stats(e).first()
    assert (s.total_records, s.matched_records, s.unmatched_records, s.matched_pct) == (5, 3, 2, 60.0)
    summary = {r.metric: r.value for r in rp.run_summary(places, obs_real_shape).collect()}
    assert summary["places_total"] == 5 and summary["matched"] == 3 and summary["matching_geohashes"] == 3
    assert summary["place_geohashes"] == 4  # three cells + NULL
    t = rp.top_cells(obs_real_shape, 2).collect()
    assert len(t) == 2 and all(r["count"] == 1 for r in t)


def test_summary_null_cell_on_both_sides(spark, places):
    obs = spark.createDataFrame([(1, None, None, 1.0, "2024-01-01"), (2, 41.16, -8.62, 2.0, "2024-01-02")],
                                "event_id long, lat double, lng double, avg_tmpr_c double, wthr_date string")
    s = {r.metric: r.value for r in rp.run_summary(places, obs).collect()}
    # NULL geohash is on both sides: it counts in the overlap, never as an enriched match
    assert s["matching_geohashes"] == 2 and s["matched"] == 1 and s["observation_geohashes"] == 2
    assert rp.date_range(obs).first() == ("2024-01-01", "2024-01-02")


def test_fine_precision_and_size_bounds(spark):
    from geoweave.operators import sizing
    from geoweave.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    p, o = td.places(spark, sf), td.observations(spark, sf)
    a = en.enrich(p, o, precision=6, reduce=True)
    b = en.enrich(p, o, precision=6, reduce=False)
    assert a.agg(checksum(a.columns)).first()[0] == b.agg(checksum(b.columns)).first()[0]
    cells, obs = en.place_cells(p, 6), en.add_cell(o, 6)
    wide = cells.select("*", *[F.lit(1.0).alias(f"c{i}") for i in range(400)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only an explicit hint may broadcast

    def broadcast(side, rows):
        j = obs.join(sizing.broadcast_if_bounded(side, rows), en.CELL, "left_semi")
        return "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()
    try:
        assert broadcast(cells, 32 ** 4) and not broadcast(cells, 32 ** 6)
        assert not broadcast(wide, 32 ** 4)  # bytes count, not rows
        assert not broadcast(cells.withColumn("t", F.lit("text")), 10)  # no width, no bound
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_building_a_plan_starts_no_job(spark):
    from geoweave.operators import lookup as lk
    from geoweave.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    p, o = td.places(spark, sf), td.observations(spark, sf)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        en.enrich(p, o, precision=6)
        lk.fill_coordinates(p, lk.lookup_from_places(p))
        rp.run_summary(p, o)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_real_shape_needs_no_key_and_reads_used_columns(spark, places, tmp_path):
    rows = [(41.16, -8.62 + (i % 3) / 1000, float(i % 5), f"2023-0{i % 3 + 1}-01", "unused" * 9) for i in range(400)]
    obs = spark.createDataFrame(rows, "lat double, lng double, avg_tmpr_c double, wthr_date string, extra string") \
        .withColumn("avg_tmpr_f", F.col("avg_tmpr_c") * 2)
    path = str(tmp_path / "real")
    obs.write.parquet(path)

    def digest(o):
        out = en.reduce_observations(o)
        return out.agg(checksum(out.columns)).first()[0]
    back = spark.read.parquet(path)
    assert digest(back) == digest(back.orderBy(F.rand(5))) == digest(back.repartition(7, "lng"))
    plan = en.enrich(places, back)._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan
    r = {x.id: x for x in en.enrich(places, back).collect()}
    assert (r[1].weather_wthr_date, r[1].weather_lng) == ("2023-01-01", -8.62)


def test_first_text_values_without_a_sort(spark):
    df = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("o"),
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("t"), F.col("id").cast("string"))).alias("a"),
        F.when(F.col("id") % 7 > 2, F.lit("x")).alias("b"), (F.col("id") % 11).alias("n"))
    out = dd.dedupe_first(df, "k", "o", ["a", "b", "n"])
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.o):
        w = want.setdefault(r.k, [None, None, None])
        for i, c in enumerate((r.a, r.b, r.n)):
            w[i] = c if w[i] is None else w[i]
    assert {r.k: [r.a, r.b, r.n] for r in out.collect()} == want


def test_stored_geohash_of_another_length(spark):
    import pytest
    df = spark.createDataFrame([("u4pruyd",), (None,), ("??",)], "geohash string")
    with pytest.raises(Exception, match="does not have 4 characters"):
        en.add_cell(df, 4).collect()
    assert [r[en.CELL] is None for r in en.add_cell(df, 4, fit="prefix").collect()] == [False, True, True]


def test_hot_cell_is_combined_before_the_shuffle(spark):
    """A cell holding a third of all rows crosses the shuffle as at most one row per map task."""
    from scripts.plan_lint import shuffle_records
    n, tasks = 240_000, 8
    hot = F.col("id") % 3 == 0
    obs = spark.range(0, n, numPartitions=tasks).select(
        F.col("id").alias("event_id"),
        F.when(hot, F.lit(40.71)).otherwise(F.lit(30.0) + (F.col("id") * 6007 % 800) / 100).alias("lat"),
        F.when(hot, F.lit(-74.01)).otherwise(F.lit(-10.0) + (F.col("id") * 6011 % 997) / 100).alias("lng"),
        (F.col("id") % 40).cast("double").alias("avg_tmpr_c"), F.lit("2024-01-01").alias("wthr_date"),
    ).withColumn("avg_tmpr_f", F.col("avg_tmpr_c") * 2)
    r = en.reduce_observations(obs)
    cells = len(r.collect())
    written = shuffle_records(r)
    # the reduction, and the winning rows' keys and texts: none moves more than a row per task and cell
    assert written and max(written) <= tasks * cells and sum(written) < n // 10


def test_dedupe_matches_brute_force(spark):
    """first-non-null-by-order and averages equal a plain pandas computation on random data."""
    import random

    import pandas as pd
    rnd = random.Random(11)
    order = list(range(3000))
    rnd.shuffle(order)
    rows = []
    for o in order:
        k = 0 if rnd.random() < 0.35 else rnd.randrange(40)  # key 0 holds about a third of the rows
        v = None if rnd.random() < 0.3 else rnd.uniform(-5, 5)
        s = None if rnd.random() < 0.2 else f"2024-02-{rnd.randrange(1, 29):02d}"
        rows.append((k, o, v, s))
    df = spark.createDataFrame(rows, "k int, o long, v double, s string").repartition(6)
    first = {r.k: (r.v, r.s) for r in dd.dedupe_first(df, "k", "o", ["v", "s"]).collect()}
    avg = {r.k: (r.f_s, r.f_v) for r in
           dd.dedupe_avg(df, "k", "o", ["v"], ["s"], prefix="f_").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "o", "v", "s"]).sort_values("o")
    for k, g in pdf.groupby("k"):
        v, s = g["v"].dropna(), g["s"].dropna()
        exp_v, exp_s = (v.iloc[0] if len(v) else None), (s.iloc[0] if len(s) else None)
        assert first[k] == (exp_v, exp_s)
        assert avg[k][0] == exp_s
        assert (avg[k][1] is None and not len(v)) or abs(avg[k][1] - v.mean()) < 1e-9


def test_quality_classes_partition_every_row(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    coord = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True),
                      st.sampled_from([90.0, -90.0, 180.0, -180.0, 90.0000001, -180.0000001]))

    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.tuples(coord, coord), min_size=1, max_size=80))
    def check(pts):
        df = spark.createDataFrame(pts, "lat double, lng double")
        s = dq.quality_summary(df).first()
        assert s.valid_records + s.null_records + s.invalid_records == s.total_records == len(pts)
        exp_valid = sum(1 for a, b in pts if a is not None and b is not None and a == a and b == b
                        and -90 <= a <= 90 and -180 <= b <= 180)
        assert s.valid_records == exp_valid
        assert s.null_records == sum(1 for a, b in pts if a is None or b is None)

    check()


def test_avg_mode_without_date_column(spark, places, obs_real_shape):
    out = en.enrich(places, obs_real_shape.drop("wthr_date")).collect()
    r = {x.id: x for x in out}
    assert len(out) == 5 and r[1].weather_avg_tmpr_c == 17.5 and "weather_wthr_date" not in out[0].asDict()


def test_golden_figures_sf001(spark):
    """Figures recorded for the sf0.01 tables in the survey's probe."""
    from geoweave.sources import testdata as td
    sf = "/root/testdata/sf0.01"
    p, o = td.places(spark, sf), td.observations(spark, sf)
    s = dq.quality_summary(p).first()
    assert (s.total_records, s.null_records, s.invalid_records) == (1500, 150, 80)
    e = en.enrich(p, o)
    assert e.count() == 1500
    assert e.where("geohash IS NULL").count() == 230
    assert rp.join_stats(e).first().matched_records == 1030
    kept = en.add_cell(o).join(en.place_cells(p), en.CELL, "left_semi").count()
    assert kept == 7032
    assert p.select("city", "country").distinct().count() == 861


def test_bucketed_observations_reduce_without_shuffle(spark, places, tmp_path):
    from geoweave.sources import testdata as td
    o = td.observations(spark, "/root/testdata/sf0.001")
    t = en.bucket_observations(o, "obs_by_cell", str(tmp_path / "obs_by_cell"), precision=4, buckets=8)
    r = en.reduce_observations(t, keep_cells=None)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "HashAggregate" in plan
    a = sorted(map(tuple, r.select(*sorted(r.columns)).collect()))
    b = sorted(map(tuple, en.reduce_observations(o).select(*sorted(r.columns)).collect()))
    assert a == b
    p = td.places(spark, "/root/testdata/sf0.001")
    e1, e2 = en.enrich(p, t), en.enrich(p, o)
    assert e1.exceptAll(e2).count() == 0 and e2.exceptAll(e1).count() == 0
    spark.sql("DROP TABLE obs_by_cell")


def test_validity_filter_reaches_the_parquet_scan(spark, places, obs_real_shape, tmp_path):
    path = str(tmp_path / "obs_parquet")
    obs_real_shape.withColumn("unused_wide", F.lit("x" * 50)).write.parquet(path)
    e = en.enrich(places, spark.read.parquet(path))
    plan = e._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "avg_tmpr_c" in ln][0]
    pushed = scan[scan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(lat,-90.0)" in pushed and "IsNotNull(lng)" in pushed  # reaches the reader
    assert "unused_wide" not in scan  # column pruned from ReadSchema


def test_pushed_quality_filters_keep_nan_rows(spark, tmp_path):
    """NaN is out of range; pushed range filters must not let row-group stats skip it."""
    from geoweave import schemas
    rows = [(i, 10, "a", 1, "US", "NY", float("nan") if i == 3 else 30.0 + i, -74.0) for i in range(6)]
    path = str(tmp_path / "nan_places")
    spark.createDataFrame(rows, schemas.PLACES).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert [r.id for r in dq.null_or_invalid(df).collect()] == [3]
    assert [r.id for r in dq.invalid_only(df).collect()] == [3]
    assert sorted(r.id for r in dq.valid_only(df).collect()) == [0, 1, 2, 4, 5]
    assert "GreaterThan(lat,90.0)" in dq.invalid_only(df)._jdf.queryExecution().executedPlan().toString()


def test_per_cell_table_is_broadcast_only_when_bounded(spark):
    import re
    from geoweave.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    p, o = td.places(spark, sf), td.observations(spark, sf)
    bhj = re.compile(r"BroadcastHashJoin \[_cell#\d+L\], \[_cell#\d+L\], LeftOuter")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only explicit hints broadcast
    try:
        fixed = o.drop("wthr_date")
        assert bhj.search(plan(en.enrich(p, fixed)))  # proven bound: broadcast, places not shuffled
        assert not bhj.search(plan(en.enrich(p, o)))  # dates are text of any length
        free_text = en.enrich(p, o.withColumn("note", F.lit("free text")), mode="first", columns=["lat", "note"])
        assert "LeftOuter" in plan(free_text) and not bhj.search(plan(free_text))
        assert not bhj.search(plan(en.enrich(p, fixed, precision=6)))  # 32**6 rows: no bound
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
