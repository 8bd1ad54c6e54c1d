"""Steps that can be run again: file manifest, run appends, mergeable state, lookup attempts, commit log."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from geoweave.operators import enrich as en
from geoweave.operators import lookup as lk
from geoweave.operators.mutate import CowTable
from geoweave.operators.state import CellState
from geoweave.sinks import files as sk
from geoweave.sinks.commits import CommitConflict, CommitLog
from geoweave.sources import files as src
from geoweave.sources import testdata as td
from geoweave.sources.synth import synth_observations
from scripts.plan_lint import scanned_files

SF = "/root/testdata/sf0.001"


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------- file manifest

def test_every_file_is_loaded_once(spark, tmp_path):
    folder, table = str(tmp_path / "in coming"), str(tmp_path / "table")
    spark.range(10).coalesce(2).write.parquet(folder)
    assert src.ingest_new(spark, folder, table) == 2
    assert src.ingest_new(spark, folder, table) == 0
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(folder)
    assert src.ingest_new(spark, folder, table) == 1
    assert _sorted(src.read_ingested(spark, table)) == sorted(((i,) for i in range(15)), key=repr)
    m = src.manifest(spark, table)
    assert m.agg(F.sum("rows"), F.count("*"), F.countDistinct("load")).first() == (15, 3, 2)


def test_touched_file_is_not_new_and_changed_file_is(spark, tmp_path):
    import os
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    (folder / "a.csv").write_text("1\n2\n")
    (folder / "b.csv").write_text("")  # an empty file has nothing to load and is not listed
    assert src.ingest_new(spark, str(folder), table, "csv", src.StructType().add("v", "integer")) == 1
    os.utime(folder / "a.csv", (1_700_000_000, 1_700_000_000))
    assert src.ingest_new(spark, str(folder), table, "csv", src.StructType().add("v", "integer")) == 0
    (folder / "a.csv").write_text("1\n3\n")
    assert src.ingest_new(spark, str(folder), table, "csv", src.StructType().add("v", "integer")) == 1


def test_failed_load_leaves_no_row(spark, tmp_path, monkeypatch):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    spark.range(6).coalesce(1).write.parquet(folder)
    with monkeypatch.context() as m:
        def die(*_):
            raise OSError("died before the commit")
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(OSError):
            src.ingest_new(spark, folder, table)
    with pytest.raises(ValueError, match="nothing has been loaded"):
        src.read_ingested(spark, table)
    assert src.ingest_new(spark, folder, table) == 1
    assert _sorted(src.read_ingested(spark, table)) == [(i,) for i in range(6)]


def test_loader_that_started_earlier_conflicts(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    log.commit(1, {"load": "x"})
    with pytest.raises(CommitConflict):
        log.commit(1, {"load": "y"})
    (tmp_path / "t" / "_commits" / "000000002").write_text("")  # a writer that died while it filled its marker
    assert CommitLog(spark, str(tmp_path / "t")).entries() == [(1, {"load": "x"}), (2, None)]


# --------------------------------------------------------------- run appends

def test_append_with_a_run_id_can_be_repeated(spark, places, tmp_path):
    path = str(tmp_path / "runs")
    sk.append_run(places, path, "day-1")
    once = _sorted(sk.read_back(spark, places, path))
    sk.append_run(places, path, "day-1")
    assert _sorted(sk.read_back(spark, places, path)) == once
    sk.append_run(places.where("country = 'NL'"), path, "day-2")
    assert len(_sorted(sk.read_back(spark, places, path))) == 6
    sk.append_run(places.where("country = 'NO'"), path, "day-1")  # partitions the rerun no longer has are gone
    assert sorted(r.country for r in sk.read_back(spark, places, path).collect()) == ["NL", "NO"]
    sk.insert_dynamic_partitions(places, path, limit=1, order_by=["id"], run_id="day-2")
    assert sorted(r.id for r in sk.read_back(spark, places, path).collect()) == [1, 3]


def test_failed_append_leaves_the_table(spark, places, tmp_path):
    path = str(tmp_path / "runs")
    sk.append_run(places, path, "a")
    bad = places.withColumn("city", F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise(F.col("city")))
    with pytest.raises(Exception, match="boom"):
        sk.append_run(bad, path, "a")
    assert _sorted(sk.read_back(spark, places, path)) == _sorted(places)
    for bad_id in ("", "../x", "a/b", "run=1"):
        with pytest.raises(ValueError):
            sk.append_run(places, path, bad_id)


# ------------------------------------------------------------ verification

def test_differing_partitions_and_files(spark, places, tmp_path):
    path = str(tmp_path / "t")
    sk.write_partitioned(places, path)
    back = sk.read_back(spark, places, path)
    assert sk.differing_partitions(places, back).collect() == []
    changed = back.withColumn("city", F.when(F.col("id") == 2, "X").otherwise(F.col("city"))).where("country != 'DK'") \
        .unionAll(back.where("id = 3").withColumn("country", F.lit(None).cast("string")))
    got = {tuple(r) for r in sk.differing_partitions(places, changed).collect()}
    assert got == {("NL", 1, 1), ("DK", 1, 0), (None, 0, 1)}
    sk.write_partitioned(places.where("id = 2").withColumn("lat", F.lit(0.0)), path, dynamic_overwrite=True)
    files = sk.differing_files(spark, places, path).collect()
    assert len(files) == 1 and "country=NL" in files[0].file


# ------------------------------------------------------------ mergeable state

def _deliver(df, path):
    df.write.mode("append").partitionBy("year", "month").parquet(path)


def test_state_reads_new_files_only_and_equals_the_full_run(spark, tmp_path):
    p, o = td.places(spark, SF), td.observations(spark, SF)
    # longer texts and gaps, so that values are fetched too
    o = o.withColumn("wthr_date", F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("observed on "), "wthr_date"))) \
        .withColumn("avg_tmpr_c", F.when(F.col("event_id") % 4 > 0, F.col("avg_tmpr_c")))
    path, root = str(tmp_path / "obs"), str(tmp_path / "state")
    parts = [o.where(F.col("event_id") % 3 == i) for i in (2, 0, 1)]
    seen = 0
    for part in parts:
        _deliver(part.coalesce(1), path)
        state = CellState(spark, root)
        new = [r.path for r in state.new_files(path).collect()]
        assert scanned_files(state.delta(path, new)) == len(new)
        assert state.advance(path) == len(new)
        seen += len(new)
        assert state.ledger().count() == seen
        assert CellState(spark, root).advance(path) == 0
    full = en.enrich(p, o).withColumn("weather_avg_tmpr_f", F.round("weather_avg_tmpr_f", 6)).withColumn("weather_avg_tmpr_c", F.round("weather_avg_tmpr_c", 6))
    inc = en.join_cells(p, CellState(spark, root).reduced())
    inc = inc.withColumn("weather_avg_tmpr_f", F.round("weather_avg_tmpr_f", 6)).withColumn("weather_avg_tmpr_c", F.round("weather_avg_tmpr_c", 6))
    assert _sorted(inc.select(*full.columns)) == _sorted(full)


def test_state_survives_a_dead_run_and_refuses_changed_files(spark, tmp_path, monkeypatch):
    import glob
    import os
    o = td.observations(spark, SF)
    path, root = str(tmp_path / "obs"), str(tmp_path / "state")
    _deliver(o.where("event_id % 2 = 0").coalesce(1), path)
    CellState(spark, root).advance(path)
    before = _sorted(CellState(spark, root).state())
    _deliver(o.where("event_id % 2 = 1").coalesce(1), path)
    with monkeypatch.context() as m:
        def die(*_):
            raise OSError("died before the commit")
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(OSError):
            CellState(spark, root).advance(path)
    assert _sorted(CellState(spark, root).state()) == before
    a, b = CellState(spark, root), CellState(spark, root)
    assert a.advance(path) > 0
    with pytest.raises(CommitConflict):
        b.advance(path)
    with pytest.raises(ValueError, match="was made with"):
        CellState(spark, root, precision=5)
    os.remove(glob.glob(f"{path}/**/*.parquet", recursive=True)[0])
    with pytest.raises(ValueError, match="gone or changed"):
        CellState(spark, root).advance(path)


# ----------------------------------------------------------- lookup attempts

def test_failed_lookups_are_asked_again_only_after_a_while(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def geocoder(keys, folder=str(calls)):
        import os
        import uuid
        for c in keys["city"]:
            open(os.path.join(folder, f"{c}-{uuid.uuid4().hex}"), "w").close()
        if "Down" in set(keys["city"]):
            raise ConnectionError("no network")
        return keys.assign(lookup_lat=[1.0 if c == "Known" else None for c in keys["city"]], lookup_lng=2.0)

    def asked(city):
        return len([f for f in calls.iterdir() if f.name.startswith(city)])
    keys = spark.createDataFrame([("Known", "X"), ("Unknown", "X"), ("Known", "X")], "city string, country string").coalesce(1)
    table, attempts = str(tmp_path / "lookup"), str(tmp_path / "attempts")

    def run(day, keys=keys):
        return lk.extend_lookup(spark, keys, table, geocoder, on_error="null", attempts_path=attempts, retry_after=timedelta(days=7),
                                now=datetime(2024, 1, day, tzinfo=timezone.utc)).collect()
    assert [tuple(r) for r in run(1)] == [("Known", "X", 1.0, 2.0)]
    assert (asked("Known"), asked("Unknown")) == (1, 1)
    run(2), run(7)
    assert (asked("Known"), asked("Unknown")) == (1, 1)
    run(9)
    assert (asked("Known"), asked("Unknown")) == (1, 2)
    run(10, spark.createDataFrame([("Down", "X")], "city string, country string"))
    from geoweave import schemas
    outcomes = {(r.city, r.outcome) for r in spark.read.schema(schemas.ATTEMPTS).parquet(attempts).collect()}
    assert outcomes == {("Known", "found"), ("Unknown", "none"), ("Down", "error")}


def test_answers_of_a_broken_run_are_not_asked_again(spark, tmp_path):
    """The run died after the questions: the lookup table never got the answers."""
    import shutil
    keys = spark.createDataFrame([("A", "X")], "city string, country string")
    table, attempts = str(tmp_path / "lookup"), str(tmp_path / "attempts")

    def run(resolver, day):
        return lk.extend_lookup(spark, keys, table, resolver, attempts_path=attempts, now=datetime(2024, 1, day, tzinfo=timezone.utc)).collect()
    run(lambda k: k.assign(lookup_lat=1.0, lookup_lng=2.0), 1)
    shutil.rmtree(table)

    def never(keys):
        raise AssertionError("asked again")
    assert [tuple(r) for r in run(never, 2)] == [("A", "X", 1.0, 2.0)]


# ----------------------------------------------------------- catalog snapshots

def _catalog_table(spark, tmp_path, name):
    rows = spark.createDataFrame([(i, 0) for i in range(6)], "id int, v int")
    return CowTable.create(spark, str(tmp_path / name), rows, table=name, bucket_col="id", buckets=2)


def test_update_is_not_lost_if_the_writer_dies_before_the_catalog_follows(spark, tmp_path, monkeypatch):
    t = _catalog_table(spark, tmp_path, "cow_dead")
    with monkeypatch.context() as m:
        def die(self):
            raise OSError("died before the catalog was changed")
        m.setattr(CowTable, "_point", die)
        with pytest.raises(OSError):
            t.update(F.col("id") == 1, {"v": 100})
    again = CowTable.open(spark, t.root, table="cow_dead", bucket_col="id", buckets=2)
    assert again.version == 2
    again.update(F.col("id") == 2, {"v": 200})
    assert _sorted(spark.table("cow_dead")) == [(0, 0), (1, 100), (2, 200), (3, 0), (4, 0), (5, 0)]
    spark.sql("DROP TABLE cow_dead")


def test_insert_into_a_catalog_table_is_a_version(spark, tmp_path):
    t = _catalog_table(spark, tmp_path, "cow_insert")
    other = CowTable.open(spark, t.root, table="cow_insert", bucket_col="id", buckets=2)
    t.insert(spark.createDataFrame([(9, 9)], "id int, v int"))
    assert t.version == 2 and spark.table("cow_insert").count() == 7
    with pytest.raises(CommitConflict):
        other.delete(F.col("id") == 0)
    assert spark.table("cow_insert").count() == 7
    spark.sql("DROP TABLE cow_insert")


# --------------------------------------------------------------- exact numbers

def test_exact_number_of_records_without_a_job_at_plan_time(spark):
    p = td.places(spark, SF)
    n = p.where("lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180").count()
    tracker = spark.sparkContext.statusTracker()
    for records in (0, 1, n - 1, n, 3 * n + 17):
        spark.sparkContext.setJobGroup("synth", "plan only")
        try:
            df = synth_observations(p, records=records)
            assert list(tracker.getJobIdsForGroup("synth")) == []
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert df.count() == records
    assert synth_observations(p.where("false"), records=10).count() == 0
    a, b = (synth_observations(x, records=n + 40) for x in (p, p.repartition(9)))
    assert _sorted(a) == _sorted(b)


# ------------------------------------------------------------------- the job

def test_job_with_state_and_run_id(spark, places, places_csv, tmp_path):
    """Deliveries arrive between runs; every run's output equals a run over all files, and a repeated run changes nothing."""
    from geoweave.plans.config import EnrichConfig
    from geoweave.plans.runner import run
    rows = [(i, 41.16, -8.62, float(i), 2.0 * i, f"2023-05-{11 - i:02d}") for i in range(6)] + [(9, 52.08, 5.11, 3.0, 4.0, "2023-05-12")]
    obs = spark.createDataFrame(rows, "event_id long, lat double, lng double, avg_tmpr_f double, avg_tmpr_c double, wthr_date string")
    path = str(tmp_path / "obs")
    cfg = EnrichConfig(places_path=places_csv, observations_path=path, output_path=str(tmp_path / "out"), state_path=str(tmp_path / "state"),
                       run_id="nightly", fill_coordinates=False)
    assert run(spark, cfg).weather_joined is False  # no observations yet
    for part in (obs.where("event_id >= 3"), obs.where("event_id < 3")):
        part.coalesce(1).write.mode("append").parquet(path)
        first = run(spark, cfg)
        once = _sorted(first.output)
        plain = run(spark, EnrichConfig(places_path=places_csv, observations_path=path, output_path=str(tmp_path / "plain"), fill_coordinates=False))
        assert once == _sorted(plain.output.select(*first.output.columns))
        assert first.metrics["matched"] == plain.metrics["matched"] == 2
        assert _sorted(run(spark, cfg).output) == once
    assert {r.weather_wthr_date for r in run(spark, cfg).output.collect()} == {"2023-05-11", "2023-05-12", None}
    with pytest.raises(ValueError, match="averages"):
        run(spark, EnrichConfig(places_path=places_csv, observations_path=path, output_path="x", state_path="y", dedupe="first"))
