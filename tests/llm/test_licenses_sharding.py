"""Licence digests by SQL and by hand; sharding against exhaustive minimax."""

import zlib
from collections import Counter

import duckdb
import pytest

from geoweave.llm import licenses, sharding
from geoweave.llm.queries import QUERIES


def test_license_scan_equals_sql(spark, sf):
    got = sorted(map(tuple, QUERIES["op1_license_digests"](spark, sf).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(licenses.oracle()).fetchall(), key=repr)
    assert got == want and any(r[4] for r in got)


def test_license_texts_in_other_spellings(spark, nasty, empty):
    mit = licenses.KNOWN[2][1]
    rows = [(1, mit), (2, "Copyright (c) 2024 Somebody\n\n" + mit.upper()), (3, mit.replace(" ", "\n").replace(",", "")),
            (4, mit + " And more."), (5, "x\nReleased under the MIT Licence!\nlicensed under CC BY-NC 4.0\nreleased under the mit license"),
            (6, "© 2020 A B\n" + licenses.KNOWN[9][1]), (5, "x"), (1, mit), (7, "Licence licence."), (None, mit)]
    out = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert [r.license for r in out[1]] == ["MIT", "MIT"]
    assert out[2][0].license == out[3][0].license == out[None][0].license == "MIT" and out[4][0].license is None
    assert out[6][0].license == "Zlib"
    assert sorted((r.line_licenses, r.n_license_lines) for r in out[5]) == [("", 0), ("CC-BY-NC-4.0,MIT", 3)]
    got = licenses.scan(nasty).collect()
    assert len(got) == nasty.count() and [r.text_digest for r in got if r.doc_id == 1] == [None]
    assert len({r.text_digest for r in got if r.doc_id in (0, 2, 3)}) == 1
    assert licenses.scan(empty).collect() == []


def test_more_known_licenses(spark):
    long = "The House License\n\nYou may use it.\n" + "And so on. " * 50
    more = spark.createDataFrame([("House-1.0", long), ("none", " \n"), (None, "x"), ("nothing", None)], "license string, text string")
    docs = spark.createDataFrame([(1, long.upper()), (2, licenses.KNOWN[2][1]), (3, ""), (4, "a\nthe house licence\n"), (5, "x")],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.license, r.line_licenses) for r in licenses.scan(docs, more=more).collect()}
    assert got == {1: ("House-1.0", ""), 2: ("MIT", ""), 3: (None, ""), 4: (None, ""), 5: (None, "")}


def test_license_plan_has_no_python(spark, sf):
    for name in ("op1_license_digests", "op6_minimax_shards"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def _greedy(sizes, capacity):
    n, room = 1, capacity
    for s in sizes:
        if s > capacity:
            return 10**9
        if s > room:
            n, room = n + 1, capacity
        room -= s
    return n


def _alone(sizes, capacity):
    """Shards of a greedy pass in which a group larger than the capacity has one of its own."""
    n, used = 0, None
    for s in sizes:
        if used is None or used + s > capacity:
            n, used = n + 1, 0
        used += s
    return n


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        if _greedy(sizes, mid) <= shards:
            high = mid
        else:
            low = mid + 1
    return low


def check_shards(rows, out, shards):
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    groups, first = {}, {}
    for i, t in rows:
        groups[t] = groups.get(t, 0) + len((t or "").encode()) + 16
        if i is not None:
            first[t] = min(i, first.get(t, i))
    places = {}
    for t, size in groups.items():
        places[first.get(t)] = places.get(first.get(t), 0) + size
    sizes = [places[k] for k in sorted(places, key=lambda k: (k is not None, k))]
    load = Counter()
    for r in out:
        load[r.shard] += r.size
    assert max(load.values()) == least_capacity(sizes, shards) and max(load) < shards and min(load) >= 0
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_crc = {}
    for r in out:
        by_crc.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in by_crc.values())


@pytest.mark.parametrize("fan", [4096, 4])
def test_shards_of_documents(spark, real_docs, fan):
    rows = [(r["doc_id"], r["text"]) for r in real_docs]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_shards(rows, sharding.shard_by_bytes(docs, fan=fan).collect(), 40)


def test_shards_of_nasty_rows(spark, nasty, empty):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    out = sharding.shard_by_bytes(nasty, shards=5).collect()
    check_shards(rows, out, 5)
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
    assert sharding.shard_by_bytes(empty).collect() == []
    far = [(-(1 << 63), "a"), ((1 << 63) - 1, "b" * 50), (0, "c" * 9), (5, "d")]
    check_shards(far, sharding.shard_by_bytes(spark.createDataFrame(far, "doc_id long, text string"), shards=3).collect(), 3)


def test_a_large_group_does_not_empty_the_other_shards(spark):
    rows = [(i, "copy " * 200) for i in range(400)] + [(1000 + i, f"text {i} " + "x" * 500) for i in range(400)]
    out = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), shards=10).collect()
    check_shards(rows, out, 10)
    load = Counter()
    for r in out:
        load[r.shard] += r.size
    rest = sorted(load.values())[:-1]
    assert len(load) == 10 and rest[-1] - rest[0] <= 9 * 525  # one text a shard at most


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_optimal_for_any_resolution(seed):
    import random
    rng = random.Random(seed)
    n = rng.randrange(1, 400)
    span = rng.choice((n, 3 * n, 50 * n)) + 1
    units = sorted(zip(rng.sample(range(span), n), (rng.choice((1, 5, 100, rng.randrange(1, 3000))) for _ in range(n))))
    shards = rng.choice((1, 2, 7, 40))

    def count(wanted, old, width):
        found = {}
        for at, size in units:
            if wanted is None or at // old * old in wanted:
                found.setdefault(at // width, []).append((at, size))
        return [sharding.Range(k * width, width, sum(s for _, s in v), len({a for a, _ in v}) == 1) for k, v in found.items()]
    capacity, starts = sharding.minimax_cuts(count, sum(s for _, s in units), max(s for _, s in units), span, shards, fan=4)
    sizes = [s for _, s in units]
    assert capacity == min(c for c in range(max(1, capacity - 50), capacity + 1) if _alone(sizes, c) <= shards)
    assert len(starts) == shards - 1 and starts == sorted(starts)
    loads = Counter()
    for at, size in units:
        loads[sum(at >= s for s in starts)] += size
    assert max(loads.values()) == least_capacity(sizes, shards)
