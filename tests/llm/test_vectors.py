"""Centroid clustering and vector codes against plain loops over Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from geoweave.llm import centroids, vectorcodes
from geoweave.llm.vectors import squared

SCHEMA = "vec_id long, embedding array<float>, label string, cluster int, code string, q string, distance long"


def _random_rows(n, dims, seed, groups=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    rows = []
    for i in range(n):
        c = centres[rng.randrange(groups)]
        rows.append((i, [float(np.float32(x + rng.gauss(0, 0.1))) for x in c], rng.choice(["a", "b", None]), 9, "zz", "q", 7))
    for i in range(n, n + 12):  # copies of another vector: ties everywhere
        rows.append((i, rows[i % 3][1], "a", 9, "zz", "q", 7))
    rows.append(rows[4])  # a repeated row
    rows.append((None, rows[5][1], "b", None, None, None, None))
    return rows


def _odd_rows(dims):
    nan, inf = float("nan"), float("inf")
    return [(1001, None, "a", 0, "", "", 0), (1002, [0.5] * (dims - 1), "a", 0, "", "", 0), (1003, [], None, 0, "", "", 0),
            (1004, [0.5] * (dims - 1) + [None], "b", 0, "", "", 0), (1005, [nan] * dims, "b", 0, "", "", 0),
            (1006, [0.5] * (dims - 1) + [-inf], "b", 0, "", "", 0)]


def _whole(rows, dims):
    return [(i, [math.floor(1024 * x) for x in v], label) for i, v, label, *_ in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def _nearest(q, book):
    return min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(book))


def _moved(book, members):
    out = []
    for k, e in enumerate(book):
        own = [q for q, at in members if at == k]
        out.append([sum(x) // len(own) for x in zip(*own)] if own else e)
    return out


def _clusters(rows, clusters, rounds, dims):
    kept = _whole(rows, dims)
    name = {None: ""}
    book = [q for _, q in sorted((hashlib.sha256(f"3:{name.get(i, i)}".encode()).hexdigest(), q) for i, q, _ in kept)[:clusters]]
    for _ in range(rounds):
        book = _moved(book, [(q, _nearest(q, book)[1]) for _, q, _ in kept])
    found = [(i, *reversed(_nearest(q, book))) for i, q, _ in kept]
    own = [sum(d for _, c, d in found if c == k) for k in range(len(book))]
    return sorted((-1 if i is None else i, c, d, own[c], sum(own), hashlib.sha256(",".join(map(str, book[c])).encode()).hexdigest())
                  for i, c, d in found)


def _codes(rows, parts, entries, rounds, dims):
    kept, w = _whole(rows, dims), dims // parts
    first = [q for _, _, q in sorted((i is None, i or 0, q) for i, q, _ in kept)[:entries]]
    books = [[q[p * w:(p + 1) * w] for q in first] for p in range(parts)]
    for _ in range(rounds):
        books = [_moved(book, [(q[p * w:(p + 1) * w], _nearest(q[p * w:(p + 1) * w], book)[1]) for _, q, _ in kept])
                 for p, book in enumerate(books)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found = []
    for i, q, label in kept:
        best = [_nearest(q[p * w:(p + 1) * w], book) for p, book in enumerate(books)]
        found.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    return sorted((-1 if i is None else i, code, e, sum(f[2] for f in found if f[3] == label), digest) for i, code, e, label in found)


def _got(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    return _random_rows(150, 8, 1) + _odd_rows(8)


def test_clusters_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    report = {}
    got = centroids.cluster(df, clusters=6, rounds=4, dims=8, pivots=5, sample=40, report=report)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert _got(got) == _clusters(rows, 6, 4, 8)
    assert report["spared"] > 0.2  # the bounds do their work on vectors that cluster


@pytest.mark.parametrize("pivots", [1, 3])
def test_pivots_do_not_change_clusters(spark, rows, pivots):
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(centroids.cluster(df, clusters=5, rounds=2, dims=8, pivots=pivots, sample=3)) == _clusters(rows, 5, 2, 8)


def test_codes_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    report = {}
    got = vectorcodes.compress(df, parts=2, entries=60, rounds=3, dims=8, report=report)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert _got(got) == _codes(rows, 2, 60, 3, 8)
    assert report["spared"] > 0.2


def test_fewer_vectors_than_centroids_and_entries(spark):
    rows = _random_rows(5, 8, 3)[:2] + _odd_rows(8)
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(centroids.cluster(df, clusters=8, rounds=2, dims=8)) == _clusters(rows, 8, 2, 8)
    assert _got(vectorcodes.compress(df, parts=4, rounds=2, dims=8)) == _codes(rows, 4, 256, 2, 8)


def test_all_vectors_equal(spark):
    rows = [(i, [0.25, -0.3] * 4, "a", 0, "", "", 0) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(centroids.cluster(df, clusters=4, rounds=2, dims=8)) == _clusters(rows, 4, 2, 8)
    assert _got(vectorcodes.compress(df, parts=2, entries=20, rounds=1, dims=8)) == _codes(rows, 2, 20, 1, 8)


def test_empty_table(spark):
    df = spark.createDataFrame(_odd_rows(8), SCHEMA)
    for empty in (df, df.where("false")):
        a, b = centroids.cluster(empty, dims=8), vectorcodes.compress(empty, dims=8)
        assert a.collect() == b.collect() == []
        assert a.columns[1] == "cluster" and b.columns[1] == "code"


def test_large_components_are_exact_and_larger_ones_stop_the_job(spark):
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.uniform(-131000, 131000))) for _ in range(8)], "a", 0, "", "", 0) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(centroids.cluster(df, clusters=3, rounds=1, dims=8)) == _clusters(rows, 3, 1, 8)
    assert _got(vectorcodes.compress(df, parts=2, entries=20, rounds=1, dims=8)) == _codes(rows, 2, 20, 1, 8)
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 8, "a", 0, "", "", 0)], SCHEMA), dims=8).collect()


def test_tree_search_equals_scan_with_ties():
    rng = np.random.default_rng(2)
    for n, dims, high in ((1, 3, 5), (17, 2, 4), (256, 16, 300), (256, 3, 6), (200, 4, 1)):
        entries, q = rng.integers(-high, high + 1, (n, dims)), rng.integers(-high, high + 1, (500, dims))
        d = squared(q, entries)
        who, best, taken = vectorcodes.Gnat(entries).nearest(q)
        assert (best == d.min(1)).all() and (who == d.argmin(1)).all() and taken <= 2 * d.size


def test_pivot_bound_equals_scan_with_ties():
    rng = np.random.default_rng(3)
    q, book = rng.integers(-4, 5, (400, 3)), rng.integers(-4, 5, (9, 3))
    pivots = centroids.choose_pivots(q[:20], 4)
    who, best, exact = centroids.nearest_centroid(q, squared(q, pivots), book, pivots)
    d = squared(q, book)
    assert (best == d.min(1)).all() and (who == d.argmin(1)).all() and exact < d.size
