"""Clustering around centroids in exact whole numbers, with a pivot table (LAESA).

The distances of every vector to a few fixed pivots are computed once and
stored beside the vector.  In each round the distances of the centroids to
the same pivots give a lower bound of every vector-centroid distance by the
triangle inequality; only centroids whose bound does not exceed the nearest
distance found so far get an exact distance.  Bounds are rounded down and
compared strictly, so no nearest centroid and no tie is lost.

A round is one pass over the stored table.  Each task returns one row of sums
per centroid, so what is shuffled and what the driver receives depends on the
number of centroids only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import staged
from geoweave.llm.vectors import ROUNDING, matrix, squared, whole_vectors

RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of the sample, each the farthest from those before it (the first row to begin with)."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = squared(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(sample, sample[chosen[-1]:chosen[-1] + 1])[:, 0])
    return sample[chosen]


def nearest_centroid(q: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """Per row of ``q``: its centroid, the squared distance, and how many exact distances were taken in all."""
    own, theirs = np.sqrt(to_pivots.astype(np.float64)), np.sqrt(squared(centroids, pivots).astype(np.float64))
    n, k = len(q), len(centroids)
    bound = np.zeros((n, k))
    for p in range(own.shape[1]):
        a, b = own[:, p, None], theirs[None, :, p]
        np.maximum(bound, np.abs(a - b) - (a + b) * ROUNDING, out=bound)
    cluster = bound.argmin(1)
    first = cluster.copy()
    gap = q - centroids[cluster]
    best = (gap * gap).sum(1)
    exact = n
    for c in range(k):
        rows = np.flatnonzero((first != c) & (bound[:, c] <= np.sqrt(best.astype(np.float64)) * (1 + ROUNDING)))
        exact += len(rows)
        d = squared(q[rows], centroids[c:c + 1])[:, 0]
        better = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = d[better], c
    return cluster, best, exact


def _with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    dims = pivots.shape[1]

    def add(batches):
        for b in batches:
            d = squared(matrix(b.column("q"), dims), pivots)
            at = pa.array(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("q"), pa.ListArray.from_arrays(at, pa.array(d.ravel()))],
                                             names=["vec_id", "q", "to_pivots"])
    return rows.mapInArrow(add, "vec_id long, q array<int>, to_pivots array<long>")


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """Per task, centroid and component: count, sum, and (on the first row) the number of exact distances taken."""
    k, dims = centroids.shape

    def add(batches):
        n, s, exact = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), 0
        for b in batches:
            q = matrix(b.column("q"), dims)
            cluster, _, taken = nearest_centroid(q, matrix(b.column("to_pivots"), len(pivots)), centroids, pivots)
            exact += taken
            n += np.bincount(cluster, minlength=k)
            np.add.at(s, cluster, q)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(np.arange(k, dtype=np.int32), dims)), "i": pa.array(np.tile(np.arange(dims, dtype=np.int32), k)),
            "n": pa.array(np.repeat(n, dims)), "s": pa.array(s.ravel()), "exact": pa.array([exact] + [0] * (k * dims - 1), pa.int64())})
    return table.mapInArrow(add, "cluster int, i int, n long, s long, exact long")


def _assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def add(batches):
        for b in batches:
            cluster, best, _ = nearest_centroid(matrix(b.column("q"), dims), matrix(b.column("to_pivots"), len(pivots)), centroids, pivots)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(best)],
                                             names=["vec_id", "cluster", "distance"])
    return table.mapInArrow(add, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, dims: int = 64, seed: str = "3", pivots: int = 12,
            sample: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", report: dict | None = None) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of ``dims`` components, none null or non-finite; a
    component x counts as floor(1024 * x) (beyond +-131,072: the job stops).
    Centroids start as the kept vectors with the smallest sha256 of
    ``seed:vec_id`` (a null id: empty; equal ids, then, by their components).
    Each of ``rounds`` rounds assigns every vector to the nearest centroid
    (ties: the smaller number) and moves each non-empty centroid to the
    componentwise floor of its mean.  Repeated rows count each time.  With
    fewer vectors than ``clusters`` there are as many centroids as vectors; an
    empty table gives no rows.  Other columns are ignored.

    The ``pivots`` are chosen from the ``sample`` vectors of smallest hash;
    they change the work and never the result.  ``report`` receives the share
    of vector-centroid distances that the bounds made unnecessary.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, dims, id_col, vec_col)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = [r["q"] for r in rows.orderBy(rank, "q").limit(max(sample, clusters)).collect()]
    if not first:
        return spark.createDataFrame([], RESULT)
    first = np.array(first, dtype=np.int64)
    centroids, pivot = first[:clusters].copy(), choose_pivots(first, pivots)
    table = staged(_with_pivots(rows, pivot), "pivot-table")
    taken = seen = 0
    for _ in range(rounds):
        sums = _sums(table, centroids, pivot).groupBy("cluster", "i").agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("exact").alias("exact")).collect()
        for r in sums:
            if r["n"]:
                centroids[r["cluster"], r["i"]] = r["s"] // r["n"]
        taken += sum(r["exact"] for r in sums)
        seen += sum(r["n"] for r in sums if r["i"] == 0) * len(centroids)
    if report is not None:
        report["spared"] = 1 - taken / seen if seen else 0.0
    result = staged(_assigned(table, centroids, pivot), "clusters")
    inertia = {r["cluster"]: r["d"] for r in result.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    own = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))])
    digest = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()])
    return result.select("vec_id", "cluster", "distance", own[F.col("cluster")].alias("cluster_inertia"),
                         F.lit(sum(inertia.values())).cast("long").alias("inertia"), digest[F.col("cluster")].alias("centroid_sha256"))


def oracle(clusters: int = 8, rounds: int = 10, dims: int = 64, seed: str = "3") -> str:
    """The same rows by unrolled SQL over the table ``embeddings``."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, q) AS rid, vec_id, q FROM (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims}))""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (
    SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM kept ORDER BY h, q LIMIT {clusters}))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT k.rid, min(CAST(list_sum(list_transform(list_zip(k.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) * {clusters} + c.c) AS v
  FROM kept k, c{r} c GROUP BY k.rid)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM (
      SELECT a.v % {clusters} AS c, i, sum(k.q[i]) AS s, count(*) AS n
      FROM a{r} a JOIN kept k USING (rid), range(1, {dims + 1}) AS p(i) GROUP BY ALL) GROUP BY c) m USING (c))""")
    last = rounds
    return f"""WITH {", ".join(steps)}
SELECT k.vec_id, CAST(a.v % {clusters} AS INTEGER) AS cluster, CAST(a.v // {clusters} AS BIGINT) AS distance,
  CAST(sum(a.v // {clusters}) OVER (PARTITION BY a.v % {clusters}) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.v // {clusters}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{last} a JOIN kept k USING (rid) JOIN c{last} c ON c.c = a.v % {clusters}"""
