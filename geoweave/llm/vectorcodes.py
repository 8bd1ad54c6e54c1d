"""Product codes of vectors: four bytes each, found with a GNAT over the entries of a codebook.

A codebook is arranged as a tree: a node holds a few split points, every other
entry lies below its nearest split point, and for each pair (split point,
child) the node stores the range of distances from the point to the child's
entries.  A query measures its distance to the split points; a child is left
out when that distance, give or take the best distance so far, misses a stored
range.  Ranges are widened against rounding and compared strictly, and every
distance that decides is a whole number, so ties go to the lower index.

Each round is one pass over the stored table.  A task returns one row of sums
per used entry, so what is shuffled, and what the driver receives, depends on
the codebook's size only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import staged
from geoweave.llm.vectors import ROUNDING, matrix, squared, whole_vectors

RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


class Gnat:
    """Nearest entry by squared distance, ties to the lower index."""

    def __init__(self, entries: np.ndarray, degree: int = 12, leaf: int = 16):
        self.entries, self.degree, self.leaf = entries, degree, leaf
        self.root = self._node(np.arange(len(entries)))

    def _node(self, ids: np.ndarray):
        if len(ids) <= self.leaf:
            return ids, None, None, None
        points = self.entries[ids]
        split, near = [0], squared(points, points[:1])[:, 0]
        while len(split) < self.degree and near.max() > 0:  # each split point is the entry farthest from those before
            split.append(int(near.argmax()))
            near = np.minimum(near, squared(points, points[split[-1]:split[-1] + 1])[:, 0])
        if len(split) == 1:  # all entries are equal
            return ids, None, None, None
        d = squared(points, points[split])
        child = d.argmin(1)
        child[split] = np.arange(len(split))
        root = np.sqrt(d.astype(np.float64))
        low = np.array([[root[child == j, i].min() for j in range(len(split))] for i in range(len(split))])
        high = np.array([[root[child == j, i].max() for j in range(len(split))] for i in range(len(split))])
        below = np.ones(len(ids), bool)
        below[split] = False
        children = [self._node(ids[below & (child == j)]) for j in range(len(split))]
        return ids[split], low * (1 - ROUNDING), high * (1 + ROUNDING), children

    def nearest(self, q: np.ndarray):
        """Per row of ``q``: index, squared distance, and how many distances were taken in all."""
        best, who = np.full(len(q), np.iinfo(np.int64).max), np.full(len(q), len(self.entries), np.int64)
        taken = self._search(self.root, q, np.arange(len(q)), best, who)
        return who, best, taken

    def _search(self, node, q, rows, best, who) -> int:
        ids, low, high, children = node
        if not len(rows) or not len(ids):
            return 0
        d = squared(q[rows], self.entries[ids])
        least = d.min(1)
        lowest = np.where(d == least[:, None], ids, len(self.entries)).min(1)
        better = (least < best[rows]) | ((least == best[rows]) & (lowest < who[rows]))
        best[rows[better]], who[rows[better]] = least[better], lowest[better]
        taken = d.size
        if children is None:
            return taken
        root = np.sqrt(d.astype(np.float64))
        bound = np.zeros(d.shape)
        for i in range(len(ids)):
            away = np.maximum(root[:, i, None] - high[i], low[i] - root[:, i, None])
            np.maximum(bound, away - (root[:, i, None] + high[i]) * ROUNDING, out=bound)
        home = d.argmin(1)  # the child of the nearest split point first: it brings the best distance down
        for first in (True, False):
            for j, child in enumerate(children):
                some = np.flatnonzero((home == j) == first)
                limit = np.sqrt(best[rows[some]].astype(np.float64)) * (1 + ROUNDING)
                taken += self._search(child, q, rows[some[bound[some, j] <= limit]], best, who)
        return taken


def _sums(table: DataFrame, books: np.ndarray) -> DataFrame:
    """Per task, part and used entry: count, componentwise sum; distances taken (on the task's first row)."""
    parts, size, width = books.shape

    def add(batches):
        trees = [Gnat(b) for b in books]
        n, s, taken = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64), 0
        for b in batches:
            q = matrix(b.column("q"), parts * width)
            for p, tree in enumerate(trees):
                part = q[:, p * width:(p + 1) * width]
                who, _, some = tree.nearest(part)
                taken += some
                n[p] += np.bincount(who, minlength=size)
                np.add.at(s[p], who, part)
        at = np.argwhere(n)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(at[:, 0].astype(np.int32)), "entry": pa.array(at[:, 1].astype(np.int32)), "n": pa.array(n[n > 0]),
            "s": pa.array(s[n > 0].tolist(), pa.list_(pa.int64())),
            "taken": pa.array(np.where(np.arange(len(at)) == 0, taken, 0).astype(np.int64))})
    return table.mapInArrow(add, "part int, entry int, n long, s array<long>, taken long")


def _coded(table: DataFrame, books: np.ndarray) -> DataFrame:
    parts, _, width = books.shape
    label = table.schema["label"].dataType

    def add(batches):
        trees = [Gnat(b) for b in books]
        for b in batches:
            q = matrix(b.column("q"), parts * width)
            found = [tree.nearest(q[:, p * width:(p + 1) * width])[:2] for p, tree in enumerate(trees)]
            codes = np.stack([who for who, _ in found], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([row.tobytes().hex() for row in codes], pa.string()),
                                              pa.array(np.sum([best for _, best in found], 0)), b.column("label")],
                                             names=["vec_id", "code", "error", "label"])
    return table.mapInArrow(add, f"vec_id long, code string, error long, label {label.simpleString()}")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, dims: int = 64, id_col: str = "vec_id",
             vec_col: str = "embedding", label_col: str = "label", report: dict | None = None) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Kept are vectors of ``dims`` components, none null or non-finite; a
    component x counts as floor(1024 * x) (beyond +-131,072: the job stops).
    Vectors are cut into ``parts`` (a divisor of ``dims``).  A part's codebook
    starts as that part of the ``entries`` (at most 256) smallest vec_ids
    (equal ids by their components, null ids last); each of ``rounds`` rounds
    assigns every part to the nearest entry (ties: the lower index) and moves
    each used entry to the componentwise floor of its mean.  Repeated rows
    count each time.  With fewer vectors than ``entries`` the codebooks are as
    much smaller; an empty table gives no rows.  ``label_error`` adds the
    errors of rows with an equal label, nulls together.  Other columns are
    ignored.  ``report`` receives the share of distances that the trees spared.
    """
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("parts must divide dims, and entries lie in 1 to 256")
    spark = vectors.sparkSession
    table = staged(whole_vectors(vectors, dims, id_col, vec_col, (label_col,)).withColumnRenamed("keep_0", "label"), "code-vectors")
    first = [r["q"] for r in table.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()]
    if not first:
        return spark.createDataFrame([], RESULT)
    width = dims // parts
    books = np.array(first, dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    taken = seen = 0
    for _ in range(rounds):
        sums = _sums(table, books).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.sum("taken").alias("taken"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)]).collect()
        for r in sums:
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
            taken += r["taken"]
            seen += r["n"] * len(first)
    if report is not None:
        report["spared"] = 1 - taken / seen if seen else 0.0
    coded = staged(_coded(table, books), "codes")
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return (coded.join(errors, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def oracle(parts: int = 4, entries: int = 256, rounds: int = 4, dims: int = 64) -> str:
    """The same rows by unrolled SQL over the table ``embeddings``."""
    width = dims // parts
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS rid, vec_id, label, q FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims}))""",
             f"""pieces AS MATERIALIZED (
  SELECT rid, p, q[p * {width} + 1 : (p + 1) * {width}] AS q FROM kept, range({parts}) AS t(p))""",
             f"b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, q FROM pieces WHERE rid <= {entries})"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT k.rid, k.p, min(CAST(list_sum(list_transform(list_zip(k.q, b.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) * 256 + b.e) AS v
  FROM pieces k JOIN b{r} b USING (p) GROUP BY k.rid, k.p)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.q, b.q) AS q FROM b{r} b LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM (
      SELECT a.p, a.v % 256 AS e, i, sum(k.q[i]) AS s, count(*) AS n
      FROM a{r} a JOIN pieces k USING (rid, p), range(1, {width + 1}) AS t(i) GROUP BY ALL) GROUP BY p, e) m USING (p, e))""")
    return f"""WITH {", ".join(steps)},
coded AS (SELECT rid, string_agg(printf('%02x', CAST(v % 256 AS INTEGER)), '' ORDER BY p) AS code, sum(v // 256) AS error FROM a{rounds} GROUP BY rid),
book AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT k.vec_id, c.code, CAST(c.error AS BIGINT) AS error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  book.h AS codebooks_sha256
FROM coded c JOIN kept k USING (rid), book"""
