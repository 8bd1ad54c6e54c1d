"""Near-duplicate embeddings by NN-descent.

1. Equal vectors form a class; one representative of each goes on.
2. A first neighbour graph comes from blocks of vectors with the same signs
   under random hyperplanes.
3. Rounds of NN-descent refine it: the neighbours of a node (and the nodes that
   have it as a neighbour) are compared with each other, and every node keeps
   its best.  A list that is saturated with near-duplicates is enlarged.
   Rounds stop when hardly any list changes.
4. Every near-duplicate met in any round, also one that a list has no place
   for, is confirmed on the full vectors if it joins two components.
5. Nodes whose lists are full of near-duplicates are searched again with lists
   that take partners of other components only, until no components join.
6. Recall is audited: a bounded sample of vectors is compared with all; while
   too few of its links lie inside the components found, lists grow and
   rounds go on.  A recall that stays too low is an error.
7. Inside a component every pair is compared in blocks, so links beyond a
   list's end count as well.  Only counts leave these blocks, never pairs.

The graph is refined on vectors rounded to bytes; every decision about a link
is made on double-precision cosines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweave.llm.common import staged
from geoweave.llm.components import connected_components

#: Rounding to bytes moves a cosine by less than this.
ROUNDING = 0.02
#: Chance that two vectors at the threshold share their signs in some table of the first graph.
MEET = 0.99


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dim, class key, unit vector (doubles), unit vector rounded to bytes; null where unusable."""
    for batch in batches:
        dims, keys, units, small = [], [], [], []
        for value in batch.column(1):
            x = np.array(value.as_py() if value.is_valid else [], dtype=float)  # null components become nan
            top = np.abs(x).max() if len(x) else 0.0
            if not (np.isfinite(top) and top > 0):
                for column in (dims, keys, units, small):
                    column.append(None)
                continue
            u = x / top
            u /= np.sqrt(u @ u)
            dims.append(len(x))
            keys.append(xxhash.xxh128_digest((x + 0.0).tobytes()))
            units.append(u.tobytes())
            small.append(np.rint(u * (127 / np.abs(u).max())).astype(np.int8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(units, pa.binary()),
             pa.array(small, pa.binary())], names=["vec_id", "dim", "class", "unit", "q"])


def _unit_rows(column: pa.Array) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1).astype(np.float32)
    return x / np.sqrt(np.square(x).sum(axis=1))[:, None]


def _signs(tables: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {}
        for batch in batches:
            dim = batch.column(1).to_numpy(zero_copy_only=False)
            codes = np.zeros((batch.num_rows, tables), np.int64)
            for d in np.unique(dim):
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).normal(size=(int(d), tables * bits)).astype(np.float32)
                at = np.flatnonzero(dim == d)
                above = (_unit_rows(batch.column(2).take(pa.array(at))) @ planes[d] > 0).reshape(len(at), tables, bits)
                codes[at] = above.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes.tolist(), pa.list_(pa.int64()))],
                                             names=["rep", "dim", "q", "part", "codes"])
    return run


def _local_join(width: int, keep: int, every_pair: bool):
    """Rows sorted by ``width`` key columns, then (rep, q, kth, fresh, part): best partners inside each key.

    Emits (a, b, sim) when b is of another part and would enter a's list;
    unless ``every_pair``, one of the two must be a fresh neighbour.  A key's rows are few (hashed into
    blocks beforehand) and are carried over batch borders.
    """
    def best(rows: pa.RecordBatch):
        rep = rows.column(width).to_numpy(zero_copy_only=False)
        kth = rows.column(width + 2).to_numpy(zero_copy_only=False)
        fresh = rows.column(width + 3).to_numpy(zero_copy_only=False)
        x = _unit_rows(rows.column(width + 1))
        sim = x @ x.T
        part = rows.column(width + 4).to_numpy(zero_copy_only=False)
        sim[part[:, None] == part[None, :]] = -2
        if not every_pair:
            sim[~(fresh[:, None] | fresh[None, :])] = -2
        k = min(keep, len(rep) - 1)
        top = np.argpartition(-sim, k - 1, axis=1)[:, :k] if k < len(rep) - 1 else np.argsort(-sim, axis=1)[:, :k]
        a = np.repeat(np.arange(len(rep)), k)
        b, s = top.ravel(), np.take_along_axis(sim, top, axis=1).ravel()
        ok = (s > -2) & (s > kth[a])
        return rep[a[ok]], rep[b[ok]], s[ok].astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            if batch is not None and batch.num_rows == 0:
                continue
            rows = rest if batch is None else batch if rest is None else \
                pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if rows is None:
                continue
            keys = np.column_stack([rows.column(i).to_numpy(zero_copy_only=False) for i in range(width)])
            edges = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            if batch is not None:  # the last key may go on in the next batch
                rest = rows.slice(edges[-2])
                edges = edges[:-1]
            out = [best(rows.slice(i, j - i)) for i, j in zip(edges, edges[1:]) if j - i > 1]
            if out:
                a, b, s = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], names=["a", "b", "sim"])
    return run


def _with_end(batches):
    yield from batches
    yield None


def _confirm(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [float(np.frombuffer(x.as_buffer()) @ np.frombuffer(y.as_buffer())) >= threshold
                  for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    return run


def _count_links(threshold: float):
    """Links of each vector of one group of at most two blocks (side 0 and 1), weighted by class size."""
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(group))
        rep, size = t.column("rep").to_numpy(), t.column("size").to_numpy()
        one_block = bool(t.column("lo")[0].as_py() == t.column("hi")[0].as_py())
        side = t.column("side").to_numpy()
        x = np.frombuffer(b"".join(t.column("unit").to_pylist())).reshape(len(rep), -1)
        count = np.zeros(len(rep), np.int64)
        left = np.flatnonzero(side == 0)
        right = left if one_block else np.flatnonzero(side == 1)
        for i in range(0, len(left), 512):
            near = x[left[i:i + 512]] @ x[right].T >= threshold
            if one_block:
                near[np.arange(near.shape[0]), np.arange(i, i + near.shape[0])] = False
            else:
                count[right] += near.T @ size[left[i:i + 512]]
            count[left[i:i + 512]] += near @ size[right]
        yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(count)], names=["rep", "n"])
    return run


def _brute(queries, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim = queries.value
        for batch in batches:
            dim = batch.column(1).to_numpy(zero_copy_only=False)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for d, (names, q) in by_dim.items():
                at = np.flatnonzero(dim == d)
                if len(at):
                    x = np.frombuffer(b"".join(batch.column(2).take(pa.array(at)).to_pylist())).reshape(len(at), -1)
                    i, j = np.nonzero(x @ q.T >= threshold)
                    out_a.append(names[j])
                    out_b.append(ids[at[i]])
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])
    return run


def _best_of(candidates: DataFrame, k: int, threshold: float) -> DataFrame:
    """The k best partners of every node, and up to 8 k while they are near-duplicates (a saturated list)."""
    pairs = candidates.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    nth = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return pairs.withColumn("nth", nth).where((F.col("nth") <= k) | ((F.col("nth") <= 8 * k) & (F.col("sim") >= threshold - ROUNDING))) \
        .select("a", "b", "sim", "fresh", "nth")


def _blocked(rows: DataFrame, keys: list[str], size: int, salt: int) -> DataFrame:
    """Adds ``block`` so that a (keys, block) holds about ``size`` rows, however many share the keys."""
    n = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > size)
    return rows.join(n, keys, "left").withColumn(
        "block", F.when(F.col("_n").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("rep", F.lit(salt)), F.ceil(F.col("_n") / size)))).drop("_n")


def _tables(bits: int, threshold: float, least: int) -> int:
    """So many tables that a pair at the threshold shares its ``bits`` signs in one of them with probability MEET."""
    alike = min(0.999, (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits)
    return max(least, int(np.ceil(np.log(1 - MEET) / np.log(1 - alike))))


def _first_graph(small: DataFrame, n: int, k: int, tables: int, block: int, threshold: float, seed: int) -> DataFrame:
    bits = max(1, int(np.ceil(np.log2(max(2, n / block)))))
    rows = small.mapInArrow(_signs(_tables(bits, threshold, tables), bits, seed),
                            "rep long, dim int, q binary, part long, codes array<long>") \
        .select("rep", "dim", "q", "part", F.posexplode("codes").alias("t", "code"))
    rows = _blocked(rows, ["t", "dim", "code"], block, seed)
    return _joined(rows.select(F.col("t").cast("long").alias("t"), F.col("dim").cast("long").alias("dim"), "code", "block",
                               "rep", "q", F.lit(-2.0).alias("kth"), F.lit(True).alias("fresh"), "part"), 4, k, True) \
        .withColumn("fresh", F.lit(True))


def _joined(rows: DataFrame, width: int, k: int, every_pair: bool) -> DataFrame:
    keys = rows.columns[:width]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _local_join(width, 2 * k, every_pair), "a long, b long, sim double")


def _descend(graph: DataFrame, small: DataFrame, k: int, block: int, threshold: float, round_: int,
             paths: DataFrame | None = None) -> DataFrame:
    """One round: compare the neighbours (either way, along ``paths`` too) of every node that has a fresh one."""
    edges = graph.select("a", "b", "fresh")
    if paths is not None:
        edges = edges.unionByName(paths.select("a", "b", F.lit(False).alias("fresh")))
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("rep"), "fresh") \
        .union(edges.select(F.col("b").alias("u"), F.col("a").alias("rep"), "fresh")) \
        .groupBy("u", "rep").agg(F.max("fresh").alias("fresh"))
    active = both.where("fresh").select("u").distinct()
    both = both.join(active, "u", "semi")
    # the score to beat: the k-th best so far
    kth = graph.where(F.col("nth") == k).select(F.col("a").alias("rep"), F.col("sim").alias("kth"))
    # lists of a saturated node take any near-duplicate, so its bar is at most the threshold
    rows = _blocked(both, ["u"], block, round_) \
        .join(small.select("rep", "q", "part"), "rep").join(kth, "rep", "left") \
        .select("u", F.col("block").cast("long").alias("block"), "rep", "q",
                F.least(F.coalesce("kth", F.lit(-2.0)), F.lit(threshold - ROUNDING)).alias("kth"), "fresh", "part")
    return _joined(rows, 2, k, False).withColumn("fresh", F.lit(True))


class _Search:
    """Lists of best partners, and every near-duplicate met on the way (``near``), also where a list has no place."""

    def __init__(self, small: DataFrame, n: int, block: int, threshold: float, paths: DataFrame | None = None):
        self.small, self.n, self.block, self.threshold, self.paths = small, n, block, threshold, paths
        self.graph, self.near, self.done = None, None, 0

    def _take(self, found: DataFrame, k: int):
        found = staged(found, "nn-found")
        near = found.where(F.col("sim") >= self.threshold - ROUNDING) \
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        self.near = near if self.near is None else self.near.unionByName(near)
        if self.graph is not None:
            found = self.graph.select("a", "b", "sim", F.lit(False).alias("fresh")).unionByName(found)
        self.graph = staged(_best_of(found, k, self.threshold), "nn-graph")

    def blocks(self, k: int, tables: int, seed: int):
        self._take(_first_graph(self.small, self.n, k, tables, self.block, self.threshold, seed), k)

    def descend(self, k: int, rounds: int):
        for _ in range(rounds):
            self._take(_descend(self.graph, self.small, k, self.block, self.threshold, self.done, self.paths), k)
            self.done += 1
            if self.graph.where("fresh").count() < 0.002 * k * self.n:
                break


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, k: int = 8, tables: int = 4, block: int = 48,
                    rounds: int = 6, audit_rows: int = 512, target_recall: float = 0.98, count_block: int = 2000,
                    seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding",
                    report: dict | None = None) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Two vectors are linked when their cosine, in double precision, is at least
    ``threshold``.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, and so do vectors of different
    dimension.  Equal vectors (repeated rows too) are linked with each other.
    ``n_links`` counts the other rows linked directly; ``component_id`` is the
    smallest vec_id reachable.  Rows without a vec_id have no links, a null
    component and are kept.  An empty table gives no rows; other columns
    (labels) are ignored.

    Only the sample of ``audit_rows`` vectors for the audit is bounded; every
    row is indexed and searched.  The recall it measures (see ``_recall``) is
    put in ``report``; if it stays below ``target_recall``, RuntimeError is
    raised.  ``tables`` is the least number of tables of the first graph.
    """
    spark = embeddings.sparkSession
    base = staged(embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
                  .mapInArrow(_prepared, "vec_id long, dim int, class binary, unit binary, q binary"), "nn-vectors")
    usable = base.where("class is not null and vec_id is not null")
    classes = usable.groupBy("class").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    reps = staged(usable.join(classes.select("class", F.col("rep").alias("vec_id"), "size"), ["class", "vec_id"])
                  .dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("rep"), "dim", "size", "unit", "q"), "nn-reps")
    n = reps.count()
    small = reps.select("rep", "dim", "q", F.col("rep").alias("part"))
    truth = _audit_links(reps, audit_rows, threshold)
    labels = reps.select("rep", F.col("rep").alias("component"))
    search = _Search(small, n, block, threshold)
    while True:
        # after the first time: more tables of blocks join the graph
        search.blocks(k, tables, seed + search.done)
        search.descend(k, rounds)
        near = search.graph.where((F.col("sim") >= threshold - ROUNDING) & (F.col("nth") <= k)).select("a", "b")
        labels, _ = _merged(labels, near, reps, threshold)
        labels, _ = _merged(labels, search.near, reps, threshold)
        labels = _across(search.graph, small, labels, reps, k, tables, block, threshold, rounds, seed + search.done)
        recall = _recall(truth, labels, k)
        if report is not None:
            report |= {"recall": recall, "rounds": search.done, "list": k}
        if recall >= target_recall:
            break
        if search.done >= 4 * rounds:
            raise RuntimeError(f"recall of links is {recall:.4f} after {search.done} rounds with lists of {k}, "
                               f"target {target_recall}")
        k += k // 2
    # components of one vector have no links to count
    labels = labels.where("rep != component").union(
        labels.where("rep != component").select("component", "component").distinct()).toDF("node", "component")
    counts = _component_links(reps, labels, threshold, count_block)
    member = classes.join(labels, F.col("rep") == F.col("node"), "left").join(counts.withColumnRenamed("rep", "_rep"), F.col("rep") == F.col("_rep"), "left") \
        .select("class", F.coalesce("component", "rep").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n"))
    return base.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("class")).alias("class")).join(member, "class", "left") \
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _confirmed(near: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    return near.join(reps.select(F.col("rep").alias("a"), F.col("unit").alias("x")), "a") \
        .join(reps.select(F.col("rep").alias("b"), F.col("unit").alias("y")), "b").select("a", "b", "x", "y") \
        .mapInArrow(_confirm(threshold), "a long, b long")


def _merged(labels: DataFrame, near: DataFrame, reps: DataFrame, threshold: float) -> tuple[DataFrame, bool]:
    """``labels`` (rep, component) with the components joined that a confirmed pair of ``near`` links; whether any are."""
    x, y = (labels.select(F.col("rep").alias(c), F.col("component").alias("c" + c)) for c in "ab")
    apart = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct() \
        .join(x, "a").join(y, "b").where("ca != cb")
    links = staged(_confirmed(apart.select("a", "b"), reps, threshold).join(x, "a").join(y, "b")
                   .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "nn-links")
    if links.isEmpty():
        return labels, False
    to = connected_components(links).distinct().withColumnRenamed("component", "to")
    return staged(labels.join(to, F.col("component") == F.col("node"), "left")
                  .select("rep", F.coalesce("to", "component").alias("component")), "nn-labels"), True


def _across(graph: DataFrame, small: DataFrame, labels: DataFrame, reps: DataFrame, k: int, tables: int, block: int,
            threshold: float, rounds: int, seed: int) -> DataFrame:
    """``labels`` after a search for links between components.

    A list with fewer than k near-duplicates has lost none for want of place.
    Nodes with more get new lists that take partners of other components only,
    refined along both kinds of lists, until no components join any more.
    """
    full = graph.where((F.col("nth") == k) & (F.col("sim") >= threshold - ROUNDING)).select(F.col("a").alias("rep"))
    full = staged(small.drop("part").join(full, "rep", "semi"), "nn-full")
    paths = graph.where(F.col("nth") <= k)
    n, joined = full.count(), True
    while joined:
        nodes = full.join(labels.withColumnRenamed("component", "part"), "rep").select("rep", "dim", "q", "part")
        if nodes.select("part").distinct().count() < 2:
            break
        search = _Search(staged(nodes, "nn-nodes"), n, block, threshold, paths)
        seed += 101
        search.blocks(k, tables, seed)
        search.descend(k, rounds)
        labels, joined = _merged(labels, search.near, reps, threshold)
    return labels


def _component_links(reps: DataFrame, labels: DataFrame, threshold: float, block: int) -> DataFrame:
    """Exact number of links of every vector in a component, by blocks against blocks."""
    m = labels.join(reps, F.col("node") == F.col("rep")).select("component", "rep", "size", "unit", "dim")
    cuts = m.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("cuts"))
    m = m.join(cuts, "component").withColumn("cut", F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return m.select("component", F.least("cut", "other").alias("lo"), F.greatest("cut", "other").alias("hi"),
                    (F.col("cut") > F.col("other")).cast("int").alias("side"), "rep", "size", "unit") \
        .groupBy("component", "lo", "hi").applyInArrow(_count_links(threshold), "rep long, n long") \
        .groupBy("rep").agg(F.sum("n").alias("n"))


def _audit_links(reps: DataFrame, rows: int, threshold: float) -> DataFrame:
    """True links of a bounded sample against all representatives (the sample is broadcast)."""
    by_dim: dict[int, list] = {}
    for r in reps.orderBy(F.xxhash64("rep", F.lit(17)), "rep").limit(rows).select("rep", "dim", "unit").collect():
        by_dim.setdefault(r["dim"], []).append((r["rep"], np.frombuffer(r["unit"])))
    shared = reps.sparkSession.sparkContext.broadcast(
        {d: (np.array([i for i, _ in x]), np.array([u for _, u in x])) for d, x in by_dim.items()})
    return staged(reps.select("rep", "dim", "unit").mapInArrow(_brute(shared, threshold), "a long, b long"), "nn-audit")


def _recall(truth: DataFrame, labels: DataFrame, few: int) -> float:
    """Mean share of an audited vector's links whose ends lie in one component (1.0 if there are none).

    Taken over all audited vectors with links, and over those with at most
    ``few``, so that large groups do not hide the others; the lower one counts.
    """
    x, y = (labels.select(F.col("rep").alias(c), F.col("component").alias("c" + c)) for c in "ab")
    share = truth.join(x, "a").join(y, "b").groupBy("a") \
        .agg(F.avg((F.col("ca") == F.col("cb")).cast("int")).alias("share"), F.count("*").alias("n"))
    means = share.agg(F.avg("share"), F.avg(F.when(F.col("n") <= few, F.col("share")))).first()
    return min((m for m in means if m is not None), default=1.0)
