"""Near-duplicate documents: MinHash banding, signature check, exact check, components.

1. One Arrow pass over the texts makes per document: the number of distinct
   word shingles, a 128-bit digest of the shingle set, ``bands * rows``
   universal-hash minima (eight bits of each, mixed first, are kept as the
   signature) and one 64-bit key per band.
2. Documents with equal shingle sets form a class; only its representative
   (smallest doc_id) goes on, so thousands of copies cost one row.
3. In every band bucket each member is paired with the bucket's smallest
   member (a star: as many pairs as rows).  Pairs are screened by size and
   signature and confirmed on the full shingle sets; a member's partners are
   dealt to blocks, and its own set is sent once to each.
4. Components by large-star / small-star.
5. Buckets that still hold several components are searched in full, as blocks
   of signatures, for members of different components that look alike; these
   tie the components into families.  Inside a family every member outside the
   largest component is compared with all members on full sets, in blocks.  So
   no pair that shares a band and reaches the threshold is lost to the star,
   yet copies already tied together are never paired again, and only edges that
   tie something leave a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import staged
from geoweave.llm.components import connected_components

SKETCH = "doc_id long, n_shingles long, set_hash binary, sig binary, bands array<long>, text_key long"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD))
#: Below the threshold by this much, a signature estimate rules a pair out (over five standard deviations
#: at 300 minima).
SLACK = 0.12
#: The first pass (stars) tests only pairs whose estimate nearly reaches the threshold; what it leaves out is
#: found by the second, which uses SLACK.
STAR_SLACK = 0.02


def shingle_set(text: str | None, words_per_shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text (A-Z lower-cased).

    Words are runs of bytes other than space and \\x09-\\x0D.  Fewer words than
    a shingle make one shingle; no words make an empty set.
    """
    if not text:
        return np.empty(0, "<u8")
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, "<u8")
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], dtype=np.uint64)
    k = min(words_per_shingle, len(h))
    x = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        x = (x ^ h[i:len(h) - k + 1 + i]) * _MIX[0]
        x ^= x >> np.uint64(29)
    x *= _MIX[2]
    x ^= x >> np.uint64(32)
    return np.unique(x)


def hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and increments of ``count`` multiply-add hashes modulo 2**64."""
    r = np.random.default_rng(seed)
    full = np.iinfo(np.uint64).max
    return (r.integers(0, full, count, dtype=np.uint64, endpoint=True) | np.uint64(1),
            r.integers(0, full, count, dtype=np.uint64, endpoint=True))


def minima(x: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 512) -> np.ndarray:
    best = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(x), block):
        y = x[i:i + block, None] * a[None, :]
        y += b[None, :]
        np.minimum(best, y.min(axis=0), out=best)
    return best


def signature(m: np.ndarray) -> bytes:
    """One byte of each minimum, mixed first: a minimum over many shingles is a small number, whose own top byte is 0."""
    y = m * _MIX[0]
    y ^= y >> np.uint64(29)
    return (y * _MIX[2] >> np.uint64(56)).astype(np.uint8).tobytes()


def _sketcher(words: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_family(bands * rows, seed)
        for batch in batches:
            ids, ns, hashes, sigs, keys = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = shingle_set(text.as_py(), words)
                ids.append(doc_id)
                ns.append(len(x))
                if len(x) == 0:
                    hashes.append(None), sigs.append(None), keys.append(None)
                    continue
                m = minima(x, a, b)
                hashes.append(xxhash.xxh128_digest(x.tobytes()))
                sigs.append(signature(m))
                parts = m.reshape(bands, rows)
                keys.append([xxhash.xxh64_intdigest(p.tobytes(), seed=i) - (1 << 63) for i, p in enumerate(parts)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(hashes, pa.binary()),
                 pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64())), batch.column(2)],
                names=["doc_id", "n_shingles", "set_hash", "sig", "bands", "text_key"])
    return run


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimate of signature rows; equal bytes by chance are taken off."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _screen(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array(_likeness(x, y) >= limit))
    return run


def _set_maker(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "s"])
    return run


def _confirm(percent: int):
    """Links of one document (the row without ``b``) with a block of its partners, on full sets."""
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, others, links = [], [], []  # rows that share a doc_id are one vertex with several sets
        t = pa.Table.from_batches(list(group))
        a = t.column("a")[0].as_py()
        for b, s in zip(t.column("b").to_pylist(), t.column("s").combine_chunks()):
            x = np.frombuffer(s.as_buffer(), "<u8")
            own.append(x) if b is None else others.append((b, x))
        for b, y in others:
            both = [len(np.intersect1d(x, y, assume_unique=True)) for x in own]
            if any(100 * n >= percent * (len(x) + len(y) - n) for n, x in zip(both, own)):
                links.append(b)
        yield _pairs([a] * len(links), links)
    return run


class _Union:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _pairs(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    side = t.column("side").to_numpy()
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def _families(limit: float):
    """Members of one bucket that look alike across components, tied to one of them each.

    Rows carry ``side`` 0 or 1; a group of side 0 only is searched within itself.
    """
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(group))
        rep, comp = t.column("rep").to_numpy(), t.column("comp").to_numpy()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(rep), -1)
        left, right = _sides(t)
        if t.column("lo")[0].as_py() == t.column("hi")[0].as_py():
            right = left
        tied = _Union(len(rep))
        for i in left.tolist():
            js = right[comp[right] != comp[i]]
            for j in js[_likeness(sig[js], sig[i][None, :]) >= limit].tolist() if len(js) else ():
                tied.join(i, j)
        root = np.array([tied.root(i) for i in range(len(rep))], int)
        at = np.flatnonzero(root != np.arange(len(rep)))
        yield _pairs(rep[root[at]], rep[at])
    return run


def _exact_links(percent: int):
    """Links between components inside one family: rows of side 0 against rows of side 1 on full sets.

    The sets of side 1 are numbered into one array, so all its intersections
    with a row of side 0 are one pass over that array.  Of the links found, as
    many are returned as tie the components together.
    """
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(group))
        rep, comps = t.column("rep").to_numpy(), t.column("comp").to_numpy()
        comp = np.unique(comps, return_inverse=True)[1]
        left, right = _sides(t)
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in t.column("s").combine_chunks()]
        out_a, out_b, tied = [], [], _Union(len(rep))
        if len(left) and len(right):
            known, codes = np.unique(np.concatenate([sets[j] for j in right]), return_inverse=True)
            sizes = np.array([len(sets[j]) for j in right])
            starts = np.cumsum(sizes) - sizes
            mark = np.zeros(len(known), np.int32)
            for i in left.tolist():
                at = np.searchsorted(known, sets[i])
                at[at == len(known)] = 0
                at = at[known[at] == sets[i]]
                mark[at] = 1
                both = np.add.reduceat(mark[codes], starts)
                mark[at] = 0
                near = right[(100 * both >= percent * (len(sets[i]) + sizes - both)) & (comp[right] != comp[i])]
                for j in near.tolist():
                    if tied.join(int(comp[i]), int(comp[j])):
                        out_a.append(int(rep[i]))
                        out_b.append(int(rep[j]))
        yield _pairs(out_a, out_b)
    return run


def sketch(docs: DataFrame, words: int, bands: int, rows: int, seed: int, id_col="doc_id", text_col="text"):
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key")) \
        .mapInArrow(_sketcher(words, bands, rows, seed), SKETCH)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 44, rows: int = 7,
                    seed: int = 11, bucket_block: int = 2000, id_col: str = "doc_id",
                    text_col: str = "text", text_key: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and with ``text_key`` the xxhash64 of its text.

    Two documents are linked when ``100 * |A and B| >= percent * |A or B|`` on
    their full sets of ``words``-word shingles; ``component_id`` is the
    smallest doc_id reachable.  A pair at similarity s shares no band, and is
    missed, with probability ``(1 - s**rows)**bands`` (defaults: 3e-5 at 0.80,
    4e-8 at 0.85).  Other columns of ``docs`` are ignored.

    Null, empty or blank texts have no shingles and are linked with nothing.
    Equal sets (ties, repeated rows) are always linked.  Rows that share a
    doc_id are one vertex.  Rows without a doc_id can be no end of a link:
    their component_id is null and they are kept.  An empty table gives no
    rows.  Nothing is capped or sampled; memory is bounded by one Arrow batch
    and by blocks of ``bucket_block`` signatures.
    """
    limit = percent / 100 - SLACK
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    s = staged(sketch(base, words, bands, rows, seed), "minhash-sketch")
    classes = s.where("n_shingles > 0 and doc_id is not null").groupBy("set_hash").agg(F.min("doc_id").alias("rep"))
    reps = staged(s.where("n_shingles > 0").join(classes.withColumnRenamed("rep", "doc_id"), ["set_hash", "doc_id"], "semi")
                  .dropDuplicates(["doc_id", "set_hash"])
                  .select(F.col("doc_id").alias("rep"), "sig", "bands", F.col("n_shingles").alias("n")), "minhash-reps")
    members = reps.select("rep", F.explode("bands").alias("key"))
    # the bucket's smallest member stands for it; buckets of one row vanish here
    centres = members.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")) \
        .where("centre < last").select("key", "centre")
    shared = staged(members.join(centres, "key"), "minhash-shared")
    star = shared.where("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    links = _checked(base, reps, star, words, percent, percent / 100 - STAR_SLACK)
    labels = connected_components(links)
    families = connected_components(_alike(shared, reps, labels, limit, bucket_block))
    more = _settled(base, s, families, labels, words, percent)
    if not more.isEmpty():
        labels = connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                      .union(more.select("a", "b")))
    labels = labels.distinct()
    return (s.select("doc_id", "n_shingles", "set_hash", "text_key").join(classes, "set_hash", "left")
            .join(labels, F.col("rep") == F.col("node"), "left")
            .select("doc_id", "n_shingles", *["text_key"] * text_key,
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _sets_of(base: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Shingle sets ``(doc_id, s)`` of the documents in ``wanted(doc_id)``."""
    return base.join(wanted, "doc_id", "semi").mapInArrow(_set_maker(words), "doc_id long, s binary").where(F.length("s") > 0)


def _checked(base: DataFrame, reps: DataFrame, pairs: DataFrame, words: int, percent: int, limit: float,
             rows: int = 256, shingles: int = 500_000) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link, that pass the signature screen and then the exact test, staged.

    ``a`` may have any number of partners: they are dealt to blocks of about
    ``rows`` rows and ``shingles`` shingles, and the set of ``a`` is sent once
    to each block.
    """
    left, right = (reps.select(F.col("rep").alias(k), F.col("sig").alias("sig_" + k), F.col("n").alias("n_" + k)) for k in "ab")
    pairs = staged(pairs.join(left, "a").join(right, "b")
                   .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b", "sig_a", "sig_b")
                   .mapInArrow(_screen(limit), "a long, b long").distinct(), "minhash-pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = staged(_sets_of(base, wanted, words), "minhash-sets")
    cuts = pairs.join(reps.select(F.col("rep").alias("b"), "n"), "b").groupBy("a").agg(
        F.greatest(F.ceil(F.count("*") / rows), F.ceil(F.sum("n") / shingles)).cast("int").alias("cuts"))
    others = pairs.join(sets.withColumnRenamed("doc_id", "b"), "b").join(cuts, "a") \
        .select("a", F.pmod(F.xxhash64("b"), F.col("cuts")).cast("int").alias("cut"), "b", "s")
    own = sets.withColumnRenamed("doc_id", "a").join(cuts, "a") \
        .select("a", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"), F.lit(None).cast("long").alias("b"), "s")
    return staged(others.union(own).groupBy("a", "cut").applyInArrow(_confirm(percent), "a long, b long").distinct(), "minhash-links")


def _alike(shared: DataFrame, reps: DataFrame, labels: DataFrame, limit: float, block: int) -> DataFrame:
    """Edges that tie members of different components which share a bucket and look alike by signature.

    At most one edge per row of a bucket.  A bucket larger than ``block`` is
    cut into hashed blocks and every pair of blocks is a group of its own, so
    no task holds more than two blocks.
    """
    m = shared.join(labels, shared["rep"] == labels["node"], "left") \
        .select("key", "rep", F.coalesce("component", "rep").alias("comp"))
    m = staged(m.distinct(), "minhash-members")
    mixed = m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")) \
        .where("lo < hi").select("key", F.ceil(F.col("n") / block).cast("int").alias("cuts"))
    x = m.join(mixed, "key").withColumn("cut", F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    x = x.select("key", F.least("cut", "other").alias("lo"), F.greatest("cut", "other").alias("hi"),
                 (F.col("cut") > F.col("other")).cast("int").alias("side"), "rep", "comp")
    x = x.join(reps.select("rep", "sig"), "rep")
    return x.groupBy("key", "lo", "hi").applyInArrow(_families(limit), "a long, b long")


def _settled(base: DataFrame, s: DataFrame, families: DataFrame, labels: DataFrame, words: int, percent: int,
             rows: int = 512, shingles: int = 500_000) -> DataFrame:
    """Links between the components of each family, staged.

    Members outside the family's largest component are compared with all
    members, in blocks of about ``rows`` rows and ``shingles`` shingles.
    """
    n = s.groupBy(F.col("doc_id").alias("node")).agg(F.max("n_shingles").alias("n"))
    m = families.distinct().withColumnRenamed("component", "family").join(labels.distinct(), "node", "left") \
        .join(n, "node").select("family", F.col("node").alias("rep"), F.coalesce("component", "node").alias("comp"), "n")
    m = staged(m, "minhash-family")
    parts = m.groupBy("family", "comp").agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_shingles"))

    def cut(n_rows, n_shingles):
        return F.greatest(F.lit(1), F.ceil(n_rows / rows), F.ceil(n_shingles / shingles)).cast("int")
    plan = parts.groupBy("family").agg(
        F.max_by("comp", F.struct("n_rows", "comp")).alias("largest"), F.count("*").alias("comps"),
        cut(F.sum("n_rows"), F.sum("n_shingles")).alias("all_cuts"),
        cut(F.sum("n_rows") - F.max("n_rows"), F.sum("n_shingles") - F.max("n_shingles")).alias("own_cuts")) \
        .where("comps > 1").drop("comps")
    x = m.join(plan, "family")

    def dealt(rows_, own: str, other: str, side: int):
        return rows_.select("family", F.pmod(F.xxhash64("rep"), F.col(own)).cast("int").alias("_own"),
                            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("_other"),
                            F.lit(side).alias("side"), "rep", "comp")
    first = dealt(x.where("comp != largest"), "own_cuts", "all_cuts", 0) \
        .select("family", F.col("_own").alias("lo"), F.col("_other").alias("hi"), "side", "rep", "comp")
    second = dealt(x, "all_cuts", "own_cuts", 1) \
        .select("family", F.col("_other").alias("lo"), F.col("_own").alias("hi"), "side", "rep", "comp")
    sets = staged(_sets_of(base, x.select(F.col("rep").alias("doc_id")).distinct(), words), "minhash-sets")
    y = first.union(second).join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    return staged(y.groupBy("family", "lo", "hi").applyInArrow(_exact_links(percent), "a long, b long").distinct(),
                  "minhash-links")
