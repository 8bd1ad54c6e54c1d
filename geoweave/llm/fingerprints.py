"""Document fingerprints from modular prefix polynomial hashes.

``P[i] = sum(c[j] * B**j for j < i) mod p`` answers the hash of any span in
constant time: ``(P[j] - P[i]) * B**-i mod p`` depends on the characters of the
span alone.  Two bases modulo the Mersenne prime 2**31 - 1 give 62 bits.  Span
equality compares two such hashes; the longest common extension of two
positions is found by binary search on the length.

A fingerprint is the sorted list of the smallest mixed hashes of all spans of
``SPAN`` characters; the likeness of two fingerprints estimates the share of
spans the texts have in common.  How far two texts agree from their start on
is their longest common extension at 0, found on the prefix arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOD = np.uint64((1 << 31) - 1)
BASES = (1_234_567_891, 987_654_323)
SPAN, KEEP = 12, 64
_S31 = np.uint64(31)


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1 for x below 2**62."""
    x = (x & MOD) + (x >> _S31)
    x = (x & MOD) + (x >> _S31)
    return np.where(x >= MOD, x - MOD, x)


class _Powers:
    """Powers of a base and of its inverse, grown by doubling as texts need them."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, int(MOD))
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, _mod(self.up * np.uint64(pow(self.base, k, int(MOD))))])
            self.down = np.concatenate([self.down, _mod(self.down * np.uint64(pow(self.inverse, k, int(MOD))))])
        return self.up, self.down


_POWERS = [_Powers(b) for b in BASES]


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class PrefixHash:
    """Prefix hashes of one text (code points)."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        c = codes.astype(np.uint64) + np.uint64(1)
        self.prefix = []
        for p in _POWERS:
            up, _ = p.to(self.n + 1)
            total = np.cumsum(_mod(c * up[:self.n]), dtype=np.uint64)  # terms below 2**31, so fewer than 2**33 fit
            self.prefix.append(np.concatenate((np.zeros(1, np.uint64), _mod(total))))

    def spans(self, starts, ends) -> np.ndarray:
        """62-bit hashes of the spans ``[start, end)``."""
        starts, ends = np.atleast_1d(np.asarray(starts, np.int64)), np.atleast_1d(np.asarray(ends, np.int64))
        out = np.zeros(len(starts), np.uint64)
        for p, pre in zip(_POWERS, self.prefix):
            _, down = p.to(self.n + 1)
            out = (out << _S31) | _mod(_mod(pre[ends] + MOD - pre[starts]) * down[starts])
        return out

    def windows(self, first: int, last: int, width: int) -> np.ndarray:
        """Hashes of the spans of ``width`` that start at ``first`` .. ``last - 1``."""
        out = np.zeros(max(0, last - first), np.uint64)
        if len(out):
            for p, pre in zip(_POWERS, self.prefix):
                _, down = p.to(self.n + 1)
                step = _mod(pre[first + width:last + width] + MOD - pre[first:last])
                out = (out << _S31) | _mod(step * down[first:last])
        return out


def span_equal(a: PrefixHash, i: int, b: PrefixHash, j: int, length: int) -> bool:
    """Whether a[i:i+length] and b[j:j+length] are the same characters."""
    if min(i, j, length) < 0 or i + length > a.n or j + length > b.n:
        return False
    return a.spans(i, i + length)[0] == b.spans(j, j + length)[0]


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """Length of the longest common prefix of a[i:] and b[j:]: doubled lengths up to a miss, then binary search."""
    low, high = 0, max(0, min(a.n - i, b.n - j))
    step = 1
    while step < high:
        if not span_equal(a, i, b, j, step):
            high = step - 1
            break
        low, step = step, 2 * step
    while low < high:
        mid = (low + high + 1) // 2
        if span_equal(a, i, b, j, mid):
            low = mid
        else:
            high = mid - 1
    return low


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> _S31)) >> np.uint64(32)


def smallest(h: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` smallest distinct values, sorted."""
    if len(h) > 4 * keep:
        low = np.unique(np.partition(h, 4 * keep - 1)[:4 * keep])
        if len(low) >= keep:
            return low[:keep]
    return np.unique(h)[:keep]


def likeness(a: np.ndarray, b: np.ndarray, keep: int = KEEP) -> float:
    """Share of common spans, estimated on the smallest values of both fingerprints; two empty ones: 1."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:keep]
    return float(np.isin(union, a, assume_unique=True).__and__(np.isin(union, b, assume_unique=True)).mean())


def as_text(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


class _Print:
    """A text with its code points, prefix hashes, span hashes and fingerprint."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.codes = codes_of(self.text)
        self.n = len(self.codes)
        self.width = min(SPAN, self.n)
        self.hashes = np.empty(0, np.uint64)
        self.prefix = PrefixHash(self.codes)
        if self.n:
            self.hashes = _mixed(self.prefix.windows(0, self.n - self.width + 1, self.width))
        self.values = smallest(self.hashes, KEEP)

    def edited(self, other: _Print) -> tuple[bytes, np.ndarray]:
        """UTF-8 and fingerprint values after the last quarter is replaced by the start of ``other``.

        Spans before the replaced part are those of this text; only the rest is hashed again.
        """
        q = self.n // 4
        m = self.n - q
        data = (self.text[:m] + other.text[:q]).encode("utf-8", "surrogatepass")
        codes = np.concatenate((self.codes[:m], other.codes[:q]))
        width = min(SPAN, len(codes))
        if len(codes) == 0:
            return data, np.empty(0, np.uint64)
        kept = m - width + 1 if width == self.width else 0
        tail = codes[max(0, kept):]
        fresh = _mixed(PrefixHash(tail).windows(0, len(tail) - width + 1, width))
        return data, smallest(np.concatenate((self.hashes[:max(0, kept)], fresh)), KEEP)


    def same_start(self, other: _Print) -> tuple[int, int]:
        """Longest common prefix with the edited text, and with ``other``."""
        m = self.n - self.n // 4

        def extension(at: int) -> int:
            if at >= self.n or not other.n or self.codes[at] != other.codes[0]:
                return 0  # most texts: no hash is needed
            return common_extension(self.prefix, at, other.prefix, 0)
        return m + extension(m), extension(0)


COLUMNS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, prefix_edited long, prefix_next long")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, borrowed, doc_id, text) in order; a bucket ends with the first row of the next one."""
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
    before = None
    for batch in batches:
        out = [[] for _ in kinds]
        for bucket, borrowed, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                  batch.column(2).to_pylist(), batch.column(3)):
            if borrowed and (before is None or before[0] != bucket):
                continue  # the row next to the last one has been used
            now = _Print(text.as_py())
            if before is not None and before[0] == bucket:
                last = before[2]
                data, values = last.edited(now)
                for column, x in zip(out, (before[1], last.n, hashlib.sha256(data).hexdigest(), as_text(last.values),
                                           as_text(values), likeness(last.values, values),
                                           likeness(last.values, now.values), *last.same_start(now))):
                    column.append(x)
            before = None if borrowed else (bucket, doc_id, now)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                         names=[c.split()[0] for c in COLUMNS.split(", ")])


def _place(x: Column, bounds: list[int], fan: int = 256) -> Column:
    """How many of the sorted ``bounds`` are at most ``x``: two steps of at most ``fan`` comparisons."""
    if not bounds:
        return F.lit(0)

    def below(values):
        return F.size(F.filter(values, lambda b: b <= x))
    parts = [bounds[i:i + fan] for i in range(0, len(bounds), fan)]
    coarse = below(F.array(*[F.lit(p[0]) for p in parts]))
    fine = F.get(F.array(*[F.array(*[F.lit(b) for b in p]) for p in parts]), coarse - 1)
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * fan + below(fine)).cast("int")


def fingerprints(docs: DataFrame, rows_per_bucket: int = 4000, max_buckets: int = 65_536, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Fingerprint of every whole text and of its edited text, two likenesses and two common prefixes.

    The edited text has its last quarter (rounded down, in code points)
    replaced by as many first code points of the next document in ascending
    doc_id (all of them if it has fewer); the first document follows the last.
    ``prefix_edited`` and ``prefix_next`` are the lengths, in code points, of
    the longest common prefix with the edited text and with the next document.
    Equal texts have equal fingerprints.  Null texts count as empty; two empty
    texts are alike (1.0), an empty and another are not (0.0).  Rows with equal
    doc_id stand in the order of a hash of their text, rows without one come
    first.  An empty table gives no rows; other columns are ignored.

    Documents are dealt into ranges of doc_id by quantiles of the ids, sorted
    within a range by Spark and read as a stream; each range borrows the first
    document of the next one.  So texts move once and no task holds a range.
    """
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_at"),
                    F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = d.select("_at")
    n = min(max_buckets, max(1, ids.count() // rows_per_bucket))
    bounds = []
    if n > 1:
        cuts = ids.agg(F.percentile_approx("_at", [i / n for i in range(1, n)], 10 * n)).first()[0]
        bounds = sorted(set(cuts or []))
    firsts = ids.groupBy(_place(F.col("_at"), bounds).alias("b")).agg(F.min("_at").alias("at")).orderBy("b").collect()
    # at most one row per range: which document each range borrows
    lends = {at: firsts[k - 1]["b"] for k, (_, at) in enumerate(firsts)}  # the first is lent to the last
    own = d.withColumn("bucket", _place(F.col("_at"), bounds).cast("long")).withColumn("borrowed", F.lit(0).cast("long"))
    out = own
    if lends:
        lent = F.create_map(*[F.lit(x) for at, b in lends.items() for x in (at, b)])
        to = F.when(F.col("_at").isin(list(lends)), F.element_at(lent, F.col("_at")).cast("long"))
        out = own.withColumn("_copy", F.explode(F.when(to.isNotNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
            .withColumn("bucket", F.when(F.col("_copy") == 1, to).otherwise(F.col("bucket"))) \
            .withColumn("borrowed", F.col("_copy").cast("long"))
    parts = max(len(bounds) + 1, 1)
    return out.withColumn("_tie", F.xxhash64("text")) \
        .repartition(parts, "bucket").sortWithinPartitions("bucket", "borrowed", "_at", "_tie") \
        .select("bucket", "borrowed", "doc_id", "text").mapInArrow(_walk, COLUMNS)
