"""Minimax contiguous partition of a table into shards of near-equal bytes.

Rows with equal texts are one atomic group; groups stand in the order of their
smallest doc_id.  The smallest shard capacity for which a greedy pass needs at
most ``shards`` shards is found by binary search, and the order is cut there.
A group larger than the capacity has a shard of its own, so one large group of
copies sets the largest shard and does not empty the others.

The driver never holds the groups.  It works on sums over ranges of the order
(a bounded number), where a greedy pass gives a lower and an upper bound of
every cut.  Ranges that a cut may fall into are summed again in finer steps,
by one aggregation each time, until bounds and cuts agree; the result is the
exact optimum.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import numbered, staged

#: Bytes a row counts for besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Range:
    """Groups whose place in the order is in ``[start, start + width)``."""
    start: int
    width: int
    size: int
    single: bool  # holds one group only: no cut falls inside


def _steps(ends: list[int], ranges: list[Range], capacity: int, shards: int) -> tuple[list[int], list[int]]:
    """Lower and upper bounds (in bytes of the order) of the greedy cuts for one capacity.

    A shard takes groups while they fit; a group larger than the capacity has
    a shard of its own.
    """
    low, high, n = [0], [0], len(ends)
    for _ in range(shards):
        k = bisect_right(ends, low[-1] + capacity)
        at = ends[k - 1] if k else 0
        if at <= low[-1] and k < n and ranges[k].single:
            at = ends[k]
        low.append(max(low[-1], at))
        t = high[-1] + capacity
        k = bisect_right(ends, t)
        at = ends[k - 1] if k else 0
        if k < n and not ranges[k].single:  # a cut may lie inside; a large group in it may end as late as it does
            at = t if ranges[k].size <= capacity else ends[k]
        elif k < n and at <= high[-1]:
            at = ends[k]
        high.append(max(high[-1], at))
    return low, high


def _least(holds, low: int, high: int) -> int:
    """Smallest x in [low, high] for which the monotone ``holds`` is true (high if none is)."""
    while low < high:
        mid = (low + high) // 2
        if holds(mid):
            high = mid
        else:
            low = mid + 1
    return low


def minimax_cuts(count_ranges, total: int, largest: int, span: int, shards: int, fan: int = 4096) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the places in the order where shards 1, 2, ... start.

    ``count_ranges(wanted, old_width, width)`` returns ``Range`` objects of
    ``width`` for the ranges of ``old_width`` that start at the ``wanted``
    places (None: everywhere).  At most ``16 * fan`` ranges are asked for at once.
    """
    width = 1
    while width * fan < span:
        width *= 2
    ranges = sorted(count_ranges(None, None, width), key=lambda r: r.start)
    low, high = 1, -(-total // shards) + largest
    while True:
        ends, at = [], 0
        for r in ranges:
            at += r.size
            ends.append(at)
        high = _least(lambda c: _steps(ends, ranges, c, shards)[0][-1] >= total, low, high)
        low = _least(lambda c: _steps(ends, ranges, c, shards)[1][-1] >= total, low, high)
        first, last = _steps(ends, ranges, low, shards)[0], _steps(ends, ranges, high, shards)[1]
        open_ = set()
        for a, b in zip(first[1:], last[1:]):
            k = bisect_right(ends, a)
            while k < len(ranges) and (ends[k - 1] if k else 0) <= b:
                if not ranges[k].single:
                    open_.add(k)
                k += 1
        if not open_:
            starts = []
            for cut in _steps(ends, ranges, high, shards)[0][1:shards]:
                k = bisect_right(ends, cut)
                starts.append(ranges[k].start if k < len(ranges) else span)
            return high, starts
        by_width: dict[int, list[int]] = {}
        for k in open_:
            by_width.setdefault(ranges[k].width, []).append(k)
        split = max(2, 16 * fan // len(open_))
        fresh = []
        for old, members in by_width.items():
            new = old
            while new > 1 and old // new < split:
                new //= 2
            fresh += count_ranges([ranges[k].start for k in members], old, new)
        ranges = sorted([r for k, r in enumerate(ranges) if k not in open_] + fresh, key=lambda r: r.start)


def shard_by_bytes(docs: DataFrame, shards: int = 40, fan: int = 4096, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text (0 if null) plus 16; ``text_crc32``
    is unsigned and 0 for null or empty texts.  The largest shard is as small
    as a contiguous partition of the ordered groups allows.  Groups are equal
    texts (nulls are equal to each other); groups with the same smallest
    doc_id are kept together, and groups without a doc_id come first.  Slots
    number a shard's rows gaplessly from 0, repeated rows included; later
    shards may stay empty when there are few groups.  An empty table gives no
    rows; other columns are ignored.  ``law`` is ``bytes`` and
    ``grown_shard`` null, as another shard count moves rows between shards.
    """
    text = F.col(text_col).cast("string")
    rows = staged(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("key")), "shard-rows")
    groups = staged(rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes")), "shard-groups")
    lo, hi, n = groups.agg(F.min("first"), F.max("first"), F.count("*")).first()
    wide = "decimal(38,0)" if lo is not None and hi - lo >= 1 << 62 else "long"
    lo = 0 if lo is None else lo
    place = F.coalesce(F.col("first").cast(wide) - F.lit(lo).cast(wide) + 1, F.lit(0).cast(wide))
    placed = groups.withColumn("place", place)

    def number(x: int):
        return F.lit(x) if wide == "long" else F.lit(str(x)).cast(wide)

    span = (0 if hi is None else hi - lo) + 2
    total, largest = placed.groupBy("place").agg(F.sum("bytes").alias("b")).agg(F.sum("b"), F.max("b")).first() if n else (0, 0)

    def at(width: int):
        if wide == "long":
            return F.expr(f"place div {width}L")
        return ((F.col("place") - F.pmod(F.col("place"), number(width))) / number(width)).cast(wide)

    def count_ranges(wanted, old, width):
        some = placed if wanted is None else placed.where(at(old).isin(*[number(w // old) for w in wanted] if wide != "long" else [w // old for w in wanted]))
        found = some.groupBy(at(width).alias("k")).agg(F.sum("bytes").alias("b"), F.min("place").alias("x"), F.max("place").alias("y"))
        return [Range(int(r["k"]) * width, width, int(r["b"]), r["x"] == r["y"]) for r in found.collect()]

    starts = minimax_cuts(count_ranges, total, largest, span, shards, fan)[1] if n else []
    shard = F.lit(0)
    for s in starts:
        shard = shard + (F.col("place") >= number(s)).cast("int")
    cut = placed.select(F.col("key").alias("_key"), shard.cast("int").alias("shard"))
    dealt = staged(rows.join(cut, F.col("key") == F.col("_key")).select("doc_id", "size", "text_crc32", "shard"), "shard-dealt")
    return numbered(dealt, "shard", ["doc_id", "text_crc32", "size"], "slot") \
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"))
