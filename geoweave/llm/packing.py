"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Tokenising is one Arrow pass.  What is left of a document beyond whole
sequences has a length below the capacity, so the packing problem is a
histogram of at most ``capacity - 1`` lengths whatever the size of the corpus.
The plan (bin patterns and how often each is used) is made on that histogram;
Spark numbers the pieces of each length and an equi-join on the length deals
the numbered pieces to the bins.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import numbered, staged

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_level_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: character -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_byte_bpe(path: str):
    """A tiktoken encoder with the ids of a byte-level BPE ``tokenizer.json``.

    Ids of that file rise with the merge order, so they serve as ranks.  Added
    tokens are recognised in texts, as the tokenizers library does.
    """
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = byte_level_alphabet()
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(back[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in added}
    # the split pattern of byte-level pre-tokenisation: a fixed value
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)


def _tokeniser(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_byte_bpe(path)
        tail = np.array([end_id], dtype="<u4")
        for batch in batches:
            out = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([enc.encode_to_numpy(text.as_py() or "", allowed_special="all").astype("<u4"), tail])
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    for col, v in zip(out, (doc_id, k, i, j - i, zlib.crc32(ids[i:j].tobytes()))):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


class _Pool:
    """Counts of unpacked pieces by length, with the lengths present kept in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: v for k, v in counts.items() if v}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int = 1) -> None:
        self.counts[length] -= n
        if self.counts[length] == 0:
            del self.counts[length]
            self.lengths.remove(length)

    def give(self, length: int) -> None:
        if length not in self.counts:
            self.counts[length] = 0
            insort(self.lengths, length)
        self.counts[length] += 1

    def best(self, room: int) -> int:
        i = bisect_right(self.lengths, room)
        return self.lengths[i - 1] if i else 0

    def best_two(self, room: int) -> tuple[int, int]:
        """The two unpacked lengths with the largest sum that fits ``room`` (0, 0 if none)."""
        found, i, j = (0, 0), 0, len(self.lengths) - 1
        while 0 <= j and i <= j:
            x, y = self.lengths[i], self.lengths[j]
            if x + y > room:
                j -= 1
            else:
                if x + y > sum(found) and (i < j or self.counts[x] > 1):
                    found = (y, x)
                i += 1
        return found


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best-two-fit on a histogram: [(how many bins, lengths in one bin)].

    A bin starts with the longest piece left and takes the best-fitting piece
    until none fits.  While room is left, its smallest piece is put back if two
    unpacked pieces fill the widened gap more tightly.  The same bin is then
    repeated for as long as the pieces last, so the work depends on the number
    of lengths and not on the number of pieces.
    """
    pool, plan = _Pool(counts), []
    while pool.lengths:
        bin_, room = [], capacity
        while (x := pool.best(room)):
            pool.take(x)
            bin_.append(x)
            room -= x
        while room and len(bin_) > 1:
            least = bin_[-1]
            two = pool.best_two(room + least)
            if sum(two) <= least:
                break
            for x in two:
                pool.take(x)
            pool.give(least)
            bin_[-1:] = sorted(two, reverse=True)
            bin_.sort(reverse=True)
            room += least - sum(two)
        need = {x: bin_.count(x) for x in bin_}
        more = min(pool.counts.get(x, 0) // n for x, n in need.items())
        for x, n in need.items():
            if more:
                pool.take(x, n * more)
        plan.append((1 + more, bin_))
    return plan


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32.  The first piece takes the remainder."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_tokeniser(tokenizer_path, end_id, capacity), PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.  Every document ends with ``end_id``; only documents longer than
    ``capacity`` are cut.  Null or empty texts are the end id alone.  Repeated
    rows (and repeated or null doc_ids) are packed as often as they occur.  An
    empty table gives no rows.  Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    p = staged(pieces_of(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pack-pieces")
    counts = {int(r["length"]): int(r["n"])
              for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots, used, first = [], {}, 0
    for times, bin_ in plan_bins(counts, capacity):
        offset = 0
        for x in bin_:
            at = used.get(x, 0)
            slots.append((x, at, at + times, first, offset))
            used[x] = at + times
            offset += x
        first += times
    # a plan row per bin pattern and slot: bounded by the number of lengths, not by the corpus
    plan = spark.createDataFrame(slots or [(0, 0, 0, 0, 0)],
                                 "length long, from long, to long, first_sequence long, offset long")
    ranked = numbered(p, "length", ["doc_id", "piece", "start", "ids_crc32"], "_rank")
    q = F.broadcast(plan.withColumnRenamed("length", "_length"))
    return ranked.join(q, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("from"))
                       & (F.col("_rank") < F.col("to"))) \
        .select("doc_id", "piece", "start", "length", "ids_crc32",
                (F.col("first_sequence") + F.col("_rank") - F.col("from")).alias("sequence_id"), "offset")
