"""BPE encoding and decoding over a distinct-word table.

A word is a run of text without ASCII white space; the tokenizers this serves
never make a token across white space, so the ids of a text are the ids of its
words in order.

1. Texts are cut into words and gathered into blocks of bounded size.  A block
   keeps its own distinct words, and its documents as word numbers in order of
   position.
2. The words of all blocks meet in one exchange, partitioned and sorted by
   word: every distinct word is one run there and is encoded once, and its ids
   are sent back to the blocks that hold it.
3. A block joins the ids to its positions.

What moves is the distinct words of each block, their ids, and the positions,
not one row per word of the corpus.  Blocks are named by a hash of what they
hold, so a block recomputed after a lost executor gets the same name; a block
whose ids do not all arrive stops the job.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Texts that must keep their case: characters that lower-casing and composing may treat in another
#: order, and what could be an added token.
_KEEP_CASE = "[^\\x{00}-\\x{2ff}]|<\\|"


def _as_large(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.large_string()), "")


#: Texts are cut into words so many bytes at a time.
_PIECE_BYTES = 2 << 20


class _Blocks:
    """Blocks of documents: (name, doc ids, words per document, word numbers, distinct words)."""

    def __init__(self, block_bytes: int, fold_case: bool):
        self.block_bytes, self.fold_case = block_bytes, fold_case

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Words per text, word numbers and distinct words of a few texts (an array that is no slice)."""
        if self.fold_case:
            texts = pc.if_else(pc.match_substring_regex(texts, _KEEP_CASE), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)
        # leading or trailing white space leaves empty words: they encode to nothing
        lens = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype("<u4")
        coded = pc.dictionary_encode(split.flatten())
        return lens, coded.indices.to_numpy(zero_copy_only=False).astype("<u4"), coded.dictionary

    @staticmethod
    def _joined(parts: list):
        """One block from its parts: their words are numbered again, together."""
        ids = [i for part in parts for i in part[0]]
        lens = np.concatenate([part[1] for part in parts])
        coded = pc.dictionary_encode(pa.concat_arrays([part[3] for part in parts]))
        new = coded.indices.to_numpy(zero_copy_only=False).astype("<u4")
        first = np.cumsum([0, *(len(part[3]) for part in parts)])
        codes = np.concatenate([new[at:at + len(part[3])][part[2]] for at, part in zip(first, parts)])
        # frequent words get small numbers, which pack better
        order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
        words, rank = coded.dictionary.take(pa.array(order)), np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order))
        codes = rank[codes]
        name = xxhash.xxh64(repr(ids).encode())
        for x in (*(b for b in words.buffers() if b is not None), codes):
            name.update(x)
        return name.intdigest() - (1 << 63), ids, lens, codes, words

    def __call__(self, batches: Iterator[pa.RecordBatch]):
        parts, size = [], 0
        for batch in batches:
            column = _as_large(batch.column(1))
            at, sizes = 0, np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
            while at < len(column):
                before = sizes[at - 1] if at else 0
                room = min(_PIECE_BYTES, self.block_bytes - size)
                end = min(len(column), int(np.searchsorted(sizes, before + room)) + 1)
                parts.append((batch.column(0).slice(at, end - at).to_pylist(), *self._split(column.take(pa.array(range(at, end))))))  # copied: lower-casing a slice misplaces its offsets
                size += int(sizes[end - 1] - before)
                at = end
                if size >= self.block_bytes:
                    yield self._joined(parts)
                    parts, size = [], 0
                    pa.default_memory_pool().release_unused()
        if parts:
            yield self._joined(parts)


def _words(blocks: _Blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, _, _, words in blocks(batches):
            for at in range(0, len(words), 20_000):
                part = words.take(pa.array(range(at, min(len(words), at + 20_000))))
                yield pa.RecordBatch.from_arrays(
                    [part.cast(pa.string()), pa.array(np.full(len(part), name)),
                     pa.array(np.arange(at, at + len(part), dtype=np.int32))], names=["word", "block", "code"])
    return run


#: What blocks are put together from: part 0 rows bring ids of words (codes, id counts, ids), later parts
#: documents (word numbers, words per document).
_PARTS = "block long, part int, n_words long, doc_ids array<long>, codes binary, counts binary, ids binary"
_PART_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())


def _part_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_PART_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _PART_TYPES)],
                                      names=[f.split()[0] for f in _PARTS.split(", ")])


def _positions(blocks: _Blocks, docs: int = 500):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, lens, codes, words in blocks(batches):
            ends = np.cumsum(lens, dtype=np.int64)
            for part, at in enumerate(range(0, len(ids), docs), 1):
                to = min(len(ids), at + docs)
                own = codes[int(ends[at - 1]) if at else 0:int(ends[to - 1])]
                yield _part_rows([(name, part, len(words), ids[at:to], _packed(own), _packed(lens[at:to]), None)])
    return run


def _packed(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    return zlib.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 6)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _encode_words(path: str):
    """Rows (word, block, code) sorted by word -> per run of rows and block: codes, id counts, ids.

    A distinct word is encoded once; the last word of a run of rows is
    remembered for its continuation in the next.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads of their own cost memory
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_padding()
        tok.no_truncation()
        last, last_ids = None, None
        for batch in _runs(batches, 4_000):
            coded = pc.dictionary_encode(batch.column(0))
            words = coded.dictionary.to_pylist()
            skip = int(words[0] == last)
            ids = ([last_ids] if skip else []) + [
                np.array(e.ids, "<u4") for e in tok.encode_batch(words[skip:], add_special_tokens=False)]
            last, last_ids = words[-1], ids[-1]
            n = np.array([len(x) for x in ids], np.int64)
            which = coded.indices.to_numpy(zero_copy_only=False)
            blocks = batch.column(1).to_numpy(zero_copy_only=False)
            codes = batch.column(2).to_numpy(zero_copy_only=False)
            order = np.argsort(blocks, kind="stable")
            edges = np.flatnonzero(np.diff(blocks[order], prepend=blocks[order[0]] - 1))
            yield _part_rows([(int(blocks[at[0]]), 0, None, None, _packed(codes[at]), _packed(n[which[at]]),
                               _packed(np.concatenate([ids[k] for k in which[at]]))) for at in np.split(order, edges[1:])])
    return run


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows`` (but for the last)."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The concatenation of ``range(s, s + n)``."""
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)


class _Words:
    """Encoded words of one block, gathered from its part 0 rows."""

    def __init__(self):
        self.parts, self.n = ([], [], []), None

    def add(self, *packed: bytes) -> None:
        for part, x in zip(self.parts, packed):
            part.append(_unpacked(x))

    def settle(self, n_words: int) -> None:
        codes, counts, ids = (np.concatenate(x) if x else np.empty(0, "<u4") for x in self.parts)
        order = np.argsort(codes, kind="stable")
        order = order[np.diff(codes[order].astype(np.int64), prepend=-1) != 0]  # equal blocks send their words twice
        if len(order) != n_words:
            raise RuntimeError(f"a block of {n_words} words got the ids of {len(order)}; is the input deterministic?")
        self.lens = counts[order].astype(np.int64)
        self.starts = (np.cumsum(counts.astype(np.int64)) - counts)[order]
        self.ids, self.parts, self.n = ids, ([], [], []), n_words

    def of(self, codes: np.ndarray) -> np.ndarray:
        return self.ids[_ranges(self.starts[codes], self.lens[codes])].astype(np.int32)


def _join_back(pieces_of_ids):
    """Rows sorted by (block, part) -> ids of the block's documents, from its words and their positions.

    With a broadcast id-to-piece table the decoded texts are joined on as
    well.  A block's encoded words are held, its documents stream by.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = None if pieces_of_ids is None else _by_id(pieces_of_ids.value)
        block, words = None, _Words()
        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for k, (name, part) in enumerate(zip(columns[0].to_pylist(), columns[1].to_pylist())):
                if name != block:
                    block, words = name, _Words()
                if part == 0:
                    words.add(*(c[k].as_py() for c in columns[4:]))
                    continue
                if words.n is None:
                    words.settle(columns[2][k].as_py())
                codes, at, lists, ids = _unpacked(columns[4][k].as_py()), 0, [], columns[3][k].as_py()
                for n in _unpacked(columns[5][k].as_py()).tolist():
                    lists.append(words.of(codes[at:at + n]))
                    at += n
                for at in range(0, len(ids), 100):
                    yield _id_batch(ids[at:at + 100], lists[at:at + 100], by_id)
    return run


def _by_id(table: dict[int, str]) -> np.ndarray:
    out = np.full(max(table, default=0) + 1, None, object)
    out[list(table)] = list(table.values())
    return out


def _id_batch(doc_ids: list, lists: list[np.ndarray], by_id: np.ndarray | None) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    values = np.concatenate(lists) if lists else np.empty(0, np.int32)
    columns = [pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))]
    if by_id is not None:
        columns.append(pa.array([" ".join(by_id[x].tolist()) for x in lists], pa.string()))
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][:len(columns)])


def _folds_case(path: str) -> bool:
    with open(path, encoding="utf-8") as f:
        n = json.load(f)["normalizer"]
    return n is not None and any(x["type"] == "Lowercase" for x in n.get("normalizers", [n]))


def check_tokenizer(path: str) -> None:
    """The words of a text must be encoded independently: white space is dropped by the pre-tokenizer."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    a, b = (tok.encode(x, add_special_tokens=False).ids for x in ("a b\nc", "a"))
    if a[:len(b)] != b or tok.encode(" \t\n", add_special_tokens=False).ids:
        raise ValueError("this tokenizer gives ids to white space; its texts can't be encoded word by word")


def encode(docs: DataFrame, tokenizer_path: str, block_bytes: int = 32 << 20, id_col: str = "doc_id",
           text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(doc_id, ids array<int>)`` per row of ``docs``: the ids of its whole text.

    With ``decoded`` also a column of that name: the ids decoded again (see
    :func:`decode`), joined on where the ids are put together.

    As ``Tokenizer.encode(text, add_special_tokens=False)`` without truncation
    and padding; added tokens written in a text are recognised.  The tokenizer
    must drop white space.  Null and blank texts have no ids.  Rows with equal
    or null ids are encoded as often as they occur; an empty table gives no
    rows.  Other columns are ignored.  ``docs`` is read twice and must give
    the same rows in the same order within a partition (a file scan does).
    """
    check_tokenizer(tokenizer_path)
    blocks = _Blocks(block_bytes, _folds_case(tokenizer_path))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    words = d.mapInArrow(_words(blocks), "word string, block long, code int")
    packs = words.repartition("word").sortWithinPartitions("word").mapInArrow(_encode_words(tokenizer_path), _PARTS)
    table = _shared_pieces(d.sparkSession, tokenizer_path) if decoded else None
    return d.mapInArrow(_positions(blocks), _PARTS).unionAll(packs) \
        .repartition("block").sortWithinPartitions("block", "part") \
        .mapInArrow(_join_back(table), "doc_id long, ids array<int>" + ", decoded string" * decoded)


def pieces(spark, tokenizer_path: str) -> DataFrame:
    """The id-to-piece table ``(id, piece)`` of a vocabulary, added tokens included."""
    from tokenizers import Tokenizer
    vocab = Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame(sorted((i, p) for p, i in vocab.items()), "id int, piece string")


def _shared_pieces(spark, tokenizer_path: str):
    """The id-to-piece table as a broadcast; its size is that of the vocabulary."""
    with open(tokenizer_path, encoding="utf-8") as f:
        if json.load(f).get("decoder") is not None:
            raise ValueError("only tokenizers without a decoder of their own are supported")
    return spark.sparkContext.broadcast({r["id"]: r["piece"] for r in pieces(spark, tokenizer_path).collect()})


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` plus ``out``: the pieces of its ids joined by one space.

    As ``Tokenizer.decode(ids, skip_special_tokens=False)`` of a tokenizer
    without a decoder.  The id-to-piece table is as large as the vocabulary,
    whatever the corpus, so every task joins it map-side by id.  Null id lists
    decode to null, empty ones to the empty text.
    """
    shared = _shared_pieces(encoded.sparkSession, tokenizer_path)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = _by_id(shared.value)
        for batch in batches:
            column = batch.column(at)
            flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
            texts, start = [], 0
            for end, known in zip(ends.tolist(), column.is_valid().to_pylist()):
                texts.append(" ".join(by_id[flat[start:end]].tolist()) if known else None)
                start = end
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, out])
    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(out, StringType())]))
