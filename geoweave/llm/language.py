"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector.  An n-gram is bound from the letters'
vectors, each permuted (rotated) by its place; a document bundles (adds) the
vectors of its n-grams; a language prototype bundles its training documents.
A document gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from geoweave.llm.common import fold_of, text_first, without

SPACE = 32
UNKNOWN = "und"


class Letters:
    """Which code points are letters; everything else separates words."""

    def __init__(self):
        self.table = np.zeros(0x110000, np.uint32)
        letters = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
        self.table[letters] = letters

    def grams(self, text: str | None, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams (packed, 21 bits a letter) of a whole text and their counts.

        Text is lower-cased, runs of non-letters become one space, and one
        space is put at either end; a text without letters has no n-grams.
        """
        none = np.empty(0, np.uint64), np.empty(0, np.int64)
        if not text:
            return none
        c = self.table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
        c = np.concatenate((np.zeros(1, np.uint32), c, np.zeros(1, np.uint32)))
        c = c[(c != 0) | np.concatenate(([True], c[1:] != c[:-1]))]
        if len(c) < 3:
            return none
        c = np.where(c == 0, SPACE, c).astype(np.uint64)
        m = max(1, len(c) - n + 1)
        key = np.zeros(m, np.uint64)
        for i in range(min(n, len(c))):
            key = (key << np.uint64(21)) | c[i:i + m]
        return np.unique(key, return_counts=True)


class GramVectors:
    """n-gram vectors, made on first use and kept for the life of a task up to a bounded number."""

    def __init__(self, n: int, dims: int, seed: int, keep: int = 30_000):
        self.n, self.dims, self.seed, self.keep = n, dims, seed, keep
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.matrix = np.empty((1024, dims), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dims, dtype=np.int8)
            self.letters[code] = bits * 2 - 1
        return self.letters[code]

    def bind(self, key: int) -> np.ndarray:
        v = np.ones(self.dims, np.int8)
        for place in range(self.n):
            v = v * np.roll(self.letter((key >> (21 * place)) & 0x1FFFFF), place)
        return v

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers of the given n-grams in ``matrix``."""
        if len(self.rows) + len(keys) > max(self.keep, len(keys)):
            self.rows = {}
        out = np.empty(len(keys), np.int64)
        for i, key in enumerate(keys.tolist()):
            at = self.rows.get(key)
            if at is None:
                at = self.rows[key] = len(self.rows)
                if at >= len(self.matrix):
                    self.matrix = np.concatenate([self.matrix, np.empty_like(self.matrix)])
                self.matrix[at] = self.bind(key)
            out[i] = at
        return out

    def bundle(self, keys: np.ndarray, counts: np.ndarray, block: int = 4096) -> np.ndarray:
        total = np.zeros(self.dims)
        for i in range(0, len(keys), block):
            rows = self.of(keys[i:i + block])
            total += counts[i:i + block].astype(np.float32) @ self.matrix[rows]
        return total


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # unit rows, one a language
    n: int
    dims: int
    seed: int


def _learner(n: int, dims: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, vectors = Letters(), GramVectors(n, dims, seed)
        counts: dict[str, dict[int, int]] = {}
        sums: dict[str, np.ndarray] = {}

        def fold():
            for lang, c in counts.items():
                v = vectors.bundle(np.fromiter(c, np.uint64, len(c)), np.fromiter(c.values(), np.int64, len(c)))
                sums[lang] = sums.get(lang, 0) + v
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                c = counts.setdefault(lang, {})
                for key, k in zip(*(a.tolist() for a in letters.grams(text.as_py(), n))):
                    c[key] = c.get(key, 0) + k
            if sum(map(len, counts.values())) > 200_000:
                fold()
        fold()
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dims), pa.array(range(dims), pa.int32()), pa.array(np.rint(v).astype(np.int64))],
                names=["lang", "d", "v"])
    return run


def _judge(shared, first: int, out: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Profiles = pickle.loads(shared.value)
        letters, vectors = Letters(), GramVectors(p.n, p.dims, p.seed)
        for batch in batches:
            names, scores, sizes = [], [], []
            for text in batch.column(0):
                keys, counts = letters.grams(text.as_py(), p.n)
                sizes.append(len(keys))
                if len(keys) == 0 or not p.languages:
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                v = vectors.bundle(keys, counts)
                size = float(np.sqrt(v @ v))
                cos = p.prototypes @ v / size if size else np.zeros(len(p.languages))
                best = int(np.argmax(cos))
                names.append(p.languages[best])
                scores.append(min(1.0, max(0.0, float(cos[best]))))
            judged = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[first:], *judged[:len(out)]],
                names=[*batch.schema.names[first:], *out])
    return run


def train(docs: DataFrame, n: int = 3, dims: int = 1024, seed: int = 7, held_out_fold: int | None = 2, folds: int = 4,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Bundle the prototypes from every document with a language outside the held-out fold.

    A task sends one vector per language it has seen; a label set is expected
    to be small (a few hundred languages), a bound on what reaches the driver.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       F.col(id_col).cast("long").alias("doc_id")).where("lang is not null and text is not null")
    if held_out_fold is not None:
        rows = rows.where(fold_of(F.col("doc_id"), folds) != held_out_fold)
    parts = rows.select("lang", "text").mapInArrow(_learner(n, dims, seed), "lang string, d int, v long")
    sums: dict[str, np.ndarray] = {}
    for lang, d, v in parts.groupBy("lang", "d").agg(F.sum("v").alias("v")).collect():
        sums.setdefault(lang, np.zeros(dims))[d] = v
    languages = sorted(lang for lang, v in sums.items() if v.any())
    unit = np.array([sums[x] / np.sqrt(sums[x] @ sums[x]) for x in languages]).reshape(len(languages), dims)
    return Profiles(languages, unit, n, dims, seed)


def predict(docs: DataFrame, profiles: Profiles, text_col: str = "text", out: tuple[str, ...] = ("lang_pred", "score"),
            keep_text: bool = False) -> DataFrame:
    """``docs`` (without its text unless ``keep_text``) plus the language and its cosine, cut to 0..1.

    A third name in ``out`` adds the number of distinct n-grams.

    The language is a learned one, or ``und`` with score 0 when the text is
    null or has no letter (or nothing was learned).  Equal cosines go to the
    language first in order.  Columns of ``docs`` named like those in ``out``
    (in any case) are replaced; other columns pass through.  Repeated rows are
    judged as often as they occur; an empty table gives none.
    """
    d, kept = text_first(without(docs, text_col, *out), text_col, keep_text)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(profiles))  # languages * dims doubles
    kinds = (StringType(), DoubleType(), LongType())
    schema = StructType([*kept, *(StructField(name, kind) for name, kind in zip(out, kinds))])
    return d.mapInArrow(_judge(shared, len(d.columns) - len(kept), tuple(out)), schema)
