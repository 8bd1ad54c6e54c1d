"""The pipeline against a brute-force version, and its stages on odd rows."""

import os
import sys

import numpy as np
import pytest
import pyarrow.parquet as pq
import xxhash

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as cp
from geoweave.llm import language, quality
from test_minhash import brute
from test_packing import check_packed


def brute_language(rows):
    letters, vectors = language.Letters(), language.GramVectors(3, 1024, 7)
    bundles = [vectors.bundle(*letters.grams(r["text"], 3)) for r in rows]
    names = sorted({r["lang"] for r in rows if r["lang"] is not None and r["text"] is not None})
    sums = [sum(b for b, r in zip(bundles, rows) if r["lang"] == n) for n in names]
    unit = np.array([s / np.linalg.norm(s) for s in sums])
    return [r for r, b in zip(rows, bundles) if b.any() and (unit @ b / np.linalg.norm(b)).max() >= cp.LEAST_COSINE]


def brute_quality(rows, labels):
    known = {r["doc_id"]: r["quality"] for r in labels}
    train = [(r["doc_id"], quality.features(r["text"])) for r in rows if r["doc_id"] in known]
    counts = np.zeros((2, quality.DIM))
    for i, x in train:
        counts[known[i], x] += 1
    train.sort(key=lambda p: xxhash.xxh64_intdigest(str(p[0])))
    model = quality.fit([x for _, x in train], np.array([known[i] for i, _ in train]),
                        quality.log_count_ratio(counts[1], counts[0]))
    return [r for r in rows if model.score(model.margin(quality.features(r["text"]))) >= cp.LEAST_QUALITY and r["text"].strip()]


def test_run_equals_brute_force(spark, sf, real_docs):
    rows = brute_language(real_docs)
    rows = brute_quality(rows, pq.read_table(f"{sf}/labels.parquet").to_pylist())
    groups = brute([(r["doc_id"], r["text"]) for r in rows], 5, 80)
    kept = [(r["doc_id"], r["text"]) for r in rows if groups[r["doc_id"]][1] == r["doc_id"]]
    assert 0 < len(kept) < len(rows) < len(real_docs)
    check_packed(kept, cp.run(spark, sf).collect())


def test_stages_keep_their_columns_and_odd_rows_do_not_crash(spark, sf, nasty, empty):
    for docs in (nasty, empty):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() <= docs.count()
        assert cp.STAGES[-1][1](spark, docs, sf).count() >= docs.count()
    left = {(r.doc_id, r.text) for r in cp.known_language(spark, nasty, sf).collect()}
    assert not left & {(0, ""), (1, None), (2, " \n\t "), (3, "!!!")} and (5, "One two three") in left


def test_short_labelled_documents_stay(spark, sf, real_docs):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in real_docs]
    short = [(-1, "Avec.", "fr"), (-2, "A.", "en"), (-3, "A.\nAll rights reserved.", "en"), (-4, "Edrere.", "es")]
    far = [(-5, "".join(chr(0x4E00 + 37 * i) for i in range(400)), None), (-6, "...", "en")]
    docs = spark.createDataFrame(rows + short + far, "doc_id long, text string, lang string")
    left = {r.doc_id for r in cp.known_language(spark, docs, sf).collect()}
    assert {-1, -2, -3, -4} <= left and not left & {-5, -6}


def test_one_document_of_each_group_stays(spark, sf, nasty):
    out = [r.doc_id for r in cp.one_of_each_group(spark, nasty, sf).collect()]
    assert out.count(5) == 1 and 40 not in out       # repeated row once, copy gone
    assert out.count(None) == 1 and {0, 1, 2} <= set(out)  # texts without words are copies of nothing


def test_reused_doc_id_loses_only_copies(spark, sf):
    x, y = ("one two three four five six seven eight " * 3, "another text that is a copy of nothing at all here")
    docs = spark.createDataFrame([(3, x, "a"), (5, x, "b"), (5, y, "c"), (5, y, "d"), (7, "short", "e"), (None, x, "f")],
                                 "doc_id long, text string, text_key string")
    out = sorted(((r.doc_id, r.text) for r in cp.one_of_each_group(spark, docs, sf).collect()), key=repr)
    assert out == sorted([(3, x), (5, y), (7, "short"), (None, x)], key=repr)
