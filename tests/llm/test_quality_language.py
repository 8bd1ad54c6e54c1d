"""Learned operators by held-out accuracy, rules by small fixtures."""

import numpy as np
from pyspark.sql import functions as F

from geoweave.llm import language, quality
from geoweave.llm.queries import QUERIES

BIG = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    out = QUERIES["op4_nb_svm_quality"](spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id") \
        .where("held_out").collect()
    good = [r for r in out if r.quality == 1]
    bad = [r for r in out if r.quality == 0]
    assert all(0 <= r.score <= 1 for r in out)
    assert np.mean([r.predicted == 1 for r in good]) > 0.97
    assert np.mean([r.predicted == 0 for r in bad]) > 0.8
    wins = np.mean([(a.score > b.score) + 0.5 * (a.score == b.score) for a in good for b in bad])
    assert wins > 0.97


def test_quality_rules(spark, nasty, empty, sf):
    labels = spark.createDataFrame([(3, 0), (5, 1), (5, 1), (6, 0), (6, 1), (7, None), (None, 1), (9, 1)],
                                   "doc_id long, quality int")
    model = quality.train(nasty, labels, held_out_fold=None)
    d = nasty.drop("score")
    out = quality.score(d, model).collect()
    assert len(out) == d.count() and all(0 <= r.score <= 1 for r in out)
    same = {r.doc_id: r.score for r in out}
    assert same[0] == same[1] == same[2] and same[5] == same[40]
    assert quality.score(empty.drop("score"), model).collect() == []
    none = quality.train(empty, labels, held_out_fold=None)   # nothing learned: one constant score
    assert len({r.score for r in quality.score(d, none).collect()}) == 1
    assert quality.score(nasty, model, out="other", keep_text=True).columns[-1] == "other"
    # a clashing column of the input gives way to the result
    again = quality.score(nasty.withColumnRenamed("score", "Score"), model, keep_text=True)
    assert again.columns[-1] == "score" and [c.lower() for c in again.columns].count("score") == 1
    assert sorted(r.score for r in again.collect()) == sorted(r.score for r in out)


def test_quality_sample_is_drawn_from_the_documents_at_hand(spark):
    """Labels of documents that are not there take no place in the bounded sample."""
    rows = [(10_000 + i, ("good fine prose here " if i % 2 else "buy now click win ") * 5) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)] + [(i, int(i % 2)) for i, _ in rows], "doc_id long, quality int")
    model = quality.train(docs, labels, sample_rows=20, held_out_fold=None)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert min(v for i, v in got.items() if i % 2) > 0.5 > max(v for i, v in got.items() if i % 2 == 0)


def test_quality_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    rows, cost = [np.arange(4)] * 60, np.full(60, 0.5)
    w, b = quality.dual_coordinate_descent(rows, list(x), y, cost, 4, epochs=500)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + 0.5 * np.maximum(0, 1 - y * (x @ w + b)).sum()
    at = loss(w, b)
    for _ in range(300):
        step = rng.normal(size=5) * 0.02
        assert loss(w + step[:4], b + step[4]) >= at - 1e-3


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    out = QUERIES["op8_hyperdimensional_language"](spark, BIG)
    assert set(out.columns) >= {"doc_id", "held_out", "lang_pred", "score"}
    got = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.97


def test_language_rules(nasty, empty):
    p = language.train(nasty, held_out_fold=None)
    assert p.languages == ["en", "fr"]
    out = {(r.doc_id, r.text): r for r in language.predict(nasty.drop("score"), p, keep_text=True).collect()}
    for i, t in ((0, ""), (1, None), (2, " \n\t "), (3, "!!!")):
        assert (out[i, t].lang_pred, out[i, t].score) == ("und", 0.0)
    assert all(r.lang_pred in ("en", "fr") and 0 <= r.score <= 1 for k, r in out.items() if k[0] not in (0, 1, 2, 3))
    assert language.predict(empty.drop("score"), p).collect() == []
    clash = nasty.withColumnRenamed("rep", "LANG_PRED")  # clashing columns of the input give way to the result
    again = language.predict(clash, p)
    assert sorted(c.lower() for c in again.columns).count("lang_pred") == 1 and again.columns[-2:] == ["lang_pred", "score"]
    plain = language.predict(nasty.drop("score", "rep"), p)
    assert sorted((r.lang_pred, r.score) for r in again.collect()) == sorted((r.lang_pred, r.score) for r in plain.collect())
    nothing = language.train(empty, held_out_fold=None)
    assert {r.lang_pred for r in language.predict(nasty.drop("score"), nothing).collect()} == {"und"}


def test_language_vectors_bind_and_bundle():
    v = language.GramVectors(3, 512, 1)
    a, b, c = (v.letter(ord(x)).astype(int) for x in "abc")
    key = (ord("a") << 42) | (ord("b") << 21) | ord("c")
    assert (v.bind(key) == np.roll(a, 2) * np.roll(b, 1) * c).all()
    keys, counts = language.Letters().grams("abc abc", 3)
    want = sum(n * v.bind(int(k)).astype(float) for k, n in zip(keys, counts))
    assert np.allclose(v.bundle(keys, counts), want)
