"""The registered queries of this subpackage and their SQL.

Each applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from geoweave.llm import (
    bpe, centroids, embeddings, fingerprints, htmltext, language, licenses, minhash, packing, quality, sharding, urlfilter,
    vectorcodes)
from geoweave.llm.common import fold_of, small_batches, table

#: Score from which a document counts as good.
GOOD = 0.3


def _documents(spark, sf_dir, *columns):
    small_batches(spark)
    return table(spark, sf_dir, "documents").select(*columns)


def op1_license_digests(spark, sf_dir):
    return licenses.scan(_documents(spark, sf_dir, "doc_id", "text"))


def op2_bpe_round_trip(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_best_two_fit_packing(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op4_nb_svm_quality(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    return quality.score(rows, model).withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op5_nn_descent_near_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_minimax_shards(spark, sf_dir):
    return sharding.shard_by_bytes(_documents(spark, sf_dir, "doc_id", "text"))


def op7_minhash_near_dedup(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return minhash.near_duplicates(docs, words=3, percent=85)


def op8_hyperdimensional_language(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang")
    profiles = language.train(docs)
    rows = docs.select("doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return language.predict(rows, profiles)


def op9_prefix_hash_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(_documents(spark, sf_dir, "doc_id", "text"))


def op10_boosted_html_text(spark, sf_dir):
    small_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages, htmltext.train(pages))


def op11_laesa_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_gnat_vector_codes(spark, sf_dir):
    return vectorcodes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op13_association_url_filter(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


QUERIES = {f.__name__: f for f in (
    op1_license_digests, op2_bpe_round_trip, op3_best_two_fit_packing, op4_nb_svm_quality, op5_nn_descent_near_dedup,
    op6_minimax_shards, op7_minhash_near_dedup, op8_hyperdimensional_language, op9_prefix_hash_fingerprints,
    op10_boosted_html_text, op11_laesa_centroids, op12_gnat_vector_codes, op13_association_url_filter)}

#: The other operators learn, hash or pack in ways SQL cannot express; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_license_digests": licenses.oracle(), "op11_laesa_centroids": centroids.oracle(),
    "op12_gnat_vector_codes": vectorcodes.oracle(), "op13_association_url_filter": urlfilter.oracle()}
