"""From raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoweave.llm import language, minhash, packing, quality
from geoweave.llm.common import fresh, small_batches, staged, table

#: A cosine of unrelated profiles is within a few times 1 / sqrt(dims) = 0.03 of 0.
LEAST_COSINE = 0.1
#: A text of fewer distinct trigrams can be that far from its own language (on sf0.1 down to 0.07 below 32 trigrams,
#: 0.16 up to 47, 0.20 from 48), so its cosine rejects nothing.
ENOUGH_GRAMS = 48
#: As in the quality query.
LEAST_QUALITY = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, and texts of ENOUGH_GRAMS or more trigrams unlike any learned language."""
    small_batches(spark)
    profiles = language.train(docs, held_out_fold=None)
    lang, cos, grams = (fresh(docs.columns, name) for name in ("lang_pred", "score", "n_grams"))
    judged = language.predict(docs, profiles, out=(lang, cos, grams), keep_text=True)
    like = (F.col(cos) >= LEAST_COSINE) | (F.col(grams) < ENOUGH_GRAMS)
    return judged.where((F.col(lang) != language.UNKNOWN) & like).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that the classifier scores below LEAST_QUALITY, and texts without words."""
    small_batches(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), held_out_fold=None)
    score = fresh(docs.columns, "score")
    judged = quality.score(docs, model, out=score, keep_text=True)
    return judged.where((F.col(score) >= LEAST_QUALITY) & F.col("text").rlike(r"\S")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every near-duplicate group (five-word shingles, similarity 0.8).

    Rows are told apart by doc_id and text: of rows that share a doc_id only
    those go that are copies of another document or of each other.  Rows
    without a doc_id all stay.
    """
    small_batches(spark)
    near = minhash.near_duplicates(docs, text_key=True).where("kept and doc_id is not null")
    key, nth = fresh(docs.columns, "text_key"), fresh(docs.columns, "nth")
    kept = near.select("doc_id", F.col("text_key").alias(key)).distinct()
    first = Window.partitionBy("doc_id", key).orderBy("text")
    return (docs.withColumn(key, F.xxhash64("text")).join(kept, ["doc_id", key], "semi")
            .withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1)
            .select(*docs.columns).unionByName(docs.where("doc_id is null")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-two-fit packing into sequences of 1024 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", known_language), ("quality classifier", good_quality),
          ("MinHash near-dedup", one_of_each_group), ("best-fit packing", packed)]

#: No stage can be put in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
