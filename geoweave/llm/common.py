"""Helpers shared by the operators: tables, staged results, gapless numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoweave.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Have this session hand rows to Python in Arrow batches of at most ``rows`` rows.

    Batches are counted in rows; a thousand documents of a usual length are a
    few megabytes, so two tasks with their workers stay far below an
    executor's memory.  A setting of the application, not of an operator.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor, and lets several
    consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (null ids: fold of the empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def numbered(df: DataFrame, group: str, order: list[str], out: str, rows_per_bucket: int = 100_000) -> DataFrame:
    """Number the rows of each ``group`` gaplessly from 0 in column ``out``.

    A group may hold any share of the rows, so no task sees a whole one: rows
    are hashed on ``order`` into buckets, numbered inside a bucket, and
    shifted by the counts of the group's earlier buckets.  ``df`` is read
    twice and must be deterministic (pass a staged table).
    """
    total = df.count()
    n = max(1, -(-total // rows_per_bucket))
    b = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    counts = b.groupBy(F.col(group).alias("_g"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_n"))
    before = counts.select("_g", "_b", (F.sum("_n").over(
        Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    w = Window.partitionBy(group, "_bucket").orderBy(*order)
    ranked = b.withColumn("_nth", F.row_number().over(w) - 1)
    return (ranked.join(before, ranked[group].eqNullSafe(before["_g"]) & (ranked["_bucket"] == before["_b"]), "left")
            .withColumn(out, (F.col("_nth") + F.coalesce("_before", F.lit(0))).cast("long"))
            .drop("_bucket", "_nth", "_g", "_b", "_before"))


def text_first(docs: DataFrame, text_col: str, keep_text: bool):
    """``docs`` with its text (as string) in front, and the fields an Arrow pass returns."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    d = docs.select(F.col(f"`{text_col}`").cast("string").alias(text_col), *rest)
    return d, d.schema.fields if keep_text else d.schema.fields[1:]


def without(docs: DataFrame, text_col: str, *out: str) -> DataFrame:
    """``docs`` without the columns that an operator is about to write (compared case-insensitively)."""
    low = {name.lower() for name in out}
    if text_col.lower() in low:
        raise ValueError(f"the text column {text_col} cannot be an output")
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in low])


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores put in front until no column has it (case-insensitively)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name
