"""Sinks: partitioned writes, verified round trips, bucketed and partition-inserted tables."""

from __future__ import annotations

import re
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .commits import swap_in


def checksum(columns: list[str]) -> Column:
    """Order-free content checksum: sum of per-row xxhash64 (as decimal, no overflow)."""
    return F.sum(F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)"))


def write_partitioned(df: DataFrame, path: str, partition_cols=("country",), mode: str = "overwrite",
                      fmt: str = "parquet", compression: str = "snappy", dynamic_overwrite: bool = False,
                      max_records_per_file: int | None = None, rebalance: bool = True,
                      observe: tuple[Observation, list[Column]] | None = None) -> None:
    """Write ``df`` as Hive-style partition directories.

    ``rebalance=True`` (an AQE-aware repartition on the partition columns)
    keeps each directory to a few files and splits a partition value that
    holds a large share of the rows across several tasks instead of one; it
    costs one shuffle of the output.  ``rebalance=False`` writes without a
    shuffle, sorting each task's rows by the partition columns (one open file
    per task at a time, but up to tasks x partitions files).
    ``overwrite`` replaces the whole output; with ``dynamic_overwrite`` only
    the partitions being written (for partial reruns).  ``observe`` collects
    metrics of the rows directly below the write, after the shuffle, so tasks
    that are run again are not counted twice.
    """
    cols = list(partition_cols)
    if rebalance:
        out = df.hint("rebalance", *cols) if cols else df.hint("rebalance")
    else:
        out = df.sortWithinPartitions(*cols) if cols else df
    if observe:
        out = out.observe(observe[0], *observe[1])
    w = out.write.mode(mode).format(fmt).option("compression", compression)
    if dynamic_overwrite and mode == "overwrite" and cols:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)


def append_run(df: DataFrame, path: str, run_id: str, partition_cols=("country",), fmt: str = "parquet", **kw) -> None:
    """Append ``df`` as the run ``run_id``; running it again with the same id replaces what it appended before.

    The rows are written to a hidden folder beside the table and swapped in as
    the partition directory ``run=<run_id>`` when they are complete, so a
    failed run leaves the table as it was, and partition values that a rerun
    no longer has do not stay behind.  Every write to such a table has to be a
    run.  Read it with ``read_back`` (the table's own columns), or with
    Spark's reader, which adds the column ``run``.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run_id):
        raise ValueError(f"a run id has letters, digits, '.', '_' and '-': {run_id!r}")
    if "run" in df.columns:
        raise ValueError("the column name 'run' is taken by the run id")
    root = path.rstrip("/")
    staged = f"{root}/.run-{run_id}-{uuid.uuid4().hex[:12]}"
    write_partitioned(df, staged, partition_cols, "errorifexists", fmt, **kw)
    swap_in(df.sparkSession, staged, f"{root}/run={run_id}")


def read_back(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """The written table with the written types: partition values are not guessed from their text."""
    return spark.read.schema(df.schema).format(fmt).load(path).select(*df.columns)


def write_observed(df: DataFrame, path: str, partition_cols=("country",), mode: str = "overwrite",
                   fmt: str = "parquet") -> dict:
    """Write and collect (rows, checksum) of what was written in the same job."""
    obs = Observation("written")
    write_partitioned(df, path, partition_cols, mode, fmt, observe=(
        obs, [F.count(F.lit(1)).alias("rows"), checksum(df.columns).alias("checksum")]))
    return obs.get


def verify_roundtrip(spark: SparkSession, df: DataFrame, path: str, partition_cols=("country",),
                     fmt: str = "parquet") -> DataFrame:
    """Write ``df``, read it back, compare row counts and content checksums.

    One row: rows_written, rows_read, rows_match, checksum_match.
    """
    w = write_observed(df, path, partition_cols, "overwrite", fmt)
    back = read_back(spark, df, path, fmt)
    r = back.agg(F.count(F.lit(1)).alias("rows_read"), checksum(df.columns).alias("c"))
    return r.select(F.lit(w["rows"]).cast("long").alias("rows_written"), "rows_read",
                    (F.col("rows_read") == F.lit(w["rows"])).alias("rows_match"),
                    (F.coalesce(F.col("c"), F.lit(0)) == F.lit(w["checksum"] or 0)).alias("checksum_match"))


def idempotent_rerun(spark: SparkSession, df: DataFrame, path: str, partition_cols=("country",),
                     fmt: str = "parquet") -> DataFrame:
    """Overwrite the same output twice; the result must not change.

    Both writes report their row count and checksum through ``observe`` (in
    the write job itself); the final state is read back once.  One row:
    rows_first (written by run 1), rows_second (read after run 2),
    same_rows, same_checksum.
    """
    first = write_observed(df, path, partition_cols, "overwrite", fmt)
    second = write_observed(df, path, partition_cols, "overwrite", fmt)
    back = read_back(spark, df, path, fmt).agg(F.count(F.lit(1)).alias("rows_second"),
                                                checksum(df.columns).alias("c"))
    c1, c2 = first["checksum"] or 0, second["checksum"] or 0
    return back.select(F.lit(first["rows"]).cast("long").alias("rows_first"), "rows_second",
                       ((F.col("rows_second") == F.lit(first["rows"])) & F.lit(first["rows"] == second["rows"]))
                       .alias("same_rows"),
                       ((F.coalesce(F.col("c"), F.lit(0)) == F.lit(c1)) & F.lit(c1 == c2)).alias("same_checksum"))


def partition_checksums(df: DataFrame, partition_cols=("country",), by_file: bool = False) -> DataFrame:
    """Rows and order-free content checksum per partition (and, for a table read from files, per file)."""
    keys = [F.col(c) for c in partition_cols]
    if by_file:
        keys.append(F.col("_metadata.file_path").alias("file"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), checksum(df.columns).alias("checksum"))


def differing_partitions(expected: DataFrame, actual: DataFrame, partition_cols=("country",)) -> DataFrame:
    """Partitions in which two tables of the same columns differ.

    Columns: the partition columns, rows_expected, rows_actual (0 where the
    partition is missing on a side).  Each side is reduced to one row per
    partition before the join.
    """
    cols = list(partition_cols)
    a = partition_checksums(expected, cols).select(*[F.col(c).alias(f"_a{i}") for i, c in enumerate(cols)],
                                                   F.col("rows").alias("_ra"), F.col("checksum").alias("_ca"))
    b = partition_checksums(actual.select(*expected.columns), cols).select(
        *[F.col(c).alias(f"_b{i}") for i, c in enumerate(cols)], F.col("rows").alias("_rb"), F.col("checksum").alias("_cb"))
    same = reduce(and_, [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(cols))])
    keys = [F.when(F.col("_ra").isNull(), F.col(f"_b{i}")).otherwise(F.col(f"_a{i}")).alias(c) for i, c in enumerate(cols)]
    return (a.join(b, same, "full_outer").where(~(F.col("_ra").eqNullSafe(F.col("_rb")) & F.col("_ca").eqNullSafe(F.col("_cb"))))
            .select(*keys, F.coalesce("_ra", F.lit(0)).alias("rows_expected"), F.coalesce("_rb", F.lit(0)).alias("rows_actual")))


def differing_files(spark: SparkSession, expected: DataFrame, path: str, partition_cols=("country",), fmt: str = "parquet") -> DataFrame:
    """Files of the differing partitions of a written table, with their rows and checksums: where to look."""
    actual = spark.read.schema(expected.schema).format(fmt).load(path)
    wrong = differing_partitions(expected, read_back(spark, expected, path, fmt), partition_cols)
    files = partition_checksums(actual, partition_cols, by_file=True)
    same = reduce(and_, [files[c].eqNullSafe(wrong[c]) for c in partition_cols])
    return files.join(wrong, same, "left_semi")


def partition_inventory(spark: SparkSession, path: str, partition_col: str = "country",
                        fmt: str = "parquet") -> DataFrame:
    """Rows and data files per partition directory, from the files' metadata column."""
    df = spark.read.format(fmt).load(path)
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows"),
                                         F.countDistinct(F.col("_metadata.file_path")).alias("files"))


def input_lineage(df: DataFrame, partition_col: str = "country") -> DataFrame:
    """Which files and partitions a (filtered) file-source query actually reads.

    Unlike ``inputFiles()`` this honours partition pruning: only files of
    the partitions that survive the filter appear.  Columns: partition
    value, files, rows.
    """
    path = F.col("_metadata.file_path")
    if partition_col in df.columns:  # the value Spark itself read from the directory name
        part = F.col(partition_col)
    else:  # parse the path: undo the URI encoding, then the directory-name escaping
        raw = F.regexp_extract(path, f"{re.escape(partition_col)}=([^/]*)", 1)
        part = raw
        for _ in range(2):  # protect '+', which url_decode would read as a space
            part = F.url_decode(F.regexp_replace(part, r"\+", "%2B"))
    return (df.select(path.alias("file_path"), part.alias(partition_col))
            .groupBy(partition_col).agg(F.countDistinct("file_path").alias("files"),
                                        F.count(F.lit(1)).alias("rows")))


def save_bucketed(df: DataFrame, table: str, path: str, bucket_col: str | list[str] = "id", buckets: int = 5,
                  fmt: str = "orc", mode: str = "overwrite", max_records_per_file: int | None = None) -> None:
    """Catalog table bucketed (and sorted) on ``bucket_col``; external at ``path``.

    Joins and aggregations on the bucket column between tables with the
    same bucketing skip the shuffle.  Rows are dealt to their buckets first
    (the same hash), so every bucket is one file and not one per task;
    ``max_records_per_file`` splits the file of a hot bucket, and a second
    bucket column (a salt) the task that writes it.
    """
    cols = [bucket_col] if isinstance(bucket_col, str) else bucket_col
    w = df.repartition(buckets, *cols).write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    (w.mode(mode).format(fmt).bucketBy(buckets, *cols).sortBy(*cols)
     .option("path", path).saveAsTable(table))


def insert_dynamic_partitions(df: DataFrame, path: str, partition_col: str = "country",
                              fmt: str = "parquet", limit: int | None = None,
                              order_by: list[str] | None = None, run_id: str | None = None) -> None:
    """``INSERT INTO t PARTITION (col) SELECT ...``: partition values come from the data.

    Appends new files into the partition directories.  ``limit`` (with a
    total ``order_by`` so it is deterministic) mirrors an insert of a sample.
    With ``run_id`` the insert can be run again (see :func:`append_run`).
    """
    src = df
    if limit is not None:
        src = src.orderBy(*(order_by or df.columns)).limit(limit)
    if run_id is not None:
        append_run(src, path, run_id, (partition_col,), fmt)
    else:
        write_partitioned(src, path, (partition_col,), mode="append", fmt=fmt)
