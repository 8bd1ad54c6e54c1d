"""File sources: typed CSV, Parquet, control-A text, ORC, multi-line repair, ingest."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..session import scratch_path
from ..sinks.commits import CommitLog

CTRL_A = "\u0001"


def read_places(spark: SparkSession, path: str, schema: StructType = schemas.PLACES) -> DataFrame:
    """CSV with a header: columns are taken by name and coerced to ``schema``.

    Reordered and extra columns are fine, a missing one fails.  Values are
    read as text (no inference pass; only the header line is looked at while
    the plan is built) and a bad value becomes NULL.  All files must have the
    same header: ``enforceSchema=false`` fails on one that differs.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return cast_columns(raw, schema)


def read_csv_strings(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV read with every column as string (the serde view of a text table)."""
    return spark.read.option("header", header).option("inferSchema", False).csv(path)


def cast_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Coerce columns to ``schema`` with ``try_cast``: a bad value becomes NULL.

    Spark 4 runs with ANSI mode on, where a plain ``cast`` of a bad value
    fails the job.
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_observations(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; ``year=/month=/day=`` directories become prunable columns."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = CTRL_A,
                   null_value: str = "null", corrupt_column: str | None = None) -> DataFrame:
    """Delimited text table (Hive default ``\\u0001`` separator, literal ``null`` token).

    Quotes are not special, as in the text serde.  With ``corrupt_column``
    malformed lines are kept in that column instead of being dropped.
    """
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
    r = (spark.read.schema(schema).option("sep", sep).option("quote", "").option("escape", "")
         .option("nullValue", null_value).option("header", False).option("mode", "PERMISSIVE"))
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    return r.csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = CTRL_A, null_value: str = "null",
                    mode: str = "overwrite") -> None:
    """Write as raw delimited text: no quoting, so embedded newlines stay raw."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null_value)) for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(path)


#: Kinds of pieces of a split: a whole record, lines before its first record, its last record.
_WHOLE, _LEADING, _LAST = 0, 1, 2
_PIECES = "f string, b long, seq long, kind int, text string"


def _assemble(start: str):
    """Lines (line, file, split start) in file order -> pieces (file, split start, number, kind, text).

    A batch is cut at its record starts and the lines between two starts are
    joined by Arrow, without a loop over lines.  What is carried on is the
    unfinished record; lines before the first record go out batch by batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, seq = None, [], 0  # split, parts of the unfinished record, pieces of this split so far

        def piece(texts, kind):
            nonlocal seq
            n = len(texts)
            seq += n
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array(range(seq - n, seq), pa.int64()),
                 pa.array([kind] * n, pa.int32()), pa.array(texts, pa.string())], names=["f", "b", "seq", "kind", "text"])

        for batch in batches:
            if not len(batch):
                continue
            lines, files, blocks = batch.columns
            other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
            turns = [0, *(i + 1 for i in pc.indices_nonzero(other).to_pylist()), len(batch)]
            for lo, hi in zip(turns, turns[1:]):
                here = (files[lo].as_py(), blocks[lo].as_py())
                if here != at:
                    if held:
                        yield piece(["\n".join(held)], _LAST)
                    at, held, seq = here, [], 0
                part = lines.slice(lo, hi - lo)
                starts = pc.indices_nonzero(pc.match_substring_regex(part, start)).to_pylist()
                begins = bool(starts) and starts[0] == 0
                cuts = pa.array([*([] if begins else [0]), *starts, len(part)], pa.int32())
                texts = pc.binary_join(pa.ListArray.from_arrays(cuts, part), "\n").to_pylist()
                if not begins:  # the first lines go on with what was there before
                    first = texts.pop(0)
                    if held:
                        held.append(first)
                    else:
                        yield piece([first], _LEADING)
                if texts:
                    done = texts[:-1]
                    if held:
                        done = ["\n".join(held), *done]
                    if done:
                        yield piece(done, _WHOLE)
                    held = [texts[-1]]
        if held:
            yield piece(["\n".join(held)], _LAST)
    return run


def repair_multiline(spark: SparkSession, path: str, schema: StructType, key_pattern: str = r"\d+",
                     sep: str = CTRL_A, null_value: str = "null") -> DataFrame:
    """Re-assemble records whose text fields hold raw line breaks.

    A new record starts only at a line that begins with ``key_pattern`` (an RE2
    expression) followed by the separator; any other line continues the record
    before it.  Files are read as ordinary splittable text (``\n`` only, so a
    CR of an embedded CR/LF stays in the text), once: a task reads the lines of
    its splits in order and writes the pieces it finds to the shared folder.

    Only the ends of a split can be unfinished: the lines before its first
    record, and its last record.  These are ordered by file and split start and
    joined; every other record is read back as it is, so no text is shuffled
    but at split borders.  Lines before the first record of a file are kept as
    a record of their own; a file in which no line starts a record stops the
    job (the pattern does not fit).
    """
    sep_re = re.escape(sep)  # split() takes a regular expression
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("f"),
                     F.col("_metadata.file_block_start").alias("b")))
    staged = scratch_path(spark, "pieces")
    (lines.mapInArrow(_assemble(f"^(?:{key_pattern}){sep_re}"), _PIECES)
     .write.option("parquet.enable.dictionary", "false").parquet(staged))
    pieces = spark.read.schema(_PIECES).parquet(staged)
    whole = pieces.where(F.col("kind") == _WHOLE).select(F.col("text").alias("rec"))
    ends = pieces.where(F.col("kind") != _WHOLE)  # pushed down: row groups of whole records are not opened for their text
    so_far = Window.partitionBy("f").orderBy("b", "seq").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("nth", F.sum((F.col("kind") == _LAST).cast("int")).over(so_far)) \
        .withColumn("starts", F.sum((F.col("kind") == _LAST).cast("int")).over(Window.partitionBy("f")))
    joined = ends.groupBy("f", "nth").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "seq", "text"))), lambda x: x["text"]), "\n").alias("rec"),
        F.min("starts").alias("starts"))
    joined = joined.select(F.when(F.col("starts") == 0, F.raise_error(F.concat(
        F.lit("no line starts a record (key pattern and separator do not fit): "), F.col("f"))).cast("string"))
        .otherwise(F.col("rec")).alias("rec"))
    records = whole.unionAll(joined)

    parts = F.split(F.col("rec"), sep_re, len(schema.fields))
    cols = []
    for i, f in enumerate(schema.fields):
        v = F.get(parts, i)  # a short (malformed) record gives NULLs, as PERMISSIVE parsing would
        v = F.when(v == F.lit(null_value), F.lit(None)).otherwise(v)
        cols.append(v.try_cast(f.dataType).alias(f.name))
    return records.select(*cols)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def ingest_files(spark: SparkSession, src: str, table_path: str, fmt: str = "parquet",
                 schema: StructType | None = None) -> DataFrame:
    """Append the files under ``src`` to the table at ``table_path``.

    The replacement for ``LOAD DATA INPATH``: the source files are read and
    appended through a normal write job (so the step is retry-safe) and are
    left where they are.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    r.load(src).write.mode("append").format(fmt).save(table_path)
    return spark.read.format(fmt).load(table_path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Data files under ``path``: path, length, modified, uri (as ``_metadata.file_path``).  Their content is not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("uri")))


def _loads(spark: SparkSession, table_path: str) -> tuple[int, list[str]]:
    entries = CommitLog(spark, table_path).entries()
    return (entries[-1][0] if entries else 0), [content["load"] for _, content in entries if content]


def manifest(spark: SparkSession, table_path: str) -> DataFrame | None:
    """Files in the table: path, length, modified, rows, checksum, load; None before the first load."""
    loads = _loads(spark, table_path)[1]
    if not loads:
        return None
    root = f"{table_path.rstrip('/')}/_manifest"
    return spark.read.option("basePath", root).parquet(*[f"{root}/load={x}" for x in loads])


def read_ingested(spark: SparkSession, table_path: str, fmt: str = "parquet") -> DataFrame:
    """Rows of the committed loads of a table filled by :func:`ingest_new`."""
    root, loads = table_path.rstrip("/"), _loads(spark, table_path)[1]
    if not loads:
        raise ValueError(f"nothing has been loaded into {table_path}")
    return spark.read.format(fmt).load([f"{root}/load={x}" for x in loads])


def ingest_new(spark: SparkSession, src: str, table_path: str, fmt: str = "parquet", schema: StructType | None = None) -> int:
    """Load the files under ``src`` that are not in the table yet; returns how many.

    A file is known by path, size and content: the checksum of its rows (an
    order-free sum of row hashes).  Files whose path, size and time are in the
    manifest are skipped without being read; of the others the checksum is
    taken, and an anti-join with the manifest leaves the new ones (a file that
    was only touched is not new; a changed one is).  Their rows are written
    into a load folder of their own, the manifest beside it, and both count
    from the commit marker on.  A load that dies earlier leaves no row in the
    table, and its rerun with the same files writes the same folder again.
    The source files stay where they are.
    """
    reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    root, known = table_path.rstrip("/"), manifest(spark, table_path)
    files = list_files(spark, src)
    if known is not None:
        files = files.join(known, ["path", "length", "modified"], "left_anti")
    paths = [r["path"] for r in files.select("path").collect()]  # the reader takes its files from the driver
    if not paths:
        return 0
    rows = reader.load(paths)
    sums = rows.groupBy(F.col("_metadata.file_path").alias("uri")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("checksum"))
    new = files.join(sums, "uri", "left").select(  # a file without rows has no sum
        "path", "length", "modified", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("checksum", F.lit(0)).cast("decimal(38,0)").alias("checksum"))
    if known is not None:
        new = new.join(known, ["path", "length", "checksum"], "left_anti").select("path", "length", "modified", "rows", "checksum")
    found = new.collect()
    if not found:
        return 0
    version = _loads(spark, table_path)[0] + 1
    key = spark.createDataFrame(found, new.schema)
    load = key.agg(F.hex(F.sum(F.xxhash64("path", "length", "checksum").cast("decimal(38,0)")).cast("string"))).first()[0]
    reader.load([r["path"] for r in found]).write.mode("overwrite").format(fmt).save(f"{root}/load={load}")
    key.write.mode("overwrite").parquet(f"{root}/_manifest/load={load}")
    CommitLog(spark, root).commit(version, {"load": load, "files": len(found), "rows": sum(r["rows"] for r in found)})
    return len(found)
