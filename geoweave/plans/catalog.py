"""Catalog work: external tables, describe, show create, drop, schema listing.

Spark makes every table created with a path EXTERNAL, so dropping it
leaves the files; there is no switch from managed to external afterwards
(Spark refuses the ``EXTERNAL`` table property), so tables that share a
location are created external from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.files import CTRL_A


def create_external_table(spark: SparkSession, name: str, path: str, schema: StructType,
                          fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """``CREATE EXTERNAL TABLE name (...) LOCATION path``; returns the table."""
    spark.catalog.createTable(name, path=path, source=fmt, schema=schema, **(options or {}))
    return spark.table(name)


def create_delimited_table(spark: SparkSession, name: str, path: str, schema: StructType,
                           sep: str = CTRL_A, null_value: str = "null") -> DataFrame:
    """External text table with a custom separator (the ``\\u0001`` tables)."""
    return create_external_table(spark, name, path, schema, "csv",
                                 {"sep": sep, "quote": "", "escape": "", "nullValue": null_value,
                                  "header": "false"})


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE TABLE EXTENDED``: columns, then location, provider, type, ..."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def show_create(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW CREATE TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table; for an external table the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows (column, data_type, nullable), like ``printSchema``."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, data_type string, nullable boolean")
