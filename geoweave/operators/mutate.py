"""UPDATE / DELETE / INSERT as copy-on-write over file tables.

Spark's file tables have no row-level UPDATE or DELETE.  Here a table is a
list of folders, named by a commit log.  A change writes its new rows into a
fresh, uniquely named snapshot folder and then commits a new list; folders are
never written twice, so a failed write leaves the table on its last commit and
a reader of an older version is not disturbed.  With a partition column only
the partitions that hold matching rows are rewritten; the folders of all other
partitions are carried over as they are.

A commit is one marker file per version (:mod:`geoweave.sinks.commits`).  Of
two writers that start from the same version one commits and the other fails
with :class:`CommitConflict`; nothing is lost silently.

SQL semantics: a row is changed or removed only where the predicate is
TRUE; a NULL predicate leaves the row alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sinks.commits import CommitConflict, CommitLog  # noqa: F401 (CommitConflict is part of this module's interface)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def update_where(df: DataFrame, condition: Column, assignments: dict) -> DataFrame:
    """``UPDATE t SET c = v, ... WHERE condition`` as a projection."""
    hit = _true(condition)
    sets = {c: (v if isinstance(v, Column) else F.lit(v)) for c, v in assignments.items()}
    return df.select(*[F.when(hit, sets[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                       if c in sets else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """``DELETE FROM t WHERE condition`` as a filter."""
    return df.where(~_true(condition))


class CowTable:
    """A versioned table under ``root``: ``root/snap=<id>`` folders and ``root/_commits/<version>`` markers.

    ``root`` must be on storage every executor sees (e.g. under
    ``spark.checkpoint.dir``).  ``partition_col`` lays every snapshot out in
    partition folders and limits rewrites to the partitions touched.
    ``bucket_col`` and ``buckets`` hash-partition each snapshot into that many
    sorted files.  With ``table``, a catalog table of that name follows the
    commits: snapshots are written with ``bucketBy``/``sortBy`` (a real bucket
    spec, usable for bucket joins) and the table is pointed at the snapshot
    *after* its marker is committed.  Changes are always made from the
    committed folders, and opening the table points the catalog at them again,
    so a writer that died between both steps loses nothing.  As a catalog
    table has one location, an insert into it writes a whole new snapshot.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "orc", bucket_col: str | None = None,
                 buckets: int | None = None, table: str | None = None, partition_col: str | None = None):
        if table and partition_col:
            raise ValueError("a catalog table here is bucketed, not partitioned")
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.bucket_col, self.buckets = bucket_col, buckets
        self.partition_col, self.table = partition_col, table
        self.version, self.folders, self.schema = 0, [], None
        self.log = CommitLog(spark, self.root)

    @classmethod
    def create(cls, spark: SparkSession, root: str, rows: DataFrame, **kw) -> "CowTable":
        """New table whose first snapshot is ``rows`` (``CREATE TABLE`` + first ``INSERT``)."""
        t = cls(spark, root, **kw)
        t.schema = rows.schema
        t._commit(t._write(rows))
        return t

    @classmethod
    def open(cls, spark: SparkSession, root: str, **kw) -> "CowTable":
        """Existing table at ``root``, on its latest committed version."""
        t = cls(spark, root, **kw)
        entries = t.log.entries()
        found = [content for _, content in entries if content]
        if not found:
            raise ValueError(f"table at {t.root} has no commit")
        t.version, t.folders = entries[-1][0], found[-1]["folders"]
        t.schema = StructType.fromJson(found[-1]["schema"])
        t._point()
        return t

    def _bucketed(self) -> bool:
        return bool(self.bucket_col and self.buckets)

    def _load(self, folders: list[str]) -> DataFrame:
        """Rows of some folders, with the types they were written with."""
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType([*self.schema.fields, StructField("snap", StringType())])
        return self.spark.read.schema(schema).format(self.fmt).option("basePath", self.root) \
            .load([f"{self.root}/{f}" for f in folders])

    def read(self) -> DataFrame:
        if self.version == 0:
            raise ValueError(f"table at {self.root} has no snapshot yet")
        if self.table:
            return self.spark.table(self.table)
        return self._committed()

    def _committed(self) -> DataFrame:
        return self._load(self.folders).select(*self.schema.names)

    def _write(self, df: DataFrame) -> list[str]:
        """Write ``df`` as a new snapshot; the folders that hold it, relative to ``root``."""
        name = f"snap={uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{name}"
        if self.table:
            staging = f"{self.table}__{name[5:]}"
            w = df.write.format(self.fmt).option("path", path)
            if self._bucketed():
                w = w.bucketBy(self.buckets, self.bucket_col).sortBy(self.bucket_col)
            w.saveAsTable(staging)
            if self.version == 0:
                self.spark.sql(f"CREATE TABLE {self.table} LIKE {staging} LOCATION '{path}'")
            self.spark.sql(f"DROP TABLE {staging}")  # external: the snapshot files stay
            return [name]
        if self._bucketed():
            df = df.repartition(self.buckets, self.bucket_col).sortWithinPartitions(self.bucket_col)
        w = df.write.format(self.fmt)
        if self.partition_col:
            w = w.partitionBy(self.partition_col)
        w.save(path)
        return self._folders_of(self._load([name])) if self.partition_col else [name]

    def _folder(self) -> Column:
        """Folder of a row's file relative to ``root``, as the reader takes it."""
        inside = F.regexp_extract(F.col("_metadata.file_path"), "(snap=[0-9a-f]{12}(/[^/]+)*)/[^/]+$", 1)
        return F.url_decode(F.regexp_replace(inside, r"\+", "%2B"))

    def _folders_of(self, df: DataFrame) -> list[str]:
        """Distinct folders of the rows: at most one per partition and commit."""
        return sorted(r[0] for r in df.select(self._folder().alias("f")).distinct().collect())

    def _commit(self, folders: list[str]) -> "CowTable":
        version = self.version + 1
        self.log.commit(version, {"version": version, "folders": folders, "schema": self.schema.jsonValue()})
        self.version, self.folders = version, folders
        self._point()
        return self

    def _point(self) -> None:
        """Point the catalog table at the committed snapshot."""
        if self.table and self.spark.catalog.tableExists(self.table):
            self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{self.root}/{self.folders[0]}'")
            self.spark.catalog.refreshTable(self.table)

    def insert(self, rows: DataFrame) -> "CowTable":
        """``INSERT INTO``: the new rows are a snapshot of their own (a catalog table: with the old rows)."""
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        if self.table:
            return self._commit(self._write(self._committed().unionAll(typed)))
        return self._commit([*self.folders, *self._write(typed)])

    def _rewrite(self, condition: Column, change) -> "CowTable":
        if not self.partition_col:
            return self._commit(self._write(change(self._committed())))
        own = self._load(self.folders)
        touched = self._folders_of(own.where(_true(condition)))
        if not touched:
            return self
        rows = self._load(touched).select(*self.schema.names)
        return self._commit([f for f in self.folders if f not in set(touched)] + self._write(change(rows)))

    def update(self, condition: Column, assignments: dict) -> "CowTable":
        return self._rewrite(condition, lambda df: update_where(df, condition, assignments))

    def delete(self, condition: Column) -> "CowTable":
        return self._rewrite(condition, lambda df: delete_where(df, condition))
