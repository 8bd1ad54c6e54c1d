"""Per-cell state that grows with new files: enrich again without reading the old observations.

The state is one row per cell: sum and count of every averaged column, and for
every first-value column its smallest order key and the value there.  Two
states merge into one by the same reduction that made them, so a run reads the
files that came since the last one, reduces them, and merges the result into
the stored state (at most ``32 ** precision`` rows).

A ledger lists the files that are in the state, by path, size and time.  State
and ledger are written into fresh folders and become valid together by one
commit marker; a run that dies before that leaves the last version as it was,
and of two runs at once one fails with ``CommitConflict``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geohash import valid_coordinates
from ..sinks.commits import CommitLog
from ..sources.files import list_files
from . import enrich as en
from .dedupe import is_fixed_width, reduce_rows


def partial_cells(observations: DataFrame, precision: int, order_key: str, avg_columns: list[str], first_columns: list[str]) -> DataFrame:
    """Observations -> mergeable state, one row per cell."""
    if not is_fixed_width(observations.schema[order_key].dataType):
        raise ValueError(f"a mergeable state needs a fixed-width unique order key, {order_key} is none")
    source = observations
    if en._cell_from_coordinates(observations, precision):
        source = observations.where(valid_coordinates("lat", "lng"))
    rows = en.add_cell(source, precision).where(F.col(en.CELL).isNotNull())
    order = F.col(order_key)
    more = {f"{c}__sum": F.sum(F.col(c).cast("double")) for c in avg_columns}
    more |= {f"{c}__n": F.count(c) for c in avg_columns}
    more |= {f"{c}__order": F.min(F.when(F.col(c).isNotNull(), order)) for c in first_columns}
    return reduce_rows(rows, en.CELL, order_key, first_columns, more, null_keys=False, max_keys=32 ** precision)


def merge_cells(states: DataFrame, precision: int, avg_columns: list[str], first_columns: list[str]) -> DataFrame:
    """Rows of several states -> one state."""
    more = {f"{c}__{part}": F.sum(f"{c}__{part}") for part in ("sum", "n") for c in avg_columns}
    more |= {f"{c}__order": F.min(f"{c}__order") for c in first_columns}
    return reduce_rows(states, en.CELL, {c: f"{c}__order" for c in first_columns}, first_columns, more, null_keys=False,
                       max_keys=32 ** precision)


class CellState:
    """The state under ``root`` (shared storage) of the observations under one folder."""

    def __init__(self, spark: SparkSession, root: str, precision: int = 4, order_key: str = "event_id",
                 avg_columns=("avg_tmpr_f", "avg_tmpr_c"), first_columns=("lat", "lng", "wthr_date")):
        self.spark, self.root, self.precision, self.order_key = spark, root.rstrip("/"), precision, order_key
        self.averages, self.firsts = list(avg_columns), list(first_columns)
        self.log = CommitLog(spark, self.root)
        entries = self.log.entries()
        found = [content for _, content in entries if content]
        self.version = entries[-1][0] if entries else 0
        self.content = found[-1] if found else None
        if self.content and self.content["settings"] != self._settings():
            raise ValueError(f"the state at {self.root} was made with {self.content['settings']}")

    def _settings(self) -> dict:
        return {"precision": self.precision, "order_key": self.order_key, "averages": self.averages, "firsts": self.firsts}

    def ledger(self) -> DataFrame | None:
        """Files that are in the state, or None before the first run."""
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in self.content["ledger"]]) if self.content else None

    def state(self) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.root}/{self.content['state']}") if self.content else None

    def new_files(self, path: str) -> DataFrame:
        """Files under ``path`` that are not in the state yet."""
        files, ledger = list_files(self.spark, path), self.ledger()
        return files if ledger is None else files.join(ledger, ["path", "length", "modified"], "left_anti")

    def delta(self, path: str, files: list[str]) -> DataFrame:
        """The observations in ``files`` under ``path`` (partition directories become columns)."""
        schema = self.spark.read.parquet(path).schema
        return self.spark.read.schema(schema).option("basePath", path).parquet(*files)

    def advance(self, path: str) -> int:
        """Take the files that came to ``path`` since the last run into the state; returns how many.

        A file of the ledger that is gone or has changed stops the run: what
        it added cannot be taken out of sums and minima, so the state has to
        be built again under another root.
        """
        if self.content:
            lost = self.ledger().join(list_files(self.spark, path), ["path", "length", "modified"], "left_anti")
            if gone := lost.select("path").take(1):
                raise ValueError(f"{gone[0][0]} is in the state, but gone or changed; build the state again")
        new = self.new_files(path).select("path", "length", "modified").collect()  # the reader takes its files from the driver anyway
        files = [r["path"] for r in new]
        if not files:
            return 0
        run = uuid.uuid4().hex[:12]
        state = partial_cells(self.delta(path, files), self.precision, self.order_key, self.averages, self.firsts)
        if self.content:
            state = merge_cells(self.state().unionByName(state), self.precision, self.averages, self.firsts)
        state.write.parquet(f"{self.root}/state-{run}")
        self.spark.createDataFrame(new, "path string, length long, modified timestamp").write.parquet(f"{self.root}/ledger-{run}")
        content = {"state": f"state-{run}", "ledger": [*(self.content or {"ledger": []})["ledger"], f"ledger-{run}"],
                   "settings": self._settings()}
        self.log.commit(self.version + 1, content)
        self.version, self.content = self.version + 1, content
        return len(files)

    def reduced(self, prefix: str = "weather_") -> DataFrame:
        """One row per cell, as :func:`geoweave.operators.enrich.reduce_observations` gives it with ``mode="avg"``."""
        if self.content is None:
            raise ValueError(f"the state at {self.root} is empty")
        means = [F.try_divide(F.col(f"{c}__sum"), F.col(f"{c}__n")).alias(f"{prefix}{c}") for c in self.averages]
        return self.state().select(en.CELL, *[F.col(c).alias(f"{prefix}{c}") for c in self.firsts], *means)
