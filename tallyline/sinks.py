"""Where the jobs keep their tables.

A *store* is one folder. A run counts only once its one-row marker in ``published`` is written, which
happens last; a run that dies before can be repeated and overwrites its own files only. Three kinds of
tables, none written over a path that is being read:

* **appended** ones are folders partitioned by run (``tables/<name>/run_id=<run>``). Rows of runs that were
  never published are left out when they are read.
* **snapshots** (``runs/<run>/<name>``): the marker carries which run wrote the current one of each table.
* the **staging table**, partitioned by staging table and file: each such partition is published on its
  own, by the run that wrote it last, so an upload writes the rows of its own file only.

Bills and quotes come in two parts: what is still open is a snapshot, what is closed is appended. A run
therefore writes the open ones and what it closed, however many closed ones there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas
from tallyline.operators.allocation import OPEN

# Who wrote a staging partition.
STAGE_PART = T.StructType(
    [
        T.StructField("stageTable", T.StringType()),
        T.StructField("FileName", T.StringType()),
        T.StructField("run_id", T.StringType(), False),
    ]
)
MARKER = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("published_at", T.TimestampNTZType(), False),
        T.StructField("heads", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("stage", T.ArrayType(STAGE_PART), False),
    ]
)

# Tables in two parts, with the column that tells them.
STATUS = {"billing": "status_billing", "billing_others": "status_billing", "quote_billing": "status"}


def is_open(table: str) -> Column:
    return F.coalesce(F.col(STATUS[table]).isin(*OPEN), F.lit(False))


def append_stage(rows: DataFrame, path: str) -> None:
    """Staged rows into a table by file name. Loading a file again replaces just its own rows."""
    rows = schemas.as_staging(rows).where(F.col("FileName").isNotNull())
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("FileName").parquet(path)


@dataclass
class Store:
    spark: SparkSession
    folder: str
    _latest: T.Row | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.folder.rstrip("/"), *parts])

    # --- markers -------------------------------------------------------------------------

    def markers(self) -> DataFrame:
        """One row per published run."""
        try:
            return self.spark.read.schema(MARKER).parquet(self.path("published", "*"))
        except AnalysisException:  # nothing published yet
            return self.spark.createDataFrame([], MARKER)

    def latest(self) -> T.Row | None:
        """The marker of the last published run; it knows the current parts of all tables."""
        if self._latest is None:
            self._latest = self.markers().orderBy(F.desc("seq")).first()
        return self._latest

    def refresh(self) -> None:
        """Look at the markers again; a job does so when it starts."""
        self._latest = None

    def is_published(self, run_id: str) -> bool:
        return not self.markers().where(F.col("run_id") == run_id).isEmpty()

    def publish(
        self, run_id: str, snapshots: Sequence[str], at: datetime, stage: Sequence[tuple] | None = None
    ) -> None:
        """Make a finished run visible, as the latest one. ``snapshots`` are the tables it wrote anew, ``stage``
        the staging partitions (table, file, run) from now on, if they changed. Runs of a store publish one
        after another."""
        before = self.latest()
        heads = (dict(before.heads) if before else {}) | {name: run_id for name in snapshots}
        parts = [tuple(part) for part in before.stage] if before and stage is None else list(stage or [])
        marker = self.spark.createDataFrame([(before.seq + 1 if before else 1, run_id, at, heads, parts)], MARKER)
        marker.coalesce(1).write.mode("overwrite").parquet(self.path("published", f"run={run_id}"))
        self.refresh()

    # --- snapshots -----------------------------------------------------------------------

    def _write(self, rows: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)

    def write(self, run_id: str, table: str, rows: DataFrame) -> DataFrame:
        """Write a snapshot and read it back."""
        return self._write(rows, self.path("runs", run_id, table))

    def write_all(self, run_id: str, tables: dict[str, DataFrame], appended: bool = False, at_once: int = 4) -> dict[str, DataFrame]:
        """Write independent tables of a run side by side, so that small ones do not queue."""
        write = self.append if appended else self.write
        with ThreadPoolExecutor(at_once) as pool:
            return dict(zip(tables, pool.map(lambda name: write(run_id, name, tables[name]), tables)))

    def _snapshot(self, table: str) -> DataFrame:
        latest = self.latest()
        run_id = latest.heads.get(table) if latest else None
        return self.spark.read.parquet(self.path("runs", run_id, table) if run_id else self.path("base", table))

    def open_part(self, table: str) -> DataFrame:
        """The rows of a two-part table that may still change."""
        return self._snapshot(f"{table}_open")

    def current(self, table: str) -> DataFrame:
        """A table as the last published run left it."""
        if table not in STATUS:
            return self._snapshot(table)
        closed = self.spark.read.parquet(self.path("base", f"{table}_closed"))
        parts = [self.open_part(table), closed]
        if self.has_appended(f"{table}_closed"):
            parts.append(self.appended(f"{table}_closed").drop("run_id"))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def put_base(self, table: str, rows: DataFrame) -> None:
        """Initial content of a table."""
        parts = {table: rows}
        if table in STATUS:
            parts = {f"{table}_open": rows.where(is_open(table)), f"{table}_closed": rows.where(~is_open(table))}
        for name, part in parts.items():
            part.write.mode("overwrite").parquet(self.path("base", name))

    # --- appended tables -----------------------------------------------------------------

    def append(self, run_id: str, table: str, rows: DataFrame) -> DataFrame:
        """Write the run's rows of an appended table and read them back. ``ledger:<part>`` writes a part of the
        ledger."""
        name, _, part = table.partition(":")
        return self._write(rows, self.path("tables", name, f"run_id={run_id}", *([f"part={part}"] if part else [])))

    def has_appended(self, table: str) -> bool:
        try:
            self.spark.read.parquet(self.path("tables", table))
        except AnalysisException:
            return False
        return True

    def appended(self, table: str) -> DataFrame:
        """All rows that published runs appended to a table, with their run id; a filter on it reads only that
        run's folder."""
        path = self.path("tables", table)
        found = self.spark.read.option("mergeSchema", True).parquet(path).schema
        # folder names are texts, whatever they look like
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in ("run_id", "part") else f for f in found])
        rows = self.spark.read.schema(schema).parquet(path)
        return rows.join(self.markers().select("run_id"), "run_id", "left_semi").select(*rows.columns)

    def ledger(self) -> DataFrame:
        """The whole ledger; ``part`` says whether the approve or the reject step wrote a row."""
        return self.appended("ledger")

    # --- staging table -------------------------------------------------------------------

    def stage_parts(self) -> list[T.Row]:
        """Published staging partitions: one per staged file, so as many as control rows at most."""
        latest = self.latest()
        return list(latest.stage) if latest else []

    def write_stage(self, run_id: str, rows: DataFrame) -> DataFrame:
        """Write staging partitions of a run and read them back."""
        return self._write(rows.select(*schemas.STORED_STAGING.names), self.path("runs", run_id, "stage"), by=STAGE_KEY)

    def stage(self) -> DataFrame:
        """Staged rows of all staging tables (``stageTable``) as the last published run left them; only the
        partitions that count are read."""
        parts: dict[str, list[T.Row]] = {}
        for part in self.stage_parts():
            parts.setdefault(part.run_id, []).append(part)
        found = [self.spark.createDataFrame([], schemas.STORED_STAGING)]
        for run_id, own in parts.items():
            rows = self.spark.read.schema(schemas.STORED_STAGING).parquet(self.path("runs", run_id, "stage"))
            named = [
                F.col("stageTable").eqNullSafe(F.lit(part.stageTable)) & F.col("FileName").eqNullSafe(F.lit(part.FileName))
                for part in own
            ]
            found.append(rows.where(reduce(Column.__or__, named)).select(*schemas.STORED_STAGING.names))
        return reduce(DataFrame.unionByName, found)


STAGE_KEY = ("stageTable", "FileName")
