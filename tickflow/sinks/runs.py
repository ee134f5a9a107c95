"""Keyed tables as sorted runs under a list that is switched last.

A batch writes its rows as one run: ``run=<number>/<epoch=..>``, sorted by key, and then the list of runs that make up the
table, ``versions/v=<batch>``: one row per run and epoch, in one file, which appears as a whole. Readers follow the newest
list, so a batch that dies before it has written its list has changed nothing, and a batch that runs again
starts from the list of the batch before.

The list carries what is asked most: of each run its tick range, how many keys it brought that were not
there before, and how many rows were delivered. So status is read from the list alone, and lookups open only runs
whose range can hold the key. Where the table names a ``span`` (a number that a key always has alike, such as the log id), the list
has its range too: runs that share their ticks but no span, as batches of one feed do, cannot share a key and are never compared.

* Runs are merged as they pile up: ``fan_in`` runs of one level of an epoch become one run of the next level, and all runs of an
  epoch when a newer epoch begins. A row is rewritten a logarithmic number of times, and an epoch has a bounded number of runs.
* Only the newest ``keep_epochs`` epochs stay listed; the highest epoch that left the list is kept in it as the mark at or
  below which rows are out of scope. The files of dropped epochs are left for archives until ``clean`` is told to remove them.

The list has a few rows per kept epoch; the driver reads it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickflow.operators.events import latest_by_key

_LIST = "epoch BIGINT, run BIGINT, level INT, first_tick DECIMAL(20,0), last_tick DECIMAL(20,0), events BIGINT, deliveries BIGINT, first_span DECIMAL(20,0), last_span DECIMAL(20,0)"
#: Level of a run that holds all of an epoch that was left for a newer one.
_CLOSED = 99


@dataclass(frozen=True)
class Run:
    epoch: int
    run: int
    level: int
    first_tick: int
    last_tick: int
    events: int
    deliveries: int
    #: Lowest and highest value of the table's ``span``; None: any.
    first_span: int | None = None
    last_span: int | None = None

    def meets(self, other: Run) -> bool:
        """Whether both can hold a key: they are of one epoch, and neither their ticks nor their spans lie apart."""
        if self.epoch != other.epoch or self.first_tick > other.last_tick or other.first_tick > self.last_tick:
            return False
        if None in (self.first_span, self.last_span, other.first_span, other.last_span):
            return True
        return self.first_span <= other.last_span and other.first_span <= self.last_span


@dataclass(frozen=True)
class Version:
    """What a table consists of after a batch; ``dropped`` is the highest epoch that retention has put out of scope (-1: none)."""

    batch: int = -1
    runs: tuple[Run, ...] = ()
    dropped: int = -1


@dataclass(frozen=True)
class RunTable:
    """A table in ``path`` whose rows have ``epoch``, ``tick`` and ``key``; the newest run wins."""

    spark: SparkSession
    path: str
    schema: str | StructType
    key: tuple[str, ...]
    tick: str = "tick"
    #: A column with different values everywhere, which point lookups ask for.
    lookup: str | None = None
    #: A number that rows with equal keys have alike.
    span: str | None = None
    fan_in: int = 8

    @property
    def _schema(self) -> StructType:
        return StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema

    def _jvm_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._jvm_path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ reading

    def version(self, upto: int | None = None) -> Version:
        """The newest version, or the newest one of a batch up to ``upto``."""
        try:
            rows = self.spark.read.schema(_LIST + ", v BIGINT").parquet(f"{self.path}/versions").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        rows = [r for r in rows if upto is None or r["v"] <= upto]
        if not rows:
            return Version()
        newest = max(r["v"] for r in rows)
        rows = [r for r in rows if r["v"] == newest]
        number = lambda x: None if x is None else int(x)
        runs = [
            Run(r["epoch"], r["run"], r["level"], int(r["first_tick"]), int(r["last_tick"]), r["events"], r["deliveries"], number(r["first_span"]), number(r["last_span"]))
            for r in rows
            if r["level"] >= 0
        ]
        return Version(newest, tuple(sorted(runs, key=lambda r: (r.epoch, r.run))), max(r["epoch"] for r in rows if r["level"] < 0))

    def _rows_of(self, runs: list[Run]) -> DataFrame:
        """Rows of runs as they lie there, with ``run``."""
        whole = StructType([*self._schema.fields, *StructType.fromDDL("run BIGINT").fields])
        if not runs:
            return self.spark.createDataFrame([], whole)
        folders = [f"{self.path}/run={r.run}/epoch={r.epoch}" for r in runs]
        # Partition columns come last when they are read.
        return self.spark.read.schema(whole).option("basePath", self.path).parquet(*folders).select(*whole.names)

    def _latest(self, runs: list[Run]) -> DataFrame:
        """One row per key. Where a run shares its ticks or its span with no other run of its epoch, its keys need no comparison."""
        shared = {r for r in runs for s in runs if r is not s and r.meets(s)}
        rows = self._rows_of([r for r in runs if r not in shared])
        if shared:
            rows = rows.unionByName(latest_by_key(self._rows_of([r for r in runs if r in shared]), list(self.key), "run"))
        return rows.drop("run")

    def read(self, epoch: int | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
        """All rows, or those of an epoch and tick range; other runs are not opened."""
        runs = [r for r in self.version().runs if (epoch is None or r.epoch == epoch) and (first is None or r.last_tick >= first) and (last is None or r.first_tick <= last)]
        rows = self._latest(runs)
        if first is not None:
            rows = rows.filter(F.col(self.tick) >= first)
        return rows if last is None else rows.filter(F.col(self.tick) <= last)

    def read_for(self, wanted: DataFrame) -> DataFrame:
        """Rows of all runs that can hold a wanted ``tick`` (and ``epoch``, where that is a column of ``wanted``)."""
        runs = list(self.version().runs)
        if not runs:
            return self._latest([])
        # A few rows per kept epoch.
        listed = self.spark.createDataFrame([(r.run, r.epoch, Decimal(r.first_tick), Decimal(r.last_tick)) for r in runs], "run BIGINT, __epoch BIGINT, first DECIMAL(20,0), last DECIMAL(20,0)")
        columns = [c for c in ("epoch", "tick") if c in wanted.columns]
        meets = F.col("tick").between(F.col("first"), F.col("last"))
        if "epoch" in columns:
            meets &= F.col("epoch") == F.col("__epoch")
        needed = listed.join(wanted.select(*columns).distinct(), meets, "left_semi").select("run", "__epoch").collect()
        needed = {(r["run"], r["__epoch"]) for r in needed}
        return self._latest([r for r in runs if (r.run, r.epoch) in needed])

    def status(self, delivered: bool = False) -> DataFrame:
        """First and last tick and number of events (or of deliveries) per epoch, from the list alone."""
        n = "deliveries" if delivered else "events"
        runs = [(r.epoch, Decimal(r.first_tick), Decimal(r.last_tick), getattr(r, n)) for r in self.version().runs]
        rows = self.spark.createDataFrame(runs, "epoch BIGINT, first DECIMAL(20,0), last DECIMAL(20,0), n BIGINT")
        tick = lambda c: c.cast("bigint")
        return rows.groupBy("epoch").agg(tick(F.min("first")).alias("first_tick"), tick(F.max("last")).alias("last_tick"), F.sum("n").alias("total_events"))

    # ------------------------------------------------------------ writing

    def append(self, rows: DataFrame, batch: int, *arrival: str, keep_epochs: int = 0, before: Version | None = None) -> Version:
        """Put a batch's rows over the table; of rows with equal keys the last in ``arrival`` order counts.

        All rows must be in scope. The list is written when everything it names is there. ``before`` is the version before
        this batch, where the caller has read it already.
        """
        before = before or self.version(batch - 1)
        delivered = {r["epoch"]: r["n"] for r in rows.groupBy("epoch").agg(F.count(F.lit(1)).alias("n")).collect()}
        runs = list(before.runs)
        if delivered:
            new = self._write(latest_by_key(rows, list(self.key), *arrival), 2 * batch, delivered)
            held = self._held(before, new)
            runs += [replace(r, events=r.events - held.get(r.epoch, 0)) for r in new]
        dropped = before.dropped
        epochs = sorted({r.epoch for r in runs}, reverse=True)
        if keep_epochs and len(epochs) > keep_epochs:
            dropped = max(dropped, epochs[keep_epochs])
            runs = [r for r in runs if r.epoch > dropped]
        runs = self._merged(runs, max((r.epoch for r in before.runs), default=None), 2 * batch + 1)
        version = Version(batch, tuple(runs), dropped)
        self._switch(version)
        self._clean(version, before, False)
        return version

    def _write(self, rows: DataFrame, number: int, delivered: dict[int, int]) -> list[Run]:
        """Write a run; what is in it of each epoch."""
        order = dict.fromkeys(["epoch", self.tick, *self.key])
        ordered = rows.select(*self._schema.names).repartitionByRange(*order).sortWithinPartitions(*order)
        writer = ordered.write.mode("overwrite").partitionBy("epoch")
        if self.lookup:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.lookup}", "true")
        writer.parquet(f"{self.path}/run={number}")
        back = self.spark.read.schema(self._schema).parquet(f"{self.path}/run={number}")
        span = F.col(self.span) if self.span else F.lit(None).cast("decimal(20,0)")
        found = back.groupBy("epoch").agg(
            F.min(self.tick).alias("first"), F.max(self.tick).alias("last"), F.count(F.lit(1)).alias("n"),
            F.min(span).alias("low"), F.max(span).alias("high"), F.count(span).alias("known"),
        )
        out = []
        for r in found.collect():
            # A row without a span may share its key with any other.
            ends = (int(r["low"]), int(r["high"])) if r["known"] == r["n"] else (None, None)
            out.append(Run(r["epoch"], number, 0, int(r["first"]), int(r["last"]), r["n"], delivered[r["epoch"]], *ends))
        return out

    def _held(self, before: Version, new: list[Run]) -> dict[int, int]:
        """How many keys of each epoch of a new run stand in the table already. Only runs that can hold some of its keys are asked."""
        old = [r for r in before.runs if any(r.meets(n) for n in new)]
        asked = [n for n in new if any(r.meets(n) for r in old)]
        if not old:
            return {}
        within = F.col(self.tick).between(min(n.first_tick for n in asked), max(n.last_tick for n in asked))
        if all(n.first_span is not None for n in asked):
            within &= F.col(self.span).between(min(n.first_span for n in asked), max(n.last_span for n in asked))
        key = list(dict.fromkeys(["epoch", *self.key]))
        # Both sides are shuffled: keys of a table that grows are not to pass through the driver.
        known = self._rows_of(old).filter(within).select(*key).hint("merge")
        counts = self._rows_of(asked).select(*key).join(known, key, "left_semi").groupBy("epoch").count()
        return {r["epoch"]: r["count"] for r in counts.collect()}

    def _merged(self, runs: list[Run], newest_before: int | None, number: int) -> list[Run]:
        """Merge what has piled up; all merges of a batch are one run."""
        newest = max((r.epoch for r in runs), default=None)
        together: list[list[Run]] = []
        for epoch in {r.epoch for r in runs}:
            own = [r for r in runs if r.epoch == epoch]
            if epoch == newest_before and newest > epoch and len(own) > 1:
                together.append(own)
                continue
            # Runs of a level are newer than all of the levels above it.
            group: list[Run] = []
            for level in sorted({r.level for r in own}):
                here = [r for r in own if r.level == level]
                if len(here) + bool(group) < self.fan_in:
                    break
                group += here
            if group:
                together.append(group)
        if not together:
            return runs
        merged = [r for group in together for r in group]
        delivered = {epoch: sum(r.deliveries for r in merged if r.epoch == epoch) for epoch in {r.epoch for r in merged}}
        written = {r.epoch: r for r in self._write(self._latest(merged), number, delivered)}
        gone = set(merged)
        out = [r for r in runs if r not in gone]
        for group in together:
            whole = len(group) == sum(r.epoch == group[0].epoch for r in runs) and group[0].epoch < newest
            level = _CLOSED if whole else max(r.level for r in group) + 1
            out.append(replace(written[group[0].epoch], level=level, events=sum(r.events for r in group)))
        return sorted(out, key=lambda r: (r.epoch, r.run))

    def _switch(self, version: Version) -> None:
        span = lambda x: None if x is None else Decimal(x)
        rows = [(r.epoch, r.run, r.level, Decimal(r.first_tick), Decimal(r.last_tick), r.events, r.deliveries, span(r.first_span), span(r.last_span)) for r in version.runs]
        rows.append((version.dropped, None, -1, None, None, 0, 0, None, None))
        listed = self.spark.createDataFrame(rows, _LIST).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.path}/versions/v={version.batch}")

    def clean(self, dropped_epochs: bool = False) -> int:
        """Remove lists older than the last two, and runs that neither of those names; returns how many went.

        Every batch does that, so a reader has the time of one batch to finish with a list. Files of epochs that retention
        dropped stay unless ``dropped_epochs``.
        """
        newest = self.version()
        return self._clean(newest, self.version(newest.batch - 1), dropped_epochs)

    def _clean(self, newest: Version, older: Version, dropped_epochs: bool) -> int:
        files = self._files()
        named = {(r.run, r.epoch) for v in (newest, older) for r in v.runs}
        out = 0
        for run in self._children(self.path, "run="):
            for epoch in self._children(f"{self.path}/run={run}", "epoch="):
                if (run, epoch) not in named and run <= 2 * newest.batch + 1 and (dropped_epochs or epoch > newest.dropped):
                    out += files.delete(self._jvm_path(f"{self.path}/run={run}/epoch={epoch}"), True)
            if not self._children(f"{self.path}/run={run}", "epoch=") and run <= 2 * newest.batch + 1:
                files.delete(self._jvm_path(f"{self.path}/run={run}"), True)
        for batch in self._children(f"{self.path}/versions", "v="):
            if batch < older.batch:
                files.delete(self._jvm_path(f"{self.path}/versions/v={batch}"), True)
        return out

    def _children(self, folder: str, prefix: str) -> list[int]:
        files, path = self._files(), self._jvm_path(folder)
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))
