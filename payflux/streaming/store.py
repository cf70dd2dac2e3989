"""Append-only tables with an atomic multi-table commit per job micro-batch.

Several streaming jobs mutate the same logical tables (the payment worker
reserves funds on Banks, the confirmation worker settles and releases them;
SW1 inserts Settlement rows, SW2 updates their status). Instead of rewriting a
shared table in place, every job only *appends* rows or signed deltas, and the
current state is a Spark aggregation over what is committed:

* ``<table>/job=<job>/batch=<id>/``   rows appended by batch ``id`` of ``job``;
* ``_commits/job=<job>/range=<r>/batch=<id>/``  the commit record, written
  last (``r`` = id div ``range_size``); ``_jobs/job=<job>/range=<r>``
  registers the ranges a job has committed in;
* ``_bases/<table>/v=<n>/``           a compacted base version of a state
  table plus the per-job batch it covers (``covered``).

A batch is visible only once its commit record exists, so a failure midway
leaves the previous state intact. ``commit`` refuses a batch id that is
already committed, so a ``foreachBatch`` replay changes nothing. Only the
(fixed, tiny) commit log -- one row per job -- is broadcast; table rows are
read and aggregated by Spark. Everything is plain Spark I/O on a shared
Hadoop-compatible folder (on a cluster: under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import re
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

COVERED_SCHEMA = "job string, upto long"
# above this many uncovered batches of one job, state reads list the whole table
MAX_GLOB_BATCHES = 5000


class TableStore:
    def __init__(self, spark: SparkSession, base: str, job: str = "main", range_size: int = 1000):
        self.spark = spark
        self.base = base.rstrip("/")
        self.job = job
        self.range_size = range_size

    def for_job(self, job: str) -> "TableStore":
        """The same store as seen by another job (its own commit namespace)."""
        return TableStore(self.spark, self.base, job, self.range_size)

    def _path(self, *parts) -> str:
        return "/".join([self.base, *[str(p) for p in parts]])

    def _read(self, schema: str | StructType, *parts) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(self._path(*parts))
        except AnalysisException:  # nothing written yet
            return None

    # ------------------------------------------------------------------ commit log
    #
    # Commit records live under ``_commits/job=<job>/range=<id div range_size>/
    # batch=<id>``; when a job enters a new range it first registers it under
    # ``_jobs/job=<job>/range=<r>``. Bookkeeping lists files only
    # (``DataFrame.inputFiles``, no Spark job): the registry gives a job's
    # latest range (one entry per ``range_size`` batches) and that range's
    # folder its last commit, so the cost per micro-batch does not grow with
    # the number of batches ever committed.

    def _files(self, *parts) -> list[str]:
        try:
            # paths only, no partition inference
            return (self.spark.read.schema("committed_at timestamp").option("recursiveFileLookup", "true")
                    .parquet(self._path(*parts)).inputFiles())
        except AnalysisException:  # no such folder (yet)
            return []

    @staticmethod
    def _ids(files: list[str], name: str) -> list[int]:
        return [int(m.group(1)) for f in files for m in [re.search(rf"/{name}=(-?\d+)/", f)] if m]

    def _jobs(self) -> list[str]:
        return sorted({m.group(1) for f in self._files("_jobs")
                       for m in [re.search(r"/job=([^/]+)/", f)] if m})

    def last_commit(self, job: str | None = None) -> int | None:
        """Last committed batch of ``job``."""
        job = job or self.job
        # latest registered range first; a range registered by a commit that
        # never wrote its record holds no batch, so fall back to the one below
        for r in sorted(set(self._ids(self._files("_jobs", f"job={job}"), "range")), reverse=True):
            ids = self._ids(self._files("_commits", f"job={job}", f"range={r}"), "batch")
            if ids:
                return max(ids)
        return None

    def commit_log(self) -> DataFrame:
        """``(job, upto)``: the last committed batch of every job (one row per
        job, built on the driver from file listings)."""
        rows = [(j, b) for j in self._jobs() for b in [self.last_commit(j)] if b is not None]
        return self.spark.createDataFrame(rows, COVERED_SCHEMA)

    def commit(self, batch_id: int, appends: dict[str, DataFrame]) -> bool:
        """Write every table of the batch, then the commit record (last).

        Returns False without writing when ``batch_id`` is already committed
        (a replayed micro-batch).
        """
        last = self.last_commit()
        if last is not None and batch_id <= last:
            return False
        for name, df in appends.items():
            df.write.mode("overwrite").parquet(self._path(name, f"job={self.job}", f"batch={batch_id}"))
        r = batch_id // self.range_size
        registry = self._files("_jobs", f"job={self.job}")
        marks = [f"range={r}"] if r not in self._ids(registry, "range") else []
        # the tables this job writes, so bounded reads glob only their writers
        known = {m.group(1) for f in registry for m in [re.search(r"/table=([^/]+)/", f)] if m}
        marks += [f"table={name}" for name in appends if name not in known]
        for mark in marks:  # registered before the commit record (idempotent)
            self.spark.range(1).select(F.current_timestamp().alias("committed_at")).write \
                .mode("overwrite").parquet(self._path("_jobs", f"job={self.job}", mark))
        self.spark.range(1).select(F.current_timestamp().alias("committed_at")).write \
            .mode("overwrite").parquet(self._path("_commits", f"job={self.job}", f"range={r}", f"batch={batch_id}"))
        return True

    def is_committed(self, batch_id: int) -> bool:
        last = self.last_commit()
        return last is not None and batch_id <= last

    def batch_rows(self, name: str, batch_id: int) -> DataFrame | None:
        """Rows of ``name`` that exactly this batch of this job committed; None
        without its own commit record (a later batch's record does not count)."""
        done = self._files("_commits", f"job={self.job}", f"range={batch_id // self.range_size}")
        if batch_id not in self._ids(done, "batch"):
            return None
        try:
            return self.spark.read.parquet(self._path(name, f"job={self.job}", f"batch={batch_id}"))
        except AnalysisException:  # the batch wrote no such table
            return None

    def discard(self, batch_id: int) -> None:
        """Delete what a batch wrote before it failed for good, so that a later
        commit of the job does not make those rows visible."""
        self._delete("*", f"job={self.job}", f"batch={batch_id}")

    # ------------------------------------------------------------------ append tables

    def _committed_between(self, job: str, lo: int, hi: int) -> list[int]:
        """Committed batch ids of ``job`` in ``(lo, hi]`` (listing only their ranges)."""
        ranges = [r for r in set(self._ids(self._files("_jobs", f"job={job}"), "range"))
                  if (lo + 1) // self.range_size <= r <= hi // self.range_size]
        return sorted(b for r in ranges
                      for b in self._ids(self._files("_commits", f"job={job}", f"range={r}"), "batch")
                      if lo < b <= hi)

    def _bounded(self, name: str, full: StructType, after: DataFrame, upto: DataFrame) -> DataFrame | None:
        """Rows of exactly the committed batches in ``(after, upto]``: one glob
        path per job that writes ``name`` (``batch={a,b,...}``), so the read
        lists only those folders. None if it cannot be planned that way."""
        lo = {r["job"]: r["upto"] for r in after.collect()}   # one row per job
        hi = {r["job"]: r["upto"] for r in upto.collect()}
        writers = {m.group(1) for f in self._files("_jobs")
                   for m in [re.search(rf"/job=([^/]+)/table={re.escape(name)}/", f)] if m}
        paths = []
        for job in sorted(writers & set(hi)):
            ids = self._committed_between(job, lo.get(job, -1), hi[job])
            if len(ids) > MAX_GLOB_BATCHES:  # compaction overdue: a plain full read is simpler
                return None
            if ids:
                paths.append(self._path(name, f"job={job}", "batch={" + ",".join(map(str, ids)) + "}"))
        if not paths:
            return self.spark.createDataFrame([], full)
        try:
            return self.spark.read.schema(full).option("basePath", self._path(name)).parquet(*paths)
        except AnalysisException:
            return None

    def appended(self, name: str, schema: StructType, after: DataFrame | None = None,
                 upto: DataFrame | None = None) -> DataFrame:
        """Committed rows of an append table, all jobs.

        ``after``/``upto`` are ``(job, upto)`` frames bounding the batches read
        (exclusive / inclusive); ``upto`` defaults to the commit log. With
        ``after`` (state reads) only the uncovered committed batch folders are
        read; without it the whole table is listed.
        """
        full = StructType(list(schema.fields) + [StructField("job", StringType()),
                                                 StructField("batch", LongType())])
        if after is None:
            after = self._emptied(name)  # rows from before the last truncation are gone
        if after is not None:
            rows = self._bounded(name, full, after, upto if upto is not None else self.commit_log())
            if rows is not None:
                return rows.select(*schema.fieldNames())
        rows = self._read(full, name)
        if rows is None:
            return self.spark.createDataFrame([], schema)
        hi = (upto if upto is not None else self.commit_log()).select("job", F.col("upto").alias("_hi"))
        # one row per job: a fixed-size table, safe to broadcast
        rows = rows.join(F.broadcast(hi), "job").filter(F.col("batch") <= F.col("_hi"))
        if after is not None:
            lo = after.select("job", F.col("upto").alias("_lo"))
            rows = (rows.join(F.broadcast(lo), "job", "left")
                    .filter(F.col("_lo").isNull() | (F.col("batch") > F.col("_lo"))))
        return rows.select(*schema.fieldNames())

    # ------------------------------------------------------------------ state tables

    def seed(self, tables: dict[str, DataFrame]) -> None:
        """Base version 0 of state tables, covering no batch of any job; a table
        that has a base already is in use and is not replaced."""
        for name, df in tables.items():
            if self.last_commit(f"base-{name}") is not None:
                raise FileExistsError(f"state table {name} is seeded already")
            self._write_base(name, 0, df, self.spark.createDataFrame([], COVERED_SCHEMA))

    def _write_base(self, name: str, version: int, data: DataFrame, covered: DataFrame) -> None:
        data.write.mode("overwrite").parquet(self._path("_bases", name, f"v={version}", "data"))
        covered.write.mode("overwrite").parquet(self._path("_bases", name, f"v={version}", "covered"))
        self.for_job(f"base-{name}").commit(version, {})

    def _base(self, name: str) -> tuple[int, DataFrame, DataFrame]:
        v = self.last_commit(f"base-{name}")
        if v is None:
            raise FileNotFoundError(f"state table {name} was never seeded")
        data = self.spark.read.parquet(self._path("_bases", name, f"v={v}", "data"))
        covered = self.spark.read.schema(COVERED_SCHEMA).parquet(self._path("_bases", name, f"v={v}", "covered"))
        return v, data, covered

    def state(self, name: str, deltas: str, delta_schema: StructType,
              fold: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """Current state: the latest base folded with every committed delta
        row it does not cover."""
        _, data, covered = self._base(name)
        return fold(data, self.appended(deltas, delta_schema, after=covered))

    def truncate(self, name: str) -> None:
        """``REMOVE`` of every row of an append table, as one committed operation:
        rows of the batches committed so far are not read any more."""
        last = self.last_commit(f"base-empty-{name}")
        upto = self.commit_log().filter(~F.col("job").startswith("base-"))
        self._write_base(f"empty-{name}", 0 if last is None else last + 1,
                         self.spark.createDataFrame([], COVERED_SCHEMA), upto)

    def _emptied(self, name: str) -> DataFrame | None:
        v = self.last_commit(f"base-empty-{name}")
        if v is None:
            return None
        return self.spark.read.schema(COVERED_SCHEMA).parquet(self._path("_bases", f"empty-{name}", f"v={v}", "covered"))

    def rewrite(self, name: str, deltas: str, delta_schema: StructType,
                fold: Callable[[DataFrame, DataFrame], DataFrame],
                change: Callable[[DataFrame], DataFrame]) -> int:
        """An update of every row (``UPDATE ... WITH`` without a key) as one
        committed operation: the next base is the changed current state."""
        return self.compact(name, deltas, delta_schema, lambda data, rows: change(fold(data, rows)))

    def compact(self, name: str, deltas: str, delta_schema: StructType,
                fold: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Fold the committed deltas into a new base version, so later reads
        touch only deltas committed after it. Safe while jobs keep
        committing: the new base records exactly which batches it covers."""
        v, data, covered = self._base(name)
        upto = self.commit_log().filter(~F.col("job").startswith("base-"))
        # pin the covered batches: written first, then read back, so the fold
        # and the coverage record agree even if jobs commit meanwhile
        tmp = self._path("_bases", name, f"v={v + 1}", "covered")
        upto.write.mode("overwrite").parquet(tmp)
        pinned = self.spark.read.schema(COVERED_SCHEMA).parquet(tmp)
        new = fold(data, self.appended(deltas, delta_schema, after=covered, upto=pinned))
        new.write.mode("overwrite").parquet(self._path("_bases", name, f"v={v + 1}", "data"))
        self.for_job(f"base-{name}").commit(v + 1, {})
        if v >= 1:  # readers may still hold the version before; the one before that goes
            self._delete("_bases", name, f"v={v - 1}")
        return v + 1

    def _delete(self, *parts) -> None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(*parts))
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for found in fs.globStatus(at) or []:
            fs.delete(found.getPath(), True)
