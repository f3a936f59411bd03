"""Runs of a pipeline over a table: incremental windows, ranges, filters, jobs and sessions, all as one plan each."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bucket
from ..operators.aggregates import run_summary
from ..operators.sessions import SESSION, dirty_sessions, in_window, key_error, whole_sessions
from ..sources.files import Kept
from ..sources.store import Table
from .checkpoints import Checkpoint, MemoryCheckpoints
from .pipeline import Pipeline, Processed


def now_ms() -> int:
    return int(time.time() * 1000)


@dataclass
class Run:
    """What a run did; merge() adds up runs of one pipeline."""

    pipeline: str
    run_id: str
    sessions: int = 0
    rows_read: int = 0
    rows_written: int = 0
    failures: int = 0
    errors: list[str] = field(default_factory=list)
    windows: dict[int, tuple[int, int]] = field(default_factory=dict)
    failed_buckets: list[int] = field(default_factory=list)
    keys: DataFrame | None = None

    def merge(self, other: Run) -> Run:
        if self.pipeline != other.pipeline:
            raise ValueError("runs of different pipelines")
        return Run(self.pipeline, self.run_id, self.sessions + other.sessions, self.rows_read + other.rows_read, self.rows_written + other.rows_written, self.failures + other.failures, sorted({*self.errors, *other.errors}), self.windows | other.windows, sorted({*self.failed_buckets, *other.failed_buckets}))

    def report(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "keys"} | {"windows": {str(k): list(v) for k, v in self.windows.items()}}


class Engine:
    def __init__(self, landing: Table, serving: Table | None = None, checkpoints: MemoryCheckpoints | None = None, names: tuple[str, str] = ("landing", "serving")) -> None:
        self.landing, self.serving, self.checkpoints, self.names = landing, serving, checkpoints or MemoryCheckpoints(), names

    # what to process

    def run_range(self, p: Pipeline, start_ms: int, end_ms: int, dry_run: bool = False) -> Run:
        """All sessions with a change in [start, end]; checkpoints stay as they are."""
        if start_ms > end_ms:
            raise ValueError("start is after end")
        return self._run(p, self.landing.read().where(in_window(start_ms, end_ms, closed=True)), dry_run)

    def run_filter(self, p: Pipeline, where: str, dry_run: bool = False) -> Run:
        """All sessions with a row that matches, each once."""
        if not where.strip():
            raise ValueError("a filter is required")
        return self._run(p, self.landing.read(where=where), dry_run)

    def run_jobs(self, p: Pipeline, jobs: list[str], dry_run: bool = False) -> Run:
        names = sorted({j.strip() for j in jobs})
        if not names or not names[0]:
            raise ValueError("blank job")
        return self._run(p, self.landing.read(where=F.col("job_id").isin(names)), dry_run)

    def run_sessions(self, p: Pipeline, keys: DataFrame, dry_run: bool = False) -> Run:
        """keys: (job_id, session_id), as from another run's dirty sessions."""
        keys = keys.select(*SESSION).distinct()
        return self._run(p, self.landing.read(self.landing.buckets_of(keys)).join(keys, list(SESSION), "left_semi"), dry_run)

    def run_incremental(self, p: Pipeline, settle_delay_ms: int = 0, start_from: int | None = None, dry_run: bool = False, started_ms: int | None = None, buckets: list[int] | None = None) -> Run:
        """All sessions with a change after each bucket's committed time, up to the start of the run less the settle delay.

        The windows (committed, cutoff] of all buckets are one DataFrame joined to the changes on bucket, so buckets run
        side by side. Buckets fail alone: those of failed sessions keep their
        windows, all others are committed. A window left active by a failed run is taken again as it was; then a second pass catches up to
        the cutoff, in all buckets but those that failed in the first. A row that arrives later than the delay allows, with an older time, is missed, as documented; a range
        run finds it. start_from (inclusive) is where a bucket without a checkpoint begins.
        """
        if settle_delay_ms < 0:
            raise ValueError("settle_delay_ms is negative")
        started = now_ms() if started_ms is None else started_ms
        cutoff, run_id = started - settle_delay_ms, uuid.uuid4().hex
        prefix = "|".join((p.name, p.version, *self.names))
        known = self.checkpoints.load(prefix)
        total = Run(p.name, run_id)
        for _ in range(2):
            windows = []
            for b in self.landing.partitions():
                if (buckets is not None and b not in buckets) or b in total.failed_buckets:
                    continue
                c = known.get(b)
                if c is None:
                    if start_from is None:
                        raise ValueError(f"bucket {b} has no checkpoint; give start_from")
                    c = Checkpoint(pipeline_name=p.name, pipeline_version=p.version, source_table=self.names[0], target_table=self.names[1], bucket=b, committed_until_ms=start_from - 1)
                resumed = c.active_window_end_ms is not None and c.active_window_start_ms is not None
                start, end = (c.active_window_start_ms, c.active_window_end_ms) if resumed else (c.committed_until_ms, cutoff)
                if end > start:
                    windows.append(c.started(run_id, start, end, started))
            if not windows:
                return total
            if not dry_run:
                self.checkpoints.save(windows)
            bounds = self.landing.spark.createDataFrame([(c.bucket, c.active_window_start_ms, c.active_window_end_ms) for c in windows], "bucket long, after long, upto long")
            changes = self.landing.read([c.bucket for c in windows]).join(F.broadcast(bounds), "bucket").where("source_updated_at > after and source_updated_at <= upto").drop("after", "upto")
            try:
                one = self._run(p, changes, dry_run, run_id, [c.bucket for c in windows])
            except Exception:
                if not dry_run:
                    self.checkpoints.save([c.failed(started) for c in windows])
                raise
            one.windows = {c.bucket: (c.active_window_start_ms, c.active_window_end_ms) for c in windows}
            keys = one.keys if total.keys is None else total.keys.union(one.keys).distinct()
            total = one if total.sessions == 0 and not total.windows else total.merge(one)
            total.keys = keys
            done = [c.failed(started) if c.bucket in one.failed_buckets else c.committed(started) for c in windows]
            if dry_run:
                return total
            self.checkpoints.save(done)
            known |= {c.bucket: c for c in done}
        return total

    # how

    def _run(self, p: Pipeline, changes: DataFrame, dry_run: bool, run_id: str | None = None, buckets: list[int] | None = None) -> Run:
        """buckets: those that hold the changes, where it is known; else the keys say. A session is in one bucket, so no other is read."""
        rows_held = None
        kept = Kept(changes.select("id", *SESSION), "changed-rows")  # the run's own writes change what the table says
        changes = kept.rows
        keys = dirty_sessions(changes)
        try:
            own = self.landing.buckets_of(keys) if buckets is None else buckets
            rows = whole_sessions(self.landing.read(own, latest=False), keys).drop("bucket")
            done = p.process(rows)
            rows_held = done.rows.persist()
            done = Processed(rows_held, done.failures, done.outputs)
            s = run_summary(done.sessions()).first()
            lost = changes.where(key_error().isNotNull()).select("job_id", key_error().alias("error"))
            failing = done.failures.select("job_id", F.lit(None).cast("string").alias("error")).unionByName(lost)
            told = failing.groupBy(bucket(F.col("job_id"), self.landing.buckets).alias("b"), "error").agg(F.count("*").alias("n")).collect()  # three rows a bucket at most
            failures, failed = sum(r["n"] for r in told), sorted({r["b"] for r in told})
            errors = sorted({*s["errors"], *(r["error"] for r in told if r["error"])})
            if not dry_run:
                self._sink(p, done)
            return Run(p.name, run_id or uuid.uuid4().hex, s["sessions"], s["rows_read"], s["rows_written"], failures, errors, failed_buckets=failed, keys=keys)
        finally:
            if rows_held is not None:
                rows_held.unpersist()

    def _sink(self, p: Pipeline, done: Processed) -> None:
        stamp = now_ms()
        if p.mode == "serving":
            if self.serving is None:
                raise ValueError("a serving table is required")
            self.serving.upsert(done.records(), stamp, everywhere=False)  # a record keeps its job
        else:
            self.landing.patch(done.changes().drop("changed"), done.outputs, stamp)


def unserved(dirty: DataFrame, served: DataFrame) -> DataFrame:
    """Sessions that one pipeline changed and the other has not processed in this run."""
    return dirty.join(served.select(*SESSION).distinct(), list(SESSION), "left_anti")
