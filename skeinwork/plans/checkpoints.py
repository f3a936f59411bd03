"""Durable positions of incremental runs: one record for each pipeline, source, target and bucket."""

from __future__ import annotations

import json
from dataclasses import asdict, field, make_dataclass, replace
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import CHECKPOINT
from ..sources.files import Folder

_IDENTITY = ("pipeline_name", "pipeline_version", "source_table", "target_table", "bucket")
_FIRST = {"status": "IDLE", "updated_at_ms": 0}
_KINDS = {T.StringType(): str, T.LongType(): int, T.IntegerType(): int}
_FIELDS = [f for f in CHECKPOINT if f.name != "id"]


class CheckpointError(RuntimeError):
    """The store is not there, holds other records than these, or another run saved first."""


def _check(record: dict) -> None:
    """A record has exactly the fields of the schema, of its types; only nullable ones may be null."""
    if set(record) != {f.name for f in _FIELDS}:
        raise CheckpointError(f"fields {sorted(record)}")
    for f in _FIELDS:
        v = record[f.name]
        if (v is None and not f.nullable) or (v is not None and type(v) is not _KINDS[f.dataType]):
            raise CheckpointError(f"{f.name} is {v!r}")


class _Moves:
    @property
    def id(self) -> str:
        return "|".join(str(getattr(self, f)) for f in _IDENTITY)

    def started(self, run_id: str, start: int, end: int, now: int) -> Checkpoint:
        return replace(self, last_run_id=run_id, active_window_start_ms=start, active_window_end_ms=end, status="RUNNING", updated_at_ms=now)

    def failed(self, now: int) -> Checkpoint:
        """The window stays active, so that the next run takes the same one again."""
        return replace(self, status="FAILED", updated_at_ms=now)

    def committed(self, now: int) -> Checkpoint:
        return replace(self, committed_until_ms=max(self.committed_until_ms, self.active_window_end_ms or 0), active_window_start_ms=None, active_window_end_ms=None, last_processed_id=None, status="IDLE", updated_at_ms=now)


#: The columns of CHECKPOINT beside its id, which follows from the identity.
Checkpoint = make_dataclass("Checkpoint", [(f.name, object) if not f.nullable and f.name not in _FIRST else (f.name, object, field(default=_FIRST.get(f.name))) for f in _FIELDS], bases=(_Moves,), frozen=True, kw_only=True)


class MemoryCheckpoints:
    def __init__(self) -> None:
        self._rows: dict[str, Checkpoint] = {}

    def initialize(self) -> bool:
        return False

    def verify_ready(self) -> None:
        return None

    def load(self, prefix: str) -> dict[int, Checkpoint]:
        return {c.bucket: c for k, c in self._rows.items() if k.startswith(prefix + "|")}

    def save(self, rows: list[Checkpoint]) -> None:
        self._rows |= {c.id: c for c in rows}

    def delete(self, ids: list[str]) -> None:
        for i in ids:
            self._rows.pop(i, None)


class FileCheckpoints(MemoryCheckpoints):
    """One small file for each version of each record; the greatest version is the position.

    A save creates the version after the one that this store has seen last, and only if it is not there yet: nothing is
    overwritten, so a crash at any point leaves the last position, and of two runs that move one record the second is
    told so (CheckpointError) and loses nothing of the first. Runs of other pipelines or buckets write other records.
    The file system must create files exclusively, as HDFS and local ones do.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__()
        self._folder = Folder(spark, path)
        self._seen: dict[str, int] = {}

    def initialize(self) -> bool:
        """Make the store; True only if it was not there. One that holds other records is refused."""
        made = self._folder.create("schema.json", CHECKPOINT.json())
        self.verify_ready()
        return made

    def verify_ready(self) -> None:
        if not self._folder.exists("schema.json"):
            raise CheckpointError(f"{self._folder.path} is no checkpoint store; initialize it first")
        if T.StructType.fromJson(self._folder.read_json("schema.json")) != CHECKPOINT:
            raise CheckpointError(f"{self._folder.path} holds other records")

    def _versions(self, name: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self._folder.names(f"records/{name}") if n.endswith(".json"))

    def load(self, prefix: str) -> dict[int, Checkpoint]:
        """The newest version of each record; there are no more than buckets for a prefix."""
        self.verify_ready()
        for name in self._folder.names("records"):
            identity = unquote(name)
            if prefix and not identity.startswith(prefix + "|"):
                continue
            versions = self._versions(name)
            self._seen[identity] = versions[-1] if versions else 0
            record = self._folder.read_json(f"records/{name}/{versions[-1]}.json") if versions else None
            if record is None:  # deleted
                self._rows.pop(identity, None)
                continue
            _check(record)
            self._rows[identity] = Checkpoint(**record)
        return super().load(prefix) if prefix else {}

    def _create(self, identity: str, record: dict | None) -> None:
        name, version = quote(identity, safe=""), self._seen.get(identity, 0) + 1
        if not self._folder.create(f"records/{name}/{version}.json", json.dumps(record)):
            raise CheckpointError(f"another run moved {identity} to version {version}")
        self._seen[identity] = version
        for old in self._versions(name):
            if old < version - 1:
                self._folder.delete(f"records/{name}/{old}.json")

    def save(self, rows: list[Checkpoint]) -> None:
        self.verify_ready()
        for c in rows:
            _check(asdict(c))
        for c in rows:
            self._create(c.id, asdict(c))
            self._rows[c.id] = c

    def delete(self, ids: list[str]) -> None:
        """A version that says so, as any change; records are small and few."""
        for i in ids:
            if i in self._rows:
                self._create(i, None)
        super().delete(ids)

    def frame(self, spark: SparkSession) -> DataFrame:
        self.load("")
        rows = [tuple([c.id, *[getattr(c, f.name) for f in _FIELDS]]) for c in self._rows.values()]
        return spark.createDataFrame(rows, CHECKPOINT)
