"""Settings: a profile, then what the environment overrides. A session's own configuration is never touched."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .plans.checkpoints import FileCheckpoints
from .plans.engine import Engine
from .sources.envs import EnvConfigs
from .schema import ENV_CONFIG, LANDING_INDEXES, RECORD
from .sources.store import Table


@dataclass(frozen=True)
class Settings:
    root: str
    database: str
    landing: str = "landing"
    serving: str = "serving"
    envs: str = "environments"
    checkpoints: str = "checkpoints"
    production: bool = False
    metrics: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


PROFILES = {"test": Settings("/data/skeinwork-test", "skeinwork_test", "landing_test", "serving_test"), "production": Settings("/data/skeinwork", "skeinwork", production=True)}


def settings(profile: str = "test") -> Settings:
    """A profile with SKEINWORK_ROOT, SKEINWORK_LANDING, ... in place of its values."""
    out = PROFILES[profile]
    over = {f.name: os.environ[f"SKEINWORK_{f.name.upper()}"] for f in fields(out) if f.type == "str" and f"SKEINWORK_{f.name.upper()}" in os.environ}
    return replace(out, **over)


class Workspace:
    """The tables of a profile: a database of the session's catalog, kept under root. Closing it leaves the shared session alone."""

    def __init__(self, spark: SparkSession, config: Settings) -> None:
        self.spark, self.config = spark, config

    def name(self, table: str) -> str:
        return f"{self.config.database}.{table}"

    def create(self, table: str, schema: T.StructType, **layout) -> Table:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.config.database} LOCATION '{self.config.root}'")
        return Table.create(self.spark, self.name(table), schema, **layout)

    def initialize(self, *tables: str) -> list[str]:
        """Create what is not there yet of the named tables (all, if none is named) and the checkpoint store."""
        known = {self.config.landing: (RECORD, {"indexes": LANDING_INDEXES}), self.config.serving: (RECORD, {"indexes": LANDING_INDEXES}), self.config.envs: (ENV_CONFIG, {"key": None})}
        made = [t for t in tables or known if not self.spark.catalog.tableExists(self.name(t))]
        for t in made:
            schema, layout = known.get(t, (RECORD, {"indexes": LANDING_INDEXES}))
            self.create(t, schema, **layout)
        if self.checkpoints.initialize():
            made.append(self.config.checkpoints)
        return made

    @property
    def checkpoints(self) -> FileCheckpoints:
        return FileCheckpoints(self.spark, self.config.path(self.config.checkpoints))

    def table(self, name: str) -> Table:
        return Table(self.spark, self.name(name))

    @property
    def landing(self) -> Table:
        return self.table(self.config.landing)

    @property
    def serving(self) -> Table:
        return self.table(self.config.serving)

    @property
    def envs(self) -> EnvConfigs:
        return EnvConfigs(self.spark, self.name(self.config.envs))

    def engine(self) -> Engine:
        return Engine(self.landing, self.serving, self.checkpoints, (self.config.landing, self.config.serving))

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        return None
