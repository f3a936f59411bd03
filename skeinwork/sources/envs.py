"""Environment configs: a small unpartitioned table with automatic ids."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates, reads
from ..schema import ENV_CONFIG
from .files import Folder
from .store import Exists, Table


class EnvConfigs:
    def __init__(self, spark: SparkSession, name: str, create: bool = False, path: str | None = None) -> None:
        self.spark = spark
        self.table = Table.create(spark, name, ENV_CONFIG, path, key=None) if create else Table(spark, name)

    def read(self) -> DataFrame:
        return self.table.read().drop("bucket")

    def save(self, configs: list[dict] | dict) -> list[int]:
        """Append configs; ids go on from the greatest. All are checked before any is written."""
        rows = []
        for c in [configs] if isinstance(configs, dict) else configs:
            if unknown := sorted(set(c) - set(ENV_CONFIG.fieldNames())):
                raise ValueError(f"unknown: {', '.join(unknown)}")
            if not str(c.get("env_name") or "").strip():
                raise ValueError("env_name is required")
            rows.append(dict(c))
        if not rows:
            return []
        first = aggregates.next_id(self.table.read()).first()[0]
        if not Folder(self.spark, self.table.location).create(f"_claims/{first}", str(len(rows))):
            raise Exists(f"another writer has id {first}")  # Spark doesn't read names that begin with _
        now = int(time.time())
        for k, c in enumerate(rows):
            params = c.get("env_params")
            c |= {"id": first + k, "env_id": c.get("env_id") or f"env-{first + k}", "job_id": c.get("job_id") or "", "finished": bool(c.get("finished")), "env_params": "{}" if params is None else params if isinstance(params, str) else json.dumps(params), "created_at": c.get("created_at") or now}
        df = self.spark.createDataFrame([tuple(c.get(f) for f in ENV_CONFIG.fieldNames()) for c in rows], ENV_CONFIG)
        self.table.append(df)
        return [c["id"] for c in rows]

    def page(self, limit: int | None = None, offset: int = 0, where: str | None = None) -> DataFrame:
        return reads.read(self.read(), where, order_by="id", limit=limit, offset=offset)

    def update(self, env_id: str, values: dict) -> bool:
        values = {k: json.dumps(v) if k == "env_params" and not isinstance(v, str) else v for k, v in values.items()}
        return self.table.update(F.col("env_id") == F.lit(env_id), values) > 0

    def delete(self, env_id: str) -> bool:
        return self.table.delete(F.col("env_id") == F.lit(env_id)) > 0

    def clear(self) -> int:
        return self.table.delete("true")

    def count(self, where: str | None = None) -> int:
        return self.table.count(where)

    def images(self) -> DataFrame:
        return aggregates.latest_image(self.read())

    def envs_by_image(self) -> DataFrame:
        return aggregates.first_env_of_image(self.read())

    def params(self) -> DataFrame:
        """env_id and its params as Variant; blank ones are an empty object."""
        return self.read().select("env_id", F.coalesce(F.try_parse_json("env_params"), F.parse_json(F.lit("{}"))).alias("params"))
