"""Pipelines: a checked, ordered set of stages, folded over whole sessions as one plan."""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sessions import SESSION, session_errors
from ..schema import IMMUTABLE, RECORD
from .stages import BUILD_CHOSEN_TRACE, BUILD_SEARCH_TEXT, DERIVE_JOB_TAGS, UPDATE_IS_TRAINABLE, Context, Stage


@dataclass(frozen=True)
class Processed:
    """rows: good sessions' rows as patched, with __patched and __before_<output>; failures: (job_id, session_id, id, stage, error)."""

    rows: DataFrame
    failures: DataFrame
    outputs: tuple[str, ...]

    def changes(self) -> DataFrame:
        """(id, job_id, session_id, changed, outputs...): rows whose outputs differ from before (null equals null, NaN equals NaN)."""
        names = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__before_{c}")), F.lit(c)) for c in self.outputs]))
        return self.rows.withColumn("changed", names).where(F.size("changed") > 0).select("id", *SESSION, "changed", *self.outputs)

    def records(self) -> DataFrame:
        """Rows that any stage patched, whole."""
        return self.rows.where("__patched").drop("__patched", *[f"__before_{c}" for c in self.outputs])

    def sessions(self) -> DataFrame:
        """(job_id, session_id, rows_read, rows_written, error) for a run's summary."""
        good = self.rows.groupBy(*SESSION).agg(F.count("*").alias("rows_read"), F.count_if("__patched").alias("rows_written"), F.lit(None).cast("string").alias("error"))
        bad = self.failures.groupBy(*SESSION).agg(F.count("*").alias("rows_read"), F.lit(0).cast("long").alias("rows_written"), F.first("error").alias("error"))
        return good.unionByName(bad)


@dataclass(frozen=True)
class Pipeline:
    name: str
    version: str
    mode: str  # landing: patches go back to the source; serving: whole rows are published
    stages: tuple[Stage, ...]

    def __post_init__(self) -> None:
        self.ordered()

    def _check(self) -> None:
        if not re.fullmatch(r"[a-z][a-z0-9_]*", self.name) or not self.version or self.mode not in ("landing", "serving") or not self.stages:
            raise ValueError("a pipeline has a plain name, a version, a mode and stages")
        columns = set(RECORD.fieldNames())
        owner: dict[str, str] = {}
        names = [s.name for s in self.stages]
        if len(set(names)) < len(names):
            raise ValueError("two stages of one name")
        for s in self.stages:
            if not s.name or not s.version or not s.outputs:
                raise ValueError(f"{s.name}: name, version and outputs are required")
            if unknown := sorted((set(s.required) | set(s.outputs)) - columns):
                raise ValueError(f"{s.name}: no such column: {', '.join(unknown)}")
            if held := sorted(set(s.outputs) & set(IMMUTABLE)):
                raise ValueError(f"{s.name}: may not set {', '.join(held)}")
            for o in s.outputs:
                if o in owner:
                    raise ValueError(f"{o} is set by {owner[o]} and {s.name}")
                owner[o] = s.name
            if missing := sorted(set(s.depends) - set(names)):
                raise ValueError(f"{s.name}: depends on {', '.join(missing)}")

    def ordered(self) -> tuple[Stage, ...]:
        """Stages after those they depend on, else as declared."""
        self._check()
        place = {s.name: k for k, s in enumerate(self.stages)}
        waits = {s.name: set(s.depends) for s in self.stages}
        ready = [place[n] for n, d in waits.items() if not d]
        heapq.heapify(ready)
        out: list[Stage] = []
        while ready:
            s = self.stages[heapq.heappop(ready)]
            out.append(s)
            for n, d in waits.items():
                if s.name in d:
                    d.discard(s.name)
                    if not d:
                        heapq.heappush(ready, place[n])
        if len(out) < len(self.stages):
            raise ValueError("stages depend on each other in a circle")
        return tuple(out)

    def describe(self) -> list[dict]:
        return [{"stage": s.name, "version": s.version, "required": list(s.required), "outputs": list(s.outputs), "depends": list(s.depends)} for s in self.ordered()]

    def process(self, rows: DataFrame) -> Processed:
        """Fold the stages over whole sessions. A session that breaks a rule gives a failure for each row; one that a stage
        fails gives one, of the first stage and step, and none of its other output."""
        outputs = tuple(o for s in self.ordered() for o in s.outputs)
        kinds = {f.name: f.dataType for f in RECORD}
        have = set(rows.columns)
        made: set[str] = set()
        for s in self.ordered():
            if lacking := [r for r in s.required if r not in have | made]:
                raise ValueError(f"stage {s.name} needs {', '.join(lacking)}")
            made |= set(s.outputs)
        need = [c for c in outputs if c not in have]
        rows = rows.withColumns({c: F.lit(None).cast(kinds[c]) for c in need}) if need else rows
        columns = rows.columns
        invalid = session_errors(rows).where("error is not null").select(*SESSION, "error")
        failed = rows.join(invalid, list(SESSION)).select(*SESSION, "id", F.lit("__validation__").alias("stage"), "error")
        work = rows.join(invalid.select(*SESSION), list(SESSION), "left_anti").withColumns({f"__before_{c}": F.col(c) for c in outputs} | {"__patched": F.lit(False), "__failure": F.lit(None).cast("struct<k:int,step:int,id:string,stage:string,error:string>")})
        keep = work.columns
        for k, s in enumerate(self.ordered()):
            work = s.apply(work, Context(self.name, self.version))
            on = F.coalesce("__sel", F.lit(False))
            new = {o: F.when(on, F.col(f"__new_{o}").cast(kinds[o])).otherwise(F.col(o)) for o in s.outputs}
            failure = F.when(F.col("__err").isNotNull(), F.struct(F.lit(k).alias("k"), F.col("step_id").cast("int").alias("step"), F.col("id").alias("id"), F.lit(s.name).alias("stage"), F.col("__err").alias("error")))
            work = work.withColumns(new | {"__patched": F.col("__patched") | on, "__failure": F.coalesce("__failure", failure)}).select(*keep)
        first = work.where("__failure is not null").groupBy(*SESSION).agg(F.min("__failure").alias("f"))
        failures = failed.unionByName(first.select(*SESSION, "f.id", "f.stage", "f.error"))
        good = work.join(first.select(*SESSION), list(SESSION), "left_anti").select(*columns, "__patched", *[f"__before_{c}" for c in outputs])
        return Processed(good, failures, outputs)


LANDING_ENRICHMENT = Pipeline("landing_enrichment_pipeline", "1", "landing", (UPDATE_IS_TRAINABLE,))
LANDING_TO_SERVING = Pipeline("landing_to_serving_pipeline", "2", "serving", (BUILD_CHOSEN_TRACE, BUILD_SEARCH_TEXT, DERIVE_JOB_TAGS))
_KNOWN = {p.name: p for p in (LANDING_ENRICHMENT, LANDING_TO_SERVING)}


def register(pipeline: Pipeline) -> None:
    _KNOWN[pipeline.name] = pipeline


def pipeline(name: str) -> Pipeline:
    if name not in _KNOWN:
        raise KeyError(f"no pipeline {name}; there are {', '.join(sorted(_KNOWN))}")
    return _KNOWN[name]
