"""Pipeline stages over whole sessions: column stages that stay in generated code, and Python stages for the rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import job_tags, joined_text
from ..functions.json import append_json
from ..operators.sessions import SESSION, trace_error, trainability
from ..schema import RECORD


@dataclass(frozen=True)
class Context:
    pipeline: str
    version: str


@dataclass(frozen=True)
class Stage:
    """apply(rows, context) gives rows back with __sel (the row is patched), __err (the session fails) and __new_<output>.

    A patch may set null, so __sel decides, never the value.
    """

    name: str
    version: str
    required: tuple[str, ...]
    outputs: tuple[str, ...]
    apply: Callable[[DataFrame, Context], DataFrame] = field(compare=False)
    depends: tuple[str, ...] = ()


def session_stage(name: str, version: str, required: tuple[str, ...], outputs: tuple[str, ...], transform: Callable[[list[dict], Context], dict], depends: tuple[str, ...] = ()) -> Stage:
    """A stage of Python: transform(session's rows by step_id, context) -> {id: {output: value}}.

    A session is one group of applyInPandas: the shuffle is on its key, and other sessions go on if one fails. The
    function must be pure; it gets copies. A patch for an unknown id or of an undeclared field fails its session.
    """

    def apply(rows: DataFrame, context: Context) -> DataFrame:
        kinds = {f.name: f.dataType for f in RECORD} | {f.name: f.dataType for f in rows.schema}
        extra = [T.StructField("__sel", T.BooleanType()), T.StructField("__err", T.StringType()), *[T.StructField(f"__new_{o}", kinds.get(o, T.StringType())) for o in outputs]]
        schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema], *extra])

        def run(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("step_id")
            out = group.assign(__sel=False, __err=None, **{f"__new_{o}": None for o in outputs})
            records = [{k: None if not isinstance(v, (list, dict)) and pd.api.types.is_scalar(v) and pd.isna(v) else v for k, v in r.items()} for r in group.to_dict("records")]
            try:
                patches = transform([dict(r) for r in records], context) or {}
                ids = list(group["id"])
                if unknown := sorted(set(patches) - set(ids)):
                    raise ValueError(f"unknown id {unknown[0]}")
                for i, patch in patches.items():
                    if not patch or set(patch) - set(outputs):
                        raise ValueError(f"{i}: a patch sets declared fields, one at least")
                for o in outputs:
                    out[f"__new_{o}"] = pd.Series([patches.get(i, {}).get(o, r.get(o)) for i, r in zip(ids, records, strict=True)], index=out.index, dtype=object)
                out["__sel"] = [i in patches for i in ids]
            except Exception as e:  # noqa: BLE001 - a session's failure is a row of the failures table
                out["__err"] = f"{type(e).__name__}: {e}"
            return out

        return rows.groupBy(*SESSION).applyInPandas(run, schema)

    return Stage(name, version, required, outputs, apply, depends)


def _trainable(rows: DataFrame, _: Context) -> DataFrame:
    t = trainability(rows).select(*SESSION, F.col("selected").alias("__sel"), F.col("error").alias("__err"), "tails")
    return rows.join(t, list(SESSION), "left").withColumn("__new_is_trainable", F.array_contains("tails", F.col("step_id"))).drop("tails")


def _chosen(rows: DataFrame, _: Context) -> DataFrame:
    on = F.coalesce("is_trainable", F.lit(False))
    return rows.withColumns({"__sel": on, "__err": F.when(on, trace_error()), "__new_chosen_trace": append_json(F.col("messages"), F.col("response"))})


def _search(rows: DataFrame, _: Context) -> DataFrame:
    text = joined_text(*[F.col(c) for c in ("chosen_trace", "rejected_trace", "agent_model", "meta_json")])
    return rows.withColumns({"__sel": F.coalesce("is_trainable", F.lit(False)), "__err": F.lit(None).cast("string"), "__new_search_text": text})


def _tags(rows: DataFrame, _: Context) -> DataFrame:
    return rows.withColumns({"__sel": F.coalesce("is_trainable", F.lit(False)), "__err": F.lit(None).cast("string"), "__new_tags": job_tags(F.col("job_id"))})


UPDATE_IS_TRAINABLE = Stage("update_is_trainable", "1", ("messages", "is_session_completed", "meta_json"), ("is_trainable",), _trainable)
BUILD_CHOSEN_TRACE = Stage("build_chosen_trace", "1", ("messages", "response", "is_trainable"), ("chosen_trace",), _chosen)
BUILD_SEARCH_TEXT = Stage("build_search_text", "1", ("chosen_trace", "rejected_trace", "agent_model", "meta_json", "is_trainable"), ("search_text",), _search, ("build_chosen_trace",))
DERIVE_JOB_TAGS = Stage("derive_job_tags", "1", ("job_id", "is_trainable"), ("tags",), _tags)
