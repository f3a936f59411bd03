"""Session rules: validation, gates, message-prefix chains, traces, search text, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_blank, job_tags, joined_text
from ..functions.json import append_json, fingerprints, is_json, json_kind, status_not_200

SESSION = ("job_id", "session_id")


def key_error() -> Column:
    """What a changed row's session key lacks, or null."""
    return F.when(is_blank(F.col("job_id")), "blank job_id").when(is_blank(F.col("session_id")), "blank session_id")


def dirty_sessions(changes: DataFrame) -> DataFrame:
    """Distinct keys of changed rows; rows without a whole key go to discovery_failures."""
    return changes.where(key_error().isNull()).select(*SESSION).distinct()


def discovery_failures(changes: DataFrame) -> DataFrame:
    return changes.where(key_error().isNotNull()).select("id", F.lit("__discovery__").alias("stage"), key_error().alias("error"))


def whole_sessions(landing: DataFrame, keys: DataFrame) -> DataFrame:
    """All rows of the sessions in keys. Catalyst broadcasts keys if it finds them small; else both sides shuffle on the key."""
    return landing.join(keys.select(*SESSION).distinct(), list(SESSION), "left_semi")


def in_window(start: int | None, end: int, closed: bool = False) -> Column:
    """(start, end] for incremental windows, [start, end] for ranges."""
    c = F.col("source_updated_at")
    low = F.lit(True) if start is None else (c >= start if closed else c > start)
    return low & (c <= end)


def session_errors(rows: DataFrame) -> DataFrame:
    """(job_id, session_id, n, error): the first rule a session breaks, or null."""
    bad_time = F.col("source_updated_at").isNull() | (F.col("source_updated_at") < 0)
    env = F.collect_set(F.when(~is_blank(F.col("env_id")), F.col("env_id"))) if "env_id" in rows.columns else F.array()
    each = rows.groupBy(*SESSION).agg(
        F.count("*").alias("n"),
        F.count_if(is_blank(F.col("id"))).alias("no_id"),
        F.count_distinct("id").alias("ids"),
        F.count_if(F.col("step_id").isNull()).alias("no_step"),
        F.count_distinct("step_id").alias("steps"),
        F.count_if(bad_time).alias("bad_time"),
        F.size(env).alias("envs"),
    )
    error = (
        F.when(F.col("no_id") > 0, "missing id")
        .when(F.col("ids") < F.col("n"), "duplicate id")
        .when(F.col("no_step") > 0, "missing step_id")
        .when(F.col("steps") < F.col("n"), "duplicate step_id")
        .when(F.col("bad_time") > 0, "bad source_updated_at")
        .when(F.col("envs") > 1, "several env_id")
    )
    return each.select(*SESSION, "n", error.alias("error"))


def status_gate(rows: DataFrame) -> DataFrame:
    """(job_id, session_id, blocked): any row reports a status code other than 200."""
    return rows.groupBy(*SESSION).agg(F.bool_or(status_not_200(F.col("meta_json"))).alias("blocked"))


def completion(rows: DataFrame) -> DataFrame:
    """(job_id, session_id, completed, on_last): any row is flagged completed, and whether the last row is."""
    return rows.groupBy(*SESSION).agg(F.coalesce(F.bool_or("is_session_completed"), F.lit(False)).alias("completed"), F.coalesce(F.max_by("is_session_completed", "step_id"), F.lit(False)).alias("on_last"))


#: Fold over a session's rows in step order. Of the live tails whose messages are a prefix of the row's, the longest is replaced by the row; if none is, the row begins a chain.
_TAILS = """transform(aggregate(array_sort(collect_list(struct(step_id, fps))), cast(array() as array<struct<fps:array<string>,step:int>>),
 (acc, x) -> concat(filter(acc, t -> not (slice(x.fps, 1, size(t.fps)) = t.fps and size(t.fps) = coalesce(array_max(transform(filter(acc, u -> slice(x.fps, 1, size(u.fps)) = u.fps), u -> size(u.fps))), -1))),
 array(struct(x.fps as fps, x.step_id as step)))), t -> t.step)"""


def chain_tails(rows: DataFrame) -> DataFrame:
    """(job_id, session_id, tails): the steps that end a message-prefix chain."""
    return rows.select(*SESSION, "step_id", F.coalesce(fingerprints(F.col("messages")), F.array().cast("array<string>")).alias("fps")).groupBy(*SESSION).agg(F.expr(_TAILS).alias("tails"))


def trainability(rows: DataFrame) -> DataFrame:
    """(job_id, session_id, selected, error, tails): gates and chains of each session in one aggregate.

    Gates come first: a session with a bad status is left alone, whatever else it holds; so is one never completed. A
    completed one whose last row does not say so is an error, and so are messages that are no array.
    """
    fps = F.coalesce(fingerprints(F.when(json_kind(F.col("messages")) == "ARRAY", F.col("messages"))), F.array().cast("array<string>"))
    marked = rows.select(*SESSION, "step_id", "is_session_completed", status_not_200(F.col("meta_json")).alias("bad"), fps.alias("fps"), (F.coalesce(json_kind(F.col("messages")), F.lit("")) != "ARRAY").alias("broken"))
    each = marked.groupBy(*SESSION).agg(F.bool_or("bad").alias("blocked"), F.coalesce(F.bool_or("is_session_completed"), F.lit(False)).alias("completed"), F.coalesce(F.max_by("is_session_completed", "step_id"), F.lit(False)).alias("on_last"), F.bool_or("broken").alias("broken"), F.expr(_TAILS).alias("tails"))
    passes = ~F.col("blocked") & F.col("completed")
    error = F.when(passes & ~F.col("on_last"), "completed flag is not on the final row").when(passes & F.col("broken"), "messages is not a JSON array")
    return each.select(*SESSION, (passes & error.isNull()).alias("selected"), error.alias("error"), "tails")


def trace_error(rows_id: str = "id") -> Column:
    """Why a trainable row's trace can't be built, or null."""
    fine = F.coalesce(json_kind(F.col("messages")) == "ARRAY", F.lit(False))
    return F.when(~fine, F.concat(F.col(rows_id), F.lit(": messages is not a JSON array"))).when(~F.coalesce(is_json(F.col("response")), F.lit(False)), F.concat(F.col(rows_id), F.lit(": response is not JSON")))
