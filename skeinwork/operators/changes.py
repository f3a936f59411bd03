"""Changes as DataFrames: upsert, conditional update, delete, differences, schema growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_blank, matches
from ..schema import PROTECTED


def upserted(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """target with source's rows in place of those of the same key, and new ones added."""
    return target.join(source.select(key), key, "left_anti").select(*target.columns).unionByName(source.select(*target.columns))


def check_upsert(source: DataFrame) -> None:
    """Blank job ids and keys that repeat within the batch are refused before anything is written."""
    bad = source.agg(F.count_if(is_blank(F.col("job_id"))).alias("blank"), (F.count("*") - F.count_distinct("id")).alias("twice")).first()
    if bad["blank"]:
        raise ValueError("blank job_id")
    if bad["twice"]:
        raise ValueError("an id occurs twice in the batch, or is null")


def check_updates(updates: dict, columns: list[str], required: list[str] | tuple[str, ...] = ()) -> None:
    """Refuses what can be known before a row is read: nothing to set, protected or unknown columns, null for a required one."""
    if not updates:
        raise ValueError("no updates")
    if held := sorted(set(updates) & set(PROTECTED)):
        raise ValueError(f"protected: {', '.join(held)}")
    if unknown := sorted(set(updates) - set(columns)):
        raise ValueError(f"unknown: {', '.join(unknown)}")
    if nulls := sorted(c for c in updates if updates[c] is None and c in required):
        raise ValueError(f"required: {', '.join(nulls)}")


def updated(df: DataFrame, where: Column, updates: dict, touched_ms: int | None = None) -> DataFrame:
    """df with the updates where the predicate is true (null is not), and source_updated_at set to touched_ms there."""
    check_updates(updates, df.columns)
    hit = matches(where)
    new = {c: F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in updates.items()}
    if touched_ms is not None:
        new["source_updated_at"] = F.when(hit, F.lit(touched_ms).cast("long")).otherwise(F.col("source_updated_at"))
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def deleted(df: DataFrame, where: Column) -> DataFrame:
    return df.where(~matches(where))


def needs_update(df: DataFrame, updates: dict) -> DataFrame:
    """The rows that an update would change at all (null equals null, NaN equals NaN)."""
    differs = F.lit(False)
    for c, v in updates.items():
        differs = differs | ~F.col(c).eqNullSafe(v if isinstance(v, Column) else F.lit(v).cast(df.schema[c].dataType))
    return df.where(differs)


def field_changes(before: DataFrame, after: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """(key, changed): names of the columns that differ, of the keys in both, where any does."""
    b, a = before.select(key, *columns), after.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    names = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in columns]))
    return b.join(a, key).select(key, names.alias("changed")).where(F.size("changed") > 0)


def table_differences(expected: DataFrame, actual: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """(key, state): missing, unexpected or different, from one full outer join."""
    a = expected.select(F.col(key).alias("__a"), F.struct(*columns).alias("__x"))
    b = actual.select(F.col(key).alias("__b"), F.struct(*columns).alias("__y"))
    state = F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "unexpected").when(~F.col("__x").eqNullSafe(F.col("__y")), "different")
    return a.join(b, F.col("__a") == F.col("__b"), "full_outer").select(F.coalesce("__a", "__b").alias(key), state.alias("state")).where("state is not null")


def grown(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with the columns it lacks, as nulls of the given types."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns])


def ingest_defaults(df: DataFrame, now_ms: int) -> DataFrame:
    """Fields derived at ingest: dt from created_at (seconds, UTC), source_updated_at, blob links; never a publish time.

    now_ms is one literal of the write, so that all its rows agree.
    """
    from ..functions.columns import day_of_seconds
    from ..functions.json import blob_links

    have = set(df.columns)
    get = lambda c, t: F.col(c) if c in have else F.lit(None).cast(t)
    payloads = [F.col(c) for c in ("messages", "response", "chosen_trace", "rejected_trace") if c in have]
    links = blob_links(*payloads) if payloads else F.array().cast("array<string>")
    old = get("blob_manifest", "array<string>")
    return df.withColumns(
        {
            "dt": F.coalesce(get("dt", "string"), day_of_seconds(F.col("created_at"))),
            "source_updated_at": F.coalesce(get("source_updated_at", "long"), F.lit(now_ms).cast("long")),
            "serving_updated_at": F.lit(None).cast("long"),
            "blob_manifest": F.when(F.coalesce(F.size(old), F.lit(0)) > 0, old).otherwise(links),
        }
    )
