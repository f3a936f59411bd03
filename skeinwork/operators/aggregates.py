"""Counts and statistics: tags, duplicates, partitions, runs, environment images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_blank


def tag_counts(df: DataFrame) -> DataFrame:
    """Rows per tag; null lists and empty tags do not count."""
    return df.select(F.explode("tags").alias("tag")).where("tag <> ''").groupBy("tag").agg(F.count("*").alias("n"))


def tag_shares(df: DataFrame, scan_limit: int | None = None) -> DataFrame:
    """Rows per tag (empty ones too) and their percentage of the rows that have a tag, most first.

    scan_limit is the report's own bound on rows looked at; none is the default.
    """
    rows = df.select("tags") if scan_limit is None else df.select("tags").limit(scan_limit)
    tagged = rows.where(F.size("tags") > 0)
    each = tagged.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    total = tagged.agg(F.count("*").alias("total"))
    return each.crossJoin(F.broadcast(total)).select("tag", "n", F.round(F.col("n") * 100.0 / F.col("total"), 2).alias("pct")).orderBy(F.desc("n"), "tag")


def duplicates(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, n) of keys that occur more than once; null and blank ones do not count."""
    return df.where(~is_blank(F.col(key))).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_summary(df: DataFrame, key: str = "id") -> DataFrame:
    """One row: rows scanned, duplicated keys, rows that carry them, rows beyond the first of each."""
    each = df.where(~is_blank(F.col(key))).groupBy(key).agg(F.count("*").alias("n"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_scanned"), F.count_if(F.col("n") > 1).alias("duplicate_ids"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_involved"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("extra_rows"))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def compare_counts(source: DataFrame, copy: DataFrame, key: str) -> DataFrame:
    """(key, source_n, copy_n, state): complete, missing or partial, by partition."""
    a = source.groupBy(key).agg(F.count("*").alias("source_n"))
    b = copy.groupBy(key).agg(F.count("*").alias("copy_n"))
    both = a.join(b, key, "full_outer").na.fill(0, ["source_n", "copy_n"])
    state = F.when(F.col("source_n") == F.col("copy_n"), "complete").when(F.col("copy_n") == 0, "missing").otherwise("partial")
    return both.withColumn("state", state)


def latest_image(env: DataFrame) -> DataFrame:
    """By env_name: the image of the greatest id that has one; null if none has."""
    return env.where("env_name is not null").groupBy("env_name").agg(F.max_by("image", F.when(F.col("image") != "", F.col("id"))).alias("image"))


def first_env_of_image(env: DataFrame) -> DataFrame:
    """By trimmed image: the trimmed env_name of the least id; blank ones do not count."""
    t = env.select("id", F.trim("image").alias("image"), F.trim("env_name").alias("env_name")).where("image <> '' and env_name <> ''")
    return t.groupBy("image").agg(F.min_by("env_name", "id").alias("env_name"))


def next_id(env: DataFrame) -> DataFrame:
    return env.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("next_id"))


def run_summary(sessions: DataFrame) -> DataFrame:
    """One row of counters over per-session results (rows_read, rows_written, error); sums and counts merge over runs."""
    return sessions.agg(
        F.count("*").alias("sessions"),
        F.coalesce(F.sum("rows_read"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written"),
        F.count_if(F.col("error").isNotNull()).alias("failures"),
        F.array_sort(F.collect_set("error")).alias("errors"),
    )


def merge_summaries(a: dict, b: dict) -> dict:
    """Counters add up, sets unite; only runs of one pipeline merge."""
    if a.get("pipeline") != b.get("pipeline"):
        raise ValueError("summaries of different pipelines")
    out = {k: a[k] + b[k] for k in ("sessions", "rows_read", "rows_written", "failures")}
    return out | {"pipeline": a.get("pipeline"), "errors": sorted(set(a["errors"]) | set(b["errors"]))}


def condition_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
