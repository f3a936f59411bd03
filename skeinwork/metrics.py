"""Timings, rows and bytes of actions as JSON lines; what can't be written is let go, for a metric must never fail a run."""

from __future__ import annotations

import contextlib
import json
import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE = T.StructType([T.StructField("ts", T.DoubleType()), T.StructField("api", T.StringType()), T.StructField("elapsed_ms", T.DoubleType()), T.StructField("rows", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("error", T.StringType())])


def _width(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(c)
    if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
        return F.octet_length(F.array_join(c, ""))
    return F.when(c.isNotNull(), {T.BooleanType: 1, T.IntegerType: 4, T.FloatType: 4}.get(type(f.dataType), 8))


def watched(df: DataFrame, seen: dict) -> DataFrame:
    """df, whose first action inside timed() also counts its rows and the bytes of their values; nothing is run twice for it."""
    seen["watch"] = Observation()
    size = sum((F.coalesce(_width(f).cast("long"), F.lit(0)) for f in df.schema), F.lit(0).cast("long"))
    return df.observe(seen["watch"], F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))


@contextlib.contextmanager
def timed(api: str, path: str | None = None) -> Iterator[dict]:
    """Time the block. It may put `rows` and `bytes` into the dict it gets, or act on a DataFrame of watched(). Appends one line to path, if given."""
    seen: dict = {"api": api, "rows": None, "bytes": None, "error": None}
    began = time.perf_counter()
    try:
        yield seen
        if "watch" in seen:
            seen |= seen["watch"].get
    except Exception as e:
        seen["error"] = type(e).__name__
        raise
    finally:
        seen |= {"ts": time.time(), "elapsed_ms": (time.perf_counter() - began) * 1000}
        seen.pop("watch", None)
        for what, rate, unit in (("rows", "rows_per_s", 1), ("bytes", "mb_per_s", 1e6)):
            if seen[what] is not None and seen["elapsed_ms"]:
                seen[rate] = seen[what] / unit / seen["elapsed_ms"] * 1000
        if path:
            with contextlib.suppress(OSError), open(path, "a") as f:
                f.write(json.dumps(seen) + "\n")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """(api, calls, errors, seconds, rows, bytes, mb_per_s) over the lines of a metrics file, and a row for all of them (api null)."""
    lines = spark.read.schema(LINE).json(path)
    seconds = F.sum("elapsed_ms") / 1000
    return lines.rollup("api").agg(F.count("*").alias("calls"), F.count("error").alias("errors"), seconds.alias("seconds"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.try_divide(F.sum("bytes") / 1e6, seconds).alias("mb_per_s"))
