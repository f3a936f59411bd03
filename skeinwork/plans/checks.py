"""Checks of whole tables: a round trip through a new table, copies for fixtures, gates before a rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import with_member
from ..operators.aggregates import counts_by
from ..operators.changes import table_differences
from ..sources.store import Table


def fixture_copy(rows: DataFrame, suffix: str, n: int | None = None) -> DataFrame:
    """Rows under new ids, jobs and sessions, marked in meta_json; n bounds the fixture."""
    some = rows if n is None else rows.orderBy("id").limit(n)
    marker = F.to_json(F.struct(F.col("id").alias("copied_from")))
    return some.withColumns({"meta_json": with_member(F.col("meta_json"), "fixture", marker), **{c: F.concat(F.col(c), F.lit(suffix)) for c in ("id", "job_id", "session_id")}})


def smoke_test(source: DataFrame, target: Table, n: int = 10) -> dict:
    """Write n rows of one job under new ids into an empty table, read each back, delete them, and find nothing left."""
    if target.count():
        raise RuntimeError("the target is not empty")
    job = counts_by(source.where("job_id is not null"), "job_id").where(F.col("n") >= n).orderBy("job_id").first()
    if job is None:
        raise RuntimeError(f"no job has {n} rows")
    copies = fixture_copy(source.where(F.col("job_id") == job["job_id"]), "-smoke", n)
    written = [r["id"] for r in copies.select("id").collect()]  # n of them
    target.append(copies)
    name = f"{job['job_id']}-smoke"
    seen = {r["id"] for r in target.read_job(name).select("id").collect()}
    gone = target.delete("id like '%-smoke'")
    left = target.count()
    if seen != set(written) or gone != len(written) or left:
        raise RuntimeError(f"wrote {len(written)}, read {len(seen)}, deleted {gone}, left {left}")
    return {"job_id": name, "rows": len(written)}


def ready_to_rebuild(table: Table, archive: DataFrame, schema: T.StructType, buckets: int) -> list[str]:
    """Why a table may not be dropped and made anew after it was archived; empty if it may."""
    why, own = [], table.schema()
    if own != schema:
        why.append("schema differs")
    if table.buckets != buckets:
        why.append(f"{table.buckets} buckets, not {buckets}")
    held = {f.name: f.dataType for f in archive.schema}
    if odd := sorted(f.name for f in own if held.get(f.name) != f.dataType):
        why.append(f"the archive lacks {', '.join(odd)}")
    have, kept = table.count(), archive.count()
    if have != kept:
        why.append(f"{have} rows, {kept} in the archive")
    elif not odd and not table_differences(table.read(), archive, [c for c in own.fieldNames() if c != "id"]).isEmpty():
        why.append("rows differ")
    return why


def rebuilt(table: Table, archive: DataFrame, schema: T.StructType, buckets: int) -> Table:
    """The table emptied and made anew, if the archive holds all of it; refused on any difference, and then left as it is."""
    if why := ready_to_rebuild(table, archive, schema, buckets):
        raise RuntimeError("; ".join(why))
    empty = table.like(f"{table.name}__empty")
    table.drop()
    return empty.rename(table.name)
