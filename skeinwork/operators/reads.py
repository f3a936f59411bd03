"""Reads over record tables: filter, page, search, look up, count, export."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import contains_any, has_tags
from ..functions.json import decoded
from ..schema import JSON_COLUMNS
from ..sources.files import Kept


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None or (isinstance(where, str) and not where.strip()):
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)


def read(df: DataFrame, where: str | Column | None = None, columns: list[str] | None = None, order_by: str | None = None, ascending: bool = True, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Filter, sort, cut and project. The order is global, ties go by id; filters and columns reach the scan."""
    out = _where(df, where)
    if order_by:
        tie = [F.col("id")] if "id" in df.columns and order_by != "id" else []
        out = out.orderBy(F.col(order_by).asc() if ascending else F.col(order_by).desc(), *tie)
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out.select(*columns) if columns else out


def by_id(df: DataFrame, record_id: str) -> DataFrame:
    return df.where(F.col("id") == record_id).limit(1)


def search(df: DataFrame, phrase: str = "", tags: list[str] | None = None, where: str | None = None, fields: list[str] | None = None, limit: int | None = 10) -> DataFrame:
    """Rows that hold the phrase literally in any field, all tags, and the predicate; in id order."""
    fields = fields or ["search_text"]
    kinds = dict(df.dtypes)
    for f in fields:
        if f in JSON_COLUMNS or kinds.get(f) != "string":
            raise ValueError(f"{f} is not a plain text column")
    if not isinstance(phrase, str):
        raise NotImplementedError("vector search")
    out = _where(df, where)
    if phrase:
        out = out.where(contains_any(phrase, fields))
    if tags:
        out = out.where(has_tags(tags))
    out = out.orderBy("id")
    return out if limit is None else out.limit(limit)


def in_range(start: int | None, end: int | None, column: str = "created_at") -> Column:
    """Both ends inclusive; a day bound on dt follows for tables that are laid out by day."""
    out = F.lit(True)
    if start is not None:
        out = out & (F.col(column) >= start)
    if end is not None:
        out = out & (F.col(column) <= end)
    return out


def page(df: DataFrame, after: tuple | None = None, limit: int = 10_000, strict: bool = False, **bounds) -> DataFrame:
    """One page in (created_at, id) order after a cursor.

    strict compares created_at alone, as a cursor of one column must, and so loses ties across pages; otherwise the
    cursor is (created_at, id) and loses nothing.
    """
    out = df.where(in_range(bounds.get("start"), bounds.get("end")))
    out = _where(out, bounds.get("where"))
    if after is not None:
        at, last = after if isinstance(after, tuple) else (after, None)
        later = F.col("created_at") > at
        out = out.where(later if strict or last is None else later | ((F.col("created_at") == at) & (F.col("id") > last)))
    return out.orderBy("created_at", "id").limit(limit)


def cursor(page_of: DataFrame) -> DataFrame:
    """The cursor after a page: its last (created_at, id); no row for an empty page."""
    return page_of.agg(F.max(F.struct("created_at", "id")).alias("m")).where("m is not null").select("m.created_at", "m.id")


def pages(df: DataFrame, size: int = 10_000, **bounds) -> Iterator[DataFrame]:
    """All pages in (created_at, id) order, of the rows as they are when the first is asked for.

    The rows are read once, to a copy laid out by ranges of the order, and a page is a part of one or few ranges; only
    the pages' numbers come to the driver, one after the other. Repeated rows and nulls are on one page each, as they
    come. page() reads one page of a live table.
    """
    if size < 1:
        raise ValueError("size must be positive")
    rows = _where(df.where(in_range(bounds.get("start"), bounds.get("end"))), bounds.get("where"))
    held = [Kept(in_ranges(rows, "created_at", "id"), "pages")]
    try:
        held.append(Kept(_numbered(held[0].rows, size, ("created_at", "id")), "numbered-pages"))
        numbered = held[1].rows
        for b in numbered.groupBy("batch").agg(F.min("part").alias("a"), F.max("part").alias("b")).orderBy("batch").toLocalIterator():
            yield numbered.where(F.col("part").between(b["a"], b["b"]) & (F.col("batch") == b["batch"])).orderBy("created_at", "id").drop("part", "batch")
    finally:
        for h in held:
            h.release()


def latest(df: DataFrame, where: str | None = None) -> DataFrame:
    """The row of greatest created_at (then least id); none for an empty table. A top-1, never a full sort."""
    return _where(df, where).orderBy(F.desc("created_at"), "id").limit(1)


def in_ranges(df: DataFrame, *order: str, parts: int | None = None) -> DataFrame:
    """df with `part`: ranges of the order, each sorted; however many rows a value has, ranges are alike if the order tells rows apart.

    Where ranges begin is sampled anew whenever Spark runs this, so write it before more than one thing is read from it.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def _numbered(ranged: DataFrame, size: int, order: tuple[str, ...], within: tuple[str, ...] = ()) -> DataFrame:
    """ranged with `batch`: a row's rank, which is its rank in its range and what earlier ranges hold, over size."""
    counts = ranged.groupBy(*within, "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each range
    before = counts.select(*within, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy(*within, "part").orderBy(*order)) - 1
    return ranged.join(before, [*within, "part"]).withColumn("batch", F.floor((F.col("__before") + rank) / size)).drop("__before")


def range_bounds(ranged: DataFrame, size: int, order: tuple[str, ...], within: tuple[str, ...] = ()) -> DataFrame:
    """(within..., batch, n, first, last, first_part, last_part) of successive batches of `size` rows of a table of in_ranges."""
    if size < 1:
        raise ValueError("the size must be positive")
    keys = _numbered(ranged.select(*within, "part", *order), size, order, within)
    return keys.groupBy(*within, "batch").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last"), F.min("part").alias("first_part"), F.max("part").alias("last_part"))


def page_numbers(df: DataFrame, size: int, parts: int | None = None) -> DataFrame:
    """Each row's page in (created_at, id) order, without one task seeing all rows."""
    ranged = Kept(in_ranges(df, "created_at", "id", parts=parts), "numbered-pages").rows
    return _numbered(ranged, size, ("created_at", "id")).withColumnRenamed("batch", "page").drop("part")


def export_manifest(df: DataFrame, batch_size: int) -> DataFrame:
    """(bucket, id, batch): batches in id order that never cross a bucket."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    w = Window.partitionBy("bucket").orderBy("id")
    return df.select("bucket", "id", F.floor((F.row_number().over(w) - 1) / batch_size).cast("int").alias("batch"))


def check_exportable(df: DataFrame) -> None:
    """Raises before anything is exported if an id is null or not unique."""
    nulls = df.where(F.col("id").isNull()).limit(1).count()
    twice = df.where(F.col("id").isNotNull()).groupBy("id").count().where("count > 1").limit(1).collect()
    if nulls or twice:
        raise RuntimeError("null id" if nulls else f"id {twice[0]['id']} is not unique")


def export_bounds(ranged: DataFrame, batch_size: int) -> DataFrame:
    """(bucket, batch, n, first_id, last_id, first_part, last_part) of the batches of a table of in_ranges(bucket, id):
    in id order, and never over two buckets. No task sees a whole bucket."""
    return range_bounds(ranged, batch_size, ("id",), ("bucket",)).select("bucket", F.col("batch").cast("int").alias("batch"), "n", F.col("first.id").alias("first_id"), F.col("last.id").alias("last_id"), "first_part", "last_part")


def export_batches(df: DataFrame, batch_size: int = 10_000, columns: list[str] | None = None, parse_json: bool = False) -> Iterator[DataFrame]:
    """Each batch as a DataFrame with its rows in id order; `export` on it says which it is and how many rows all have.

    The rows are read once, to a copy that stays as it is until the iterator ends. Null or repeated ids are refused before
    anything is given out. The copy is laid out by ranges of (bucket, id), so that a batch is a range of ids in one or
    few files, and its rows are counted before it is given out. JSON columns come as Variant if asked for.
    """
    if isinstance(batch_size, bool) or not isinstance(batch_size, int) or batch_size < 1:
        raise ValueError("batch_size must be a positive integer")
    if columns is not None and not columns:
        raise ValueError("columns is empty")
    held = []
    try:
        copy = Kept(df.select(*dict.fromkeys(["bucket", "id", *(columns or df.columns)])), "export-copy")
        held.append(copy)
        check_exportable(copy.rows)
        total = copy.rows.count()
        ranged = Kept(in_ranges(copy.rows, "bucket", "id"), "export-ranges")
        held.append(ranged)
        bounds = Kept(export_bounds(ranged.rows, batch_size).orderBy("bucket", "batch"), "export-bounds")
        held.append(bounds)
        for b in bounds.rows.orderBy("bucket", "batch").toLocalIterator():
            inside = F.col("part").between(b["first_part"], b["last_part"]) & (F.col("bucket") == b["bucket"]) & F.col("id").between(b["first_id"], b["last_id"])
            got = ranged.rows.where(inside)
            if (n := got.count()) != b["n"]:
                raise RuntimeError(f"bucket {b['bucket']}, batch {b['batch']}: {n} of {b['n']} rows")
            out = got.orderBy("id").select(*[decoded(F.col(c)).alias(c) if parse_json and c in JSON_COLUMNS else F.col(c) for c in columns or df.columns])
            out.export = {"bucket": b["bucket"], "batch": b["batch"], "rows": n, "manifest_rows": total}
            yield out
    finally:
        for h in held:
            h.release()


def export_differences(manifest: DataFrame, returned: DataFrame) -> DataFrame:
    """(id, side) of ids that only one of the two has."""
    return manifest.select("id").exceptAll(returned.select("id")).withColumn("side", F.lit("missing")).unionByName(returned.select("id").exceptAll(manifest.select("id")).withColumn("side", F.lit("unexpected")))
