"""Record tables of Spark's catalog: Parquet, partitioned by a hash bucket of the job, changed by dynamic partition overwrite.

A table is created by CREATE TABLE, read by its name and pruned by its partitions; which column decides a row's bucket,
how many buckets there are and which columns are required are table properties. Changes rewrite only the buckets they
touch: Spark writes their new files aside and moves them in when all tasks are done. A plain catalog table has no
snapshots: a reader that began before a change may have to begin again, and a writer should be alone on a bucket.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import bucket, bucket_of, is_blank, matches
from ..operators import changes
from ..schema import BUCKETS
from .files import Folder
from .pruning import pinned_buckets

_REFUSED = "refused: "
_OWN = "skeinwork."


class Exists(RuntimeError):
    """A table of this name, or a claim on these ids, is there already."""


def _predicate(where: str | Column) -> Column:
    if isinstance(where, Column):
        return where
    if not where or not where.strip():
        raise ValueError("a filter is required")
    return F.expr(where)


def _pairs(values: dict[str, str]) -> str:
    return ", ".join("'{}'='{}'".format(k, str(v).replace("\\", "\\\\").replace("'", "\\'")) for k, v in values.items())


def _bloom(column: str) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{column}": "true"}


def _observed(seen: Observation) -> int:
    """What an observation counted. Where the optimiser knew that there were no rows, it took the observation away with them."""
    return seen.get["n"] if seen._jo.get().size() else 0


class Table:
    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name
        if not spark.catalog.tableExists(name):
            raise FileNotFoundError(f"no table {name}")
        fixed = self.properties()  # these are given when the table is made, and never change
        self.key: str | None = fixed.get("key") or None
        self.buckets = int(fixed.get("buckets", 0))
        self.required = {c for c in fixed.get("required", "").split(",") if c}

    # catalog

    @classmethod
    def create(cls, spark: SparkSession, name: str, schema: T.StructType, path: str | None = None, key: str | None = "job_id", buckets: int = BUCKETS, indexes: dict | None = None) -> Table:
        """A new, empty table; at path if it is given, else where the database keeps its tables.

        Columns to look rows up by (BTREE) get bloom filters in every file; the other kinds need nothing beside min and max.
        """
        if spark.catalog.tableExists(name):
            raise Exists(f"{name} exists")
        indexes = indexes or {}
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        options = {"compression": "zstd", "partitionOverwriteMode": "dynamic"} | {k: v for c, kind in indexes.items() if kind == "BTREE" for k, v in _bloom(c).items()}
        own = {"key": key or "", "buckets": buckets if key else 1, "required": ",".join(f.name for f in schema if not f.nullable)} | {f"index.{c}": k for c, k in indexes.items()}
        location = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE {name} ({columns}, bucket BIGINT) USING parquet OPTIONS ({_pairs(options)}) PARTITIONED BY (bucket){location} TBLPROPERTIES ({_pairs({_OWN + k: v for k, v in own.items()})})")
        return cls(spark, name)

    def like(self, name: str) -> Table:
        """A new, empty table with this one's columns and properties."""
        return Table.create(self.spark, name, self.schema(), key=self.key, buckets=self.buckets, indexes=self.indexes)

    def properties(self) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return {r["key"].removeprefix(_OWN): r["value"] for r in rows if r["key"].startswith(_OWN)}

    @property
    def indexes(self) -> dict[str, str]:
        return {k.removeprefix("index."): v for k, v in self.properties().items() if k.startswith("index.")}

    @property
    def location(self) -> str:
        return json.loads(self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} AS JSON").first()[0])["location"]

    def schema(self) -> T.StructType:
        """The columns without `bucket`; required ones are not nullable."""
        return T.StructType([T.StructField(f.name, f.dataType, f.name not in self.required) for f in self.spark.table(self.name).schema if f.name != "bucket"])

    def partitions(self) -> list[int]:
        return sorted(int(r[0].rpartition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect())

    def add_columns(self, columns: dict[str, str]) -> list[str]:
        """Nullable columns that are not there yet; rows written before read null."""
        have = {c.lower() for c in self.spark.table(self.name).columns}
        new = {c: t for c, t in columns.items() if c.lower() not in have}
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in new.items())})")
        return list(new)

    def set_index(self, column: str, kind: str) -> None:
        """A layout hint that later writes and compactions follow."""
        if kind not in ("BTREE", "BITMAP", "LABEL_LIST") or column not in self.schema().fieldNames():
            raise ValueError(f"{kind} on {column}")
        if kind == "BTREE":
            self.spark.sql(f"ALTER TABLE {self.name} SET SERDEPROPERTIES ({_pairs(_bloom(column))})")
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({_pairs({f'{_OWN}index.{column}': kind})})")

    def missing_indexes(self, expected: dict[str, str]) -> list[str]:
        return sorted(set(expected) - set(self.indexes))

    def drop_bucket(self, b: int) -> None:
        """Gone from the catalog and, for a table at a path of its own too, from the store."""
        where = self.location
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (bucket={b})")
        Folder(self.spark, where).delete(f"bucket={b}")

    def drop(self) -> None:
        where = self.location
        self.spark.sql(f"DROP TABLE {self.name}")
        Folder(self.spark, where).delete("")

    def rename(self, name: str) -> Table:
        self.spark.sql(f"ALTER TABLE {self.name} RENAME TO {name}")
        return Table(self.spark, name)

    def describe(self) -> dict:
        return {"key": self.key, "buckets": self.buckets, "existing": self.partitions(), "indexes": self.indexes, "schema": self.schema().simpleString()}

    # reads

    def read(self, buckets: list[int] | None = None, where: str | Column | None = None, latest: bool = True) -> DataFrame:
        """All columns and `bucket`, of given buckets or of those that a filter's job_id pins; no other is listed.

        latest also sees what other sessions wrote; without it Spark may use the listing it has.
        """
        if latest:
            self.spark.catalog.refreshTable(self.name)
        df = self.spark.table(self.name)
        if where is not None and not (isinstance(where, str) and not where.strip()):
            df = df.where(where)
            if buckets is None and self.key:
                buckets = pinned_buckets(df, self.key, self.buckets)
        return df if buckets is None else df.where(F.col("bucket").isin([int(b) for b in buckets]))

    def read_job(self, job_id: str, latest: bool = True) -> DataFrame:
        """One job's rows: its bucket alone is listed, other jobs of the bucket are filtered out."""
        return self.read([bucket_of(job_id, self.buckets)], latest=latest).where(F.col("job_id") == job_id)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets of the jobs in keys; as many as there are buckets at most."""
        return sorted(r[0] for r in keys.select(bucket(F.col("job_id"), self.buckets)).distinct().collect())

    def count(self, where: str | Column | None = None) -> int:
        return self.read(where=where).count()

    # writes

    def _fit(self, df: DataFrame) -> DataFrame:
        """Exactly the table's columns and types, and the row's bucket. What is lacking is null, NaN in a whole number's
        place is null, and what a table must not hold ends the write: null in a required column, a blank id."""
        kinds = {f.name: f.dataType for f in df.schema}
        columns = []
        for f in self.schema():
            c = F.col(f"`{f.name}`") if f.name in kinds else F.lit(None)
            if isinstance(kinds.get(f.name), T.FractionalType) and not isinstance(kinds[f.name], T.DecimalType) and isinstance(f.dataType, T.IntegralType):
                c = F.when(~F.isnan(c), c)
            c = c.cast(f.dataType)
            if not f.nullable:
                c = F.coalesce(c, F.raise_error(F.lit(f"{_REFUSED}null in {f.name}")).cast(f.dataType))
            if f.name == "id" and isinstance(f.dataType, T.StringType):
                c = F.when(is_blank(c), F.raise_error(F.lit(f"{_REFUSED}blank id")).cast("string")).otherwise(c)
            columns.append(c.alias(f.name))
        out = df.select(*columns)
        return out.withColumn("bucket", bucket(F.col(self.key), self.buckets) if self.key else F.lit(0).cast("long"))

    def _write(self, fitted: DataFrame, replace: bool) -> int:
        """Rows written. A bucket's rows meet in as many tasks as their size asks for, and files are sorted by id, so
        that their min and max let lookups skip them."""
        seen = Observation()
        out = fitted.select(*self.spark.table(self.name).columns).observe(seen, F.count(F.lit(1)).alias("n"))
        out = out.hint("rebalance", "bucket").sortWithinPartitions("bucket", *(["id"] if "id" in out.columns else []))
        try:
            out.write.mode("overwrite" if replace else "append").insertInto(self.name)
        except Exception as e:
            if said := re.search(_REFUSED + r"([^\n]*?)(?: SQLSTATE|\n|$)", str(e)):
                raise ValueError(said[1]) from None
            raise
        return _observed(seen)

    def append(self, df: DataFrame, now_ms: int | None = None, publish: bool = False) -> int:
        """Add rows and say how many. Landing rows never carry a publish time, published ones get now_ms."""
        if now_ms is not None:
            df = df.withColumn("serving_updated_at", F.lit(now_ms).cast("long")) if publish else changes.ingest_defaults(df, now_ms)
        return self._write(self._fit(df), replace=False)

    def upsert(self, source: DataFrame, now_ms: int, everywhere: bool = True) -> int:
        """Replace or add whole rows by id. An id is looked for in every bucket, by its id column alone; where jobs never
        change (`everywhere=False`), the buckets of the batch's jobs do."""
        changes.check_upsert(source)
        fresh = self._fit(source.withColumn("serving_updated_at", F.lit(now_ms).cast("long"))).persist()
        try:
            touched = {r[0] for r in fresh.select("bucket").distinct().collect()}  # at most as many as buckets
            if not touched:
                return 0
            if everywhere:
                moved = self.read().select("id", "bucket").join(fresh.select("id"), "id", "left_semi")
                touched |= {r[0] for r in moved.select("bucket").distinct().collect()}
            old = self.read(sorted(touched))
            emptied = touched - {r[0] for r in changes.upserted(old.select("id", "bucket"), fresh.select("id", "bucket")).select("bucket").distinct().collect()} if everywhere else set()
            n = fresh.count()
            self._write(self._fit(changes.upserted(old, fresh)), replace=True)
            for b in emptied:
                self.drop_bucket(b)
            return n
        finally:
            fresh.unpersist()

    def patch(self, patches: DataFrame, columns: tuple[str, ...], now_ms: int) -> int:
        """Set `columns` of the rows that patches (id, job_id, columns...) name, and their source_updated_at.

        A patch may set null: that a row has one decides, not its values. Only buckets with patches are written again.
        """
        fresh = patches.select(F.col("id").alias("__id"), bucket(F.col("job_id"), self.buckets).alias("__bucket"), *[F.col(c).alias(f"__{c}") for c in columns]).persist()
        try:
            touched = [r[0] for r in fresh.select("__bucket").distinct().collect()]
            if not touched:
                return 0
            old = self.read(touched)
            both = old.join(fresh, F.col("id") == F.col("__id"), "left")
            hit = F.col("__id").isNotNull()
            new = {c: F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)) for c in columns} | {"source_updated_at": F.when(hit, F.lit(now_ms).cast("long")).otherwise(F.col("source_updated_at"))}
            seen = Observation()
            out = both.observe(seen, F.count_if(hit).alias("n")).select(*[new[c].alias(c) if c in new else F.col(c) for c in old.columns])
            self._write(self._fit(out), replace=True)
            return _observed(seen)
        finally:
            fresh.unpersist()

    def _matching(self, where: Column) -> dict[int, int]:
        """Rows that match, by bucket; where the filter pins jobs, only their buckets are looked at."""
        return {r["bucket"]: r["count"] for r in self.read(where=where).groupBy("bucket").count().collect()}

    def update(self, where: str | Column, values: dict, now_ms: int | None = None) -> int:
        """Patch the rows that match and say how many; which buckets hold any is found first, and only those are written again."""
        pred = _predicate(where)
        schema = self.schema()
        changes.check_updates(values, schema.fieldNames(), [f.name for f in schema if not f.nullable])
        found = self._matching(pred)
        if found:
            self._write(self._fit(changes.updated(self.read(sorted(found)), pred, values, now_ms)), replace=True)
        return sum(found.values())

    def delete(self, where: str | Column) -> int:
        """Rows deleted. A null predicate keeps its row; an error is raised, never swallowed."""
        pred = _predicate(where)
        found = self._matching(pred)
        if found:
            held = {r["bucket"]: r["count"] for r in self.read(sorted(found)).groupBy("bucket").count().collect()}
            if left := sorted(b for b in found if held[b] > found[b]):
                self._write(self._fit(changes.deleted(self.read(left), matches(pred))), replace=True)
            for b in sorted(set(found) - set(left)):
                self.drop_bucket(b)
        return sum(found.values())

    # maintenance

    def files(self) -> dict[int, int]:
        """Files of each bucket."""
        out: dict[int, int] = {}
        for f in self.read().inputFiles():
            b = int(re.search(r"/bucket=(\d+)/", f)[1])
            out[b] = out.get(b, 0) + 1
        return out

    def compact(self, buckets: list[int] | None = None) -> dict:
        """Write buckets again, sorted by id and in as few files as their size asks for; a summary with what was done."""
        before = self.files()
        wanted = sorted(b for b in before if buckets is None or b in buckets)
        if wanted:
            self._write(self._fit(self.read(wanted)), replace=True)
        after = self.files()
        return {"buckets": wanted, "files_before": sum(before[b] for b in wanted), "files_after": sum(after.get(b, 0) for b in wanted), "errors": [f"bucket {b} does not exist" for b in sorted(set(buckets or []) - set(wanted))]}


def list_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """The record tables of a database."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    return [n for n in names if Table(spark, f"{database}.{n}").buckets]


def repartitioned(source: DataFrame, target: Table, drop_blank: bool = True, days: list[str] | None = None) -> dict:
    """Lay a day-partitioned source out anew in a hash-bucketed table: old type names mapped, blank jobs dropped (or refused).

    All is written to a table aside first; its schema and its counts by type are compared with the source's, and only
    then it takes the target's name. What had that name stays as a backup. If anything fails before, the target is as it was.
    """
    rows = source if days is None else source.where(F.col("dt").isin(days))
    kind = F.when(F.col("dataset_type") == "Test", "RL").otherwise(F.col("dataset_type"))
    blank = is_blank(F.col("job_id"))
    counts = {r["k"]: (r["kept"], r["dropped"]) for r in rows.groupBy(kind.alias("k")).agg(F.count_if(~blank).alias("kept"), F.count_if(blank).alias("dropped")).collect()}  # a row for each type
    dropped = sum(d for _, d in counts.values())
    if dropped and not drop_blank:
        raise ValueError(f"{dropped} rows have no job_id")
    aside = target.like(f"{target.name}__staging_{uuid.uuid4().hex[:8]}")
    try:
        aside.append(rows.where(~blank).withColumn("dataset_type", kind))
        got = {r["dataset_type"]: r["count"] for r in aside.read().groupBy("dataset_type").count().collect()}
        want = {k: n for k, (n, _) in counts.items() if n}
        if got != want or aside.schema() != target.schema():
            raise RuntimeError(f"wrote {got}, not {want}")
    except Exception:
        aside.drop()
        raise
    name, backup = target.name, f"{target.name}__backup_{time.time_ns() // 10**6}"
    target.rename(backup)
    aside.rename(name)
    return {"rows": sum(got.values()), "dropped": dropped, "types": got, "backup": backup}


def archive(source: DataFrame, path: str, key: str = "dt") -> list[dict]:
    """Copy a table partition by partition to Parquet at path: complete partitions are skipped, partial ones refused, and
    so is a copy of other columns.

    One aggregate finds what is missing and one write copies all of it; a second aggregate verifies.
    """
    from ..operators.aggregates import compare_counts

    spark = source.sparkSession
    folder = Folder(spark, path)
    there = any(n.startswith(f"{key}=") for n in folder.names())
    if there:
        held = {f.name: f.dataType for f in spark.read.parquet(path).schema}
        if odd := sorted(f.name for f in source.schema if f.name != key and held.get(f.name) != f.dataType) + sorted(set(held) - set(source.columns)):
            raise RuntimeError(f"the copy's columns differ: {odd}")
    copy = spark.read.schema(source.schema).parquet(path) if there else spark.createDataFrame([], source.schema)
    state = compare_counts(source, copy, key).collect()  # a row for each partition
    if partial := [r[key] for r in state if r["state"] == "partial"]:
        raise RuntimeError(f"partial: {partial}")
    missing = [r[key] for r in state if r["state"] == "missing"]
    if missing:
        source.where(F.col(key).isin(missing)).repartition(key).write.mode("append").partitionBy(key).parquet(path)
    done = compare_counts(source, spark.read.schema(source.schema).parquet(path), key)
    return [r.asDict() for r in done.orderBy(key).collect()]
