"""Command line: query, count, tags, duplicates, undecodable, update, delete, maintain, describe, create, tables, drop, run."""

from __future__ import annotations

import argparse
import json
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Workspace, settings
from .functions.columns import bucket_of
from .functions.json import decoded, is_json, json_rows
from .metrics import timed, watched
from .operators import aggregates, changes, reads
from .plans.engine import now_ms, unserved
from .plans.pipeline import LANDING_ENRICHMENT, LANDING_TO_SERVING, pipeline
from .schema import JSON_COLUMNS, LANDING_INDEXES, RECORD, REQUIRED
from .sources.files import Folder
from .sources.store import list_tables


def parse_time(text: str) -> int:
    """Epoch milliseconds from digits (10**10 and more are milliseconds) or an ISO time (UTC if it says nothing)."""
    import pandas as pd

    unit = "s" if len(text) <= 10 else "ms"
    return pd.to_datetime(int(text), unit=unit).value // 10**6 if text.isdecimal() else pd.to_datetime(text, utc=True).value // 10**6


def safe_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", text).strip("_")


def expanded(df: DataFrame) -> DataFrame:
    """JSON columns decoded; malformed values stay strings, null fields go when rows become JSON."""
    return df.select(*[decoded(F.col(c)).alias(c) if c in JSON_COLUMNS else F.col(c) for c in df.columns])


def undecodable(df: DataFrame) -> DataFrame:
    """One row: for each JSON column, how many values are there but are no JSON."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & ~is_json(F.col(c))).alias(c) for c in JSON_COLUMNS if c in df.columns])


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skeinwork")
    p.add_argument("--profile", default="test")
    p.add_argument("--allow-production", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *extra: tuple) -> None:
        s = sub.add_parser(name)
        s.add_argument("--table", default=None)
        for flags, options in extra:
            s.add_argument(*flags, **options)

    where = (("--where",), {"default": ""})
    yes = (("--yes",), {"action": "store_true"})
    add("create")
    add("describe")
    add("query", where, (("--columns",), {"default": ""}), (("--limit",), {"type": int, "default": 20}), (("--order-by",), {}), (("--output",), {}))
    add("count", where)
    add("tags", (("--scan-limit",), {"type": int}))
    add("duplicates", (("--top",), {"type": int, "default": 20}))
    add("undecodable", where)
    add("update", where, (("--set",), {"required": True, "help": "JSON object"}), yes)
    add("delete", where, yes)
    add("maintain", (("--bucket",), {"action": "append", "default": [], "help": "a number or a job id; all, if none is given"}), (("--no-create-missing",), {"action": "store_true"}), (("--no-compact",), {"action": "store_true"}))
    add("drop", (("--bucket",), {"type": int}), (("--confirm",), {"required": True, "help": "the table's name once more"}))
    sub.add_parser("tables")
    run = sub.add_parser("run")
    run.add_argument("--pipeline", action="append")
    run.add_argument("--start-from")
    run.add_argument("--from", dest="since")
    run.add_argument("--to")
    run.add_argument("--filter")
    run.add_argument("--jobs", nargs="*")
    run.add_argument("--session", nargs=2, action="append", metavar=("JOB_ID", "SESSION_ID"))
    run.add_argument("--buckets", type=int, nargs="*", help="an incremental run of these alone")
    run.add_argument("--settle-delay-ms", type=int, default=0)
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("--report-dir")
    return p


def _run(w: Workspace, a: argparse.Namespace) -> int:
    if w.config.production and not (a.allow_production or a.dry_run):
        raise SystemExit("--allow-production is required to write there")
    modes = sum(map(bool, (a.since or a.to, a.filter, a.jobs, a.session)))
    if modes > 1 or bool(a.since) != bool(a.to) or (modes and (a.buckets or a.start_from or a.settle_delay_ms)):
        raise SystemExit("choose one of --from with --to, --filter, --jobs, --session, or none of these for an incremental run, which alone takes --buckets, --start-from and --settle-delay-ms")
    engine, bad, dirty, served = w.engine(), 0, None, None
    for name in a.pipeline or [LANDING_ENRICHMENT.name, LANDING_TO_SERVING.name]:
        p = pipeline(name)
        with timed(f"run {name}", w.config.metrics) as seen:
            if a.since:
                done = engine.run_range(p, parse_time(a.since), parse_time(a.to), a.dry_run)
            elif a.filter:
                done = engine.run_filter(p, a.filter, a.dry_run)
            elif a.jobs:
                done = engine.run_jobs(p, a.jobs, a.dry_run)
            elif a.session:
                done = engine.run_sessions(p, w.spark.createDataFrame([tuple(s) for s in a.session], "job_id string, session_id string"), a.dry_run)
            else:
                done = engine.run_incremental(p, a.settle_delay_ms, parse_time(a.start_from) if a.start_from else None, a.dry_run, buckets=a.buckets or None)
                if p.mode == "landing":
                    dirty = done.keys
                else:
                    served = done.keys
                    if dirty is not None and not a.dry_run:  # what enrichment changed and this run has not published yet
                        left = dirty if served is None else unserved(dirty, served)
                        done = done.merge(engine.run_sessions(p, left))
            seen["rows"] = done.rows_written
        print(json.dumps(done.report()))
        if a.report_dir:
            Folder(w.spark, a.report_dir).write_json(f"{safe_name(name)}-{done.run_id}.json", done.report())
        bad += done.failures
    return 1 if bad else 0


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("skeinwork").config("spark.sql.session.timeZone", "UTC").enableHiveSupport().getOrCreate()
    w = Workspace(spark, settings(a.profile))
    if a.command == "run":
        return _run(w, a)
    if a.command == "create":
        print(json.dumps(w.initialize(*([a.table] if a.table else []))))
        return 0
    if a.command == "tables":
        print("\n".join(list_tables(spark, w.config.database)))
        return 0
    name = a.table or w.config.landing
    if w.config.production and (a.command == "drop" or getattr(a, "yes", False)) and not a.allow_production:
        raise SystemExit("--allow-production is required to write there")
    table = w.table(name)
    if a.command == "describe":
        print(json.dumps(table.describe()))
    elif a.command == "query":
        rows = reads.read(table.read(where=a.where), None, [c.strip() for c in a.columns.split(",") if c.strip()] or None, a.order_by, limit=a.limit)
        with timed("query", w.config.metrics) as seen:
            if a.output:
                json_rows(watched(rows, seen), JSON_COLUMNS).write.text(a.output)
            else:
                for r in expanded(rows).select(F.to_json(F.struct("*")).alias("value")).toLocalIterator():
                    print(r.value)
    elif a.command == "count":
        print(table.count(a.where or None))
    elif a.command == "tags":
        aggregates.tag_shares(table.read(), a.scan_limit).show(1000, False)
    elif a.command == "duplicates":
        aggregates.duplicate_summary(table.read()).show()
        aggregates.duplicates(table.read()).orderBy(F.desc("n"), "id").limit(a.top).show(a.top, False)
    elif a.command == "undecodable":
        undecodable(table.read(where=a.where)).show()
    elif a.command == "update":
        values = {k: json.dumps(v, separators=(",", ":")) if isinstance(v, (dict, list)) and k in JSON_COLUMNS else v for k, v in json.loads(a.set).items()}
        changes.check_updates(values, RECORD.fieldNames(), REQUIRED)
        todo = changes.needs_update(table.read(where=a.where), values).count()
        print(json.dumps({"would_change": todo}))
        if a.yes and todo:
            table.update(a.where, values, now_ms())
            left = changes.needs_update(table.read(where=a.where), values).count()
            print(json.dumps({"left": left}))
            return 1 if left else 0
    elif a.command == "delete":
        table.read(where=a.where).select("id", "job_id").limit(5).show(5, False)
        print(json.dumps({"rows": table.delete(a.where) if a.yes else table.count(a.where)}))
    elif a.command == "maintain":
        if not any(name == t for t in (w.config.landing, w.config.serving)):
            raise SystemExit(f"maintained are {w.config.landing} and {w.config.serving}")
        missing = table.missing_indexes(LANDING_INDEXES)
        for c in [] if a.no_create_missing else missing:
            table.set_index(c, LANDING_INDEXES[c])
        done = {} if a.no_compact else table.compact([int(b) if b.isdecimal() else bucket_of(b, table.buckets) for b in a.bucket] or None)
        print(json.dumps(done | {"created": [] if a.no_create_missing else missing, "missing": table.missing_indexes(LANDING_INDEXES)}))
        return 1 if done.get("errors") else 0
    elif a.command == "drop":
        if a.confirm != name:
            raise SystemExit("--confirm takes the table's name")
        table.drop() if a.bucket is None else table.drop_bucket(a.bucket)
    return 0


if __name__ == "__main__":
    sys.exit(main())
