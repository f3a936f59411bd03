"""The registered queries of the library and, for each, the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .adapters import DOC, ENV, EV, REC, conversation_records, document_records, env_configs, event_records, table
from .functions import columns as C
from .functions import json as J
from .operators import aggregates as A
from .operators import changes as X
from .operators import reads as R
from .operators import sessions as S
from .plans.checkpoints import FileCheckpoints
from .plans.engine import Engine
from .plans.pipeline import LANDING_ENRICHMENT, LANDING_TO_SERVING
from .schema import JSON_COLUMNS, RECORD
from .sources.blobs import missing_blobs as find_missing_blobs
from .sources.files import Kept, shared_folder
from .sources.store import Table, archive, repartitioned
from .streaming.incremental import late_rows as find_late_rows
from .streaming.incremental import publish_available

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return keep


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def record_table(rows: DataFrame, schema: T.StructType | None = None) -> Table:
    """A record table of the catalog that holds the rows, kept in the shared folder."""
    spark, name = rows.sparkSession, f"skeinwork_query_{uuid.uuid4().hex}"
    out = Table.create(spark, name, schema or T.StructType([f for f in rows.schema if f.name != "bucket"]), f"{shared_folder(spark)}/skeinwork/{name}")
    out.append(rows)
    return out


def enriched(spark: SparkSession, d: str) -> DataFrame:
    """Conversation records as the enrichment pipeline leaves them."""
    return LANDING_ENRICHMENT.process(conversation_records(spark, d).withColumns({"source_updated_at": F.lit(1), "rejected_trace": F.lit(None).cast("string")})).rows.drop("__patched", "__before_is_trainable")


# Reads


@query(f"with {EV} select id, job_id, reward from ev where job_id like 'purchase#%' and reward > 50")
def scan_project_filter(spark, d):
    return R.read(event_records(spark, d), "job_id like 'purchase#%' and reward > 50", ["id", "job_id", "reward"])


@query(f"with {EV} select id, dt from ev where dt in ('2024-01-03','2024-01-04') and not is_terminal and job_id like '%#h1#%' and meta_json is not null and (reward < 10 or reward >= 90)")
def predicate_surface(spark, d):
    return R.read(event_records(spark, d), "dt in ('2024-01-03','2024-01-04') and not is_terminal and job_id like '%#h1#%' and meta_json is not null and (reward < 10 or reward >= 90)", ["id", "dt"])


@query(f"with {EV} select bucket, count(*) n from ev group by bucket")
def hash_bucket_counts(spark, d):
    return A.counts_by(event_records(spark, d), "bucket")


@query(f"with {EV} select distinct bucket from ev")
def list_partitions(spark, d):
    return event_records(spark, d).select("bucket").distinct()


@query(f"with {EV} select id, step_id from ev where job_id = 'click#h1#m2#t1#x'")
def bucket_pruned_lookup(spark, d):
    return record_table(event_records(spark, d)).read(where="job_id = 'click#h1#m2#t1#x'").select("id", "step_id")


@query(f"with {EV} select id, job_id from ev where job_id in ('click#h1#m2#t1#x', 'view#h0#m0#t0#x')")
def bucket_pruned_jobs(spark, d):
    return record_table(event_records(spark, d)).read(where="job_id = 'click#h1#m2#t1#x' or job_id in ('view#h0#m0#t0#x')").select("id", "job_id")


@query(f"with {EV} select job_id, count(*) n from ev group by job_id")
def count_by_job(spark, d):
    return A.counts_by(event_records(spark, d), "job_id")


@query(f"with {EV} select dt, count(*) n from ev group by dt")
def count_by_day(spark, d):
    return A.counts_by(event_records(spark, d), "dt")


@query(f"with {DOC} select id, job_id from doc where contains(search_text, 'the of') order by id limit 25")
def keyword_search(spark, d):
    return R.search(document_records(spark, d), "the of", limit=25).select("id", "job_id")


@query(f"with {DOC} select id from doc where contains(search_text, '%%%')")
def keyword_search_escaped(spark, d):
    return R.search(document_records(spark, d), "%%%", limit=None).select("id")


@query(f"with {DOC} select id from doc where list_contains(tags, 'en') and list_contains(tags, 'src3')")
def search_tags_and(spark, d):
    return R.search(document_records(spark, d), tags=["en", "src3"], limit=None).select("id")


@query(f"with {EV} select id, job_id, created_at from ev where id = 'ev-77'")
def point_lookup(spark, d):
    return R.by_id(event_records(spark, d), "ev-77").select("id", "job_id", "created_at")


@query(f"with {EV} select id, created_at from ev where is_terminal order by created_at desc, id limit 1")
def max_created_at(spark, d):
    return R.latest(event_records(spark, d), "is_terminal").select("id", "created_at")


@query(f"with {EV} select id, created_at from ev where created_at >= 1704500000 order by created_at, id limit 100")
def pull_page_1(spark, d):
    return R.page(event_records(spark, d), limit=100, start=1704500000).select("id", "created_at")


@query(f"with {EV}, p as (select id, created_at from ev where created_at >= 1704500000 order by created_at, id limit 100), c as (select max((created_at, id)) m from p) select ev.id, ev.created_at from ev, c where created_at >= 1704500000 and (ev.created_at, ev.id) > c.m order by ev.created_at, ev.id limit 100")
def pull_page_2(spark, d):
    ev = event_records(spark, d)
    after = tuple(R.cursor(R.page(ev, limit=100, start=1704500000)).first())
    return R.page(ev, after, limit=100, start=1704500000).select("id", "created_at")


@query(f"with {EV} select id, (row_number() over (order by created_at, id) - 1) // 1000 page from ev")
def batch_numbering(spark, d):
    return R.page_numbers(event_records(spark, d).select("id", "created_at"), 1000, 16).select("id", F.col("page").cast("long").alias("page"))


@query(f"with {EV} select bucket, id, ((row_number() over (partition by bucket order by id) - 1) // 50)::int batch from ev")
def export_manifest(spark, d):
    return R.export_manifest(event_records(spark, d), 50)


@query(f"with {EV}, m as (select bucket, id, reward, ((row_number() over (partition by bucket order by id) - 1) // 50)::int batch from ev where is_terminal) select bucket, batch, count(*) n, min(id) first_id, max(id) last_id from m group by bucket, batch")
def export_batches(spark, d):
    ev = event_records(spark, d).where("is_terminal").select("bucket", "id", "reward")
    return R.export_bounds(Kept(R.in_ranges(ev, "bucket", "id", parts=16), "export-ranges").rows, 50).select("bucket", "batch", "n", "first_id", "last_id")


@query(f"with {EV} select id, 'missing' side from ev where created_at % 97 = 0 and not is_terminal union all select id, 'unexpected' from ev where created_at % 97 = 1 and is_terminal")
def export_verify_diff(spark, d):
    ev = event_records(spark, d)
    return R.export_differences(ev.where("created_at % 97 = 0 or created_at % 97 = 1 and not is_terminal"), ev.where("created_at % 97 = 1 or created_at % 97 = 0 and is_terminal"))


@query("select o_orderkey id, o_totalprice from orders order by o_orderkey limit 20 offset 200")
def offset_limit_page(spark, d):
    return R.read(table(spark, d, "orders").withColumnRenamed("o_orderkey", "id"), columns=["id", "o_totalprice"], order_by="id", limit=20, offset=200)


@query(f"with {EV} select id, reward from ev order by reward desc, id limit 15")
def top_by_reward(spark, d):
    return R.read(event_records(spark, d), columns=["id", "reward"], order_by="reward", ascending=False, limit=15)


# Statistics


@query(f"with {DOC} select tag, count(*) n from (select unnest(tags) tag from doc) where tag <> '' group by tag")
def tags_distribution(spark, d):
    return A.tag_counts(document_records(spark, d))


@query(f"with {DOC} select tag, count(*) n, round(count(*) * 100.0 / (select count(*) from doc where len(tags) > 0), 2) pct from (select unnest(tags) tag from doc) group by tag")
def tags_percentage(spark, d):
    return A.tag_shares(document_records(spark, d))


@query("select md5(props) id, count(*) n from events group by 1 having count(*) > 1")
def duplicate_id_scan(spark, d):
    return A.duplicates(table(spark, d, "events").select(F.md5("props").alias("id")))


@query("with g as (select md5(props) id, count(*) n from events group by 1) select sum(n)::bigint rows_scanned, count_if(n > 1)::bigint duplicate_ids, coalesce(sum(n) filter (n > 1), 0)::bigint rows_involved, coalesce(sum(n - 1) filter (n > 1), 0)::bigint extra_rows from g")
def duplicate_id_summary(spark, d):
    return A.duplicate_summary(table(spark, d, "events").select(F.md5("props").alias("id")))


@query("select md5(props) id, count(*) n from events group by 1 having count(*) > 1 order by n desc, id limit 10")
def duplicate_top(spark, d):
    return A.duplicates(table(spark, d, "events").select(F.md5("props").alias("id"))).orderBy(F.desc("n"), "id").limit(10)


@query(f"with {ENV} select env_name, arg_max(image, case when image<>'' then id end) image from env where env_name is not null group by env_name")
def env_latest_image(spark, d):
    return A.latest_image(env_configs(spark, d))


@query(f"with {ENV} select trim(image) image, arg_min(trim(env_name), id) env_name from env where trim(image) <> '' and trim(env_name) <> '' group by 1")
def image_first_env(spark, d):
    return A.first_env_of_image(env_configs(spark, d))


@query(f"with {ENV} select coalesce(max(id), 0) + 1 next_id from env")
def next_auto_id(spark, d):
    return A.next_id(env_configs(spark, d))


@query(f"with {ENV} select id, env_id, finished from env where finished order by id limit 10 offset 20")
def env_config_page(spark, d):
    return R.read(env_configs(spark, d), "finished", ["id", "env_id", "finished"], "id", limit=10, offset=20)


@query(f"with {ENV} select count(*) n from env where finished")
def env_config_count(spark, d):
    return env_configs(spark, d).where("finished").agg(F.count("*").alias("n"))


@query(f"with {DOC} select count(*) total, count_if(is_trainable) trainable, count_if(not is_trainable) not_trainable, count_if(is_trainable is null) unknown from doc")
def audit_counts(spark, d):
    t = F.col("is_trainable")
    return A.condition_counts(document_records(spark, d), total=F.lit(True), trainable=t, not_trainable=~t, unknown=t.isNull())


# Joins and changes


@query(f"with {EV} select id from ev where id in (select 'ev-'||(o_orderkey*3) from orders)")
def existing_ids_semi(spark, d):
    ids = table(spark, d, "orders").selectExpr("concat('ev-', o_orderkey*3) id")
    return event_records(spark, d).select("id").join(ids, "id", "left_semi")


@query(f"with {EV} select 'ev-'||(o_orderkey*3) id from orders where 'ev-'||(o_orderkey*3) not in (select id from ev)")
def missing_ids_anti(spark, d):
    ids = table(spark, d, "orders").selectExpr("concat('ev-', o_orderkey*3) id")
    return ids.join(event_records(spark, d).select("id"), "id", "left_anti")


@query(f"with {EV}, src as (select case when created_at % 5 = 0 then 'new-'||id else id end id, job_id, reward + 1000 reward from ev where created_at % 3 = 0) select id, job_id, reward from ev where id not in (select id from src) union all select id, job_id, reward from src")
def upsert_merge(spark, d):
    ev = event_records(spark, d).select("id", "job_id", "reward", "created_at")
    src = ev.where("created_at % 3 = 0").selectExpr("if(created_at % 5 = 0, concat('new-', id), id) id", "job_id", "reward + 1000 reward")
    return X.upserted(ev.select("id", "job_id", "reward"), src)


@query(f"with {EV} select id, case when reward > 90 then 0.0 else reward end reward, case when reward > 90 then 1700000000000 else source_updated_at end source_updated_at from ev")
def conditional_update(spark, d):
    ev = event_records(spark, d).select("id", "reward", "source_updated_at")
    return X.updated(ev, F.col("reward") > 90, {"reward": 0.0}, 1700000000000)


@query(f"with {EV}, src as (select case when created_at % 5 = 0 then 'new-'||id else id end id, case when created_at % 7 = 0 then 'moved' else job_id end job_id, reward + 1000 reward from ev where created_at % 3 = 0) select id, job_id, reward from ev where id not in (select id from src) union all select id, job_id, reward from src")
def table_upsert(spark, d):
    ev = event_records(spark, d).select("id", "job_id", "reward", "created_at")
    t = record_table(ev.select("id", "job_id", "reward"))
    t.upsert(ev.where("created_at % 3 = 0").selectExpr("if(created_at % 5 = 0, concat('new-', id), id) id", "if(created_at % 7 = 0, 'moved', job_id) job_id", "reward + 1000 reward"), 1700000000000)
    return t.read().select("id", "job_id", "reward")


@query(f"with {EV} select id, case when reward > 90 and job_id like 'purchase%' then 0.0 else reward end reward, case when reward > 90 and job_id like 'purchase%' then 1700000000000 else source_updated_at end source_updated_at from ev")
def table_update(spark, d):
    t = record_table(event_records(spark, d).select("id", "job_id", "reward", "source_updated_at"))
    t.update("reward > 90 and job_id like 'purchase%'", {"reward": 0.0}, 1700000000000)
    return t.read().select("id", "reward", "source_updated_at")


@query(f"with {EV} select id, job_id from ev where job_id <> 'view#h0#m0#t0#x' and not (reward < 50 and is_terminal)")
def table_delete(spark, d):
    t = record_table(event_records(spark, d).select("id", "job_id", "reward", "is_terminal"))
    t.delete("job_id = 'view#h0#m0#t0#x'")  # looks at one bucket
    t.delete("reward < 50 and is_terminal")
    return t.read().select("id", "job_id")


@query(f"with {EV} select id, case when created_at % 3 = 0 then case when created_at % 2 = 0 then reward + 1 end else reward end reward, case when created_at % 3 = 0 then 1700000000000 else source_updated_at end source_updated_at from ev")
def table_patch(spark, d):
    ev = event_records(spark, d).select("id", "job_id", "reward", "created_at", "source_updated_at")
    t = record_table(ev.drop("created_at"))
    t.patch(ev.where("created_at % 3 = 0").selectExpr("id", "job_id", "if(created_at % 2 = 0, reward + 1, null) reward"), ("reward",), 1700000000000)
    return t.read().select("id", "reward", "source_updated_at")


@query(f"with {EV} select bucket, count(*) n, min(id) first_id, max(reward) most from ev group by bucket")
def table_compact(spark, d):
    ev = event_records(spark, d).select("id", "job_id", "reward")
    t = record_table(ev.where("reward < 50"))
    t.append(ev.where("not reward < 50"))
    if t.compact()["errors"]:
        raise RuntimeError("not compacted")
    return t.read().groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("reward").alias("most"))


@query(f"with {EV} select case when is_terminal then 'RL' else 'SFT' end dataset_type, bucket, count(*) n from ev where dt in ('2024-01-03', '2024-01-04') and id not like '%9' group by 1, 2")
def table_repartition(spark, d):
    by_day = event_records(spark, d).selectExpr("id", "dt", "if(is_terminal, 'Test', 'SFT') dataset_type", "if(id like '%9', ' ', job_id) job_id")
    t = record_table(by_day.limit(0))
    repartitioned(by_day, t, days=["2024-01-03", "2024-01-04"])
    return t.read().groupBy("dataset_type", "bucket").agg(F.count("*").alias("n"))


@query(f"with {EV} select dt, count(*) n, sum(length(id))::bigint chars from ev where dt < '2024-01-20' group by dt")
def archive_copy(spark, d):
    days, path = event_records(spark, d).select("id", "dt").where("dt < '2024-01-20'"), f"{shared_folder(spark)}/skeinwork/archive-{uuid.uuid4().hex}"
    for part in (days.where("dt < '2024-01-10'"), days):  # the second call copies the days that lack
        archive(part, path)
    return spark.read.schema(days.schema).parquet(path).groupBy("dt").agg(F.count("*").alias("n"), F.sum(F.length("id")).alias("chars"))


@query("select conv_id id, 's3://b/' || conv_id || '-' || turn path from conversations where (conv_id + turn) % 5 = 0")
def missing_blobs(spark, d):
    c = table(spark, d, "conversations").selectExpr("conv_id", "turn", "concat('s3://b/', conv_id, '-', turn) path")
    records = c.groupBy(F.col("conv_id").alias("id")).agg(F.collect_list("path").alias("blob_manifest"))
    return find_missing_blobs(records, c.where("(conv_id + turn) % 5 <> 0")).select("id", "path")


@query(f"with {DOC} select id from doc where is_trainable is distinct from true")
def noop_update_elimination(spark, d):
    return X.needs_update(document_records(spark, d), {"is_trainable": True}).select("id")


@query(f"with {DOC} select id, is_trainable from doc where not coalesce(is_trainable and id like '%1', false)")
def delete_where(spark, d):
    return X.deleted(document_records(spark, d), F.expr("is_trainable and id like '%1'")).select("id", "is_trainable")


@query("select n_nationkey id, n_name, null::bigint reward from nation union all select r_regionkey, null, 1 from region")
def schema_evolution_nulls(spark, d):
    old = table(spark, d, "nation").selectExpr("cast(n_nationkey as long) id", "n_name")
    new = table(spark, d, "region").selectExpr("cast(r_regionkey as long) id", "cast(1 as long) reward")
    return X.grown(old, {"reward": "bigint"}).unionByName(new, allowMissingColumns=True)


@query(f"with {DOC}, t as (select case when id like '%3' then 'RL' else 'SFT' end dataset_type, case when id like '%9' then ' ' when id like '%8' then null else job_id end job_id from doc) select dataset_type, ('0x'||substr(md5(job_id),1,8))::bigint % 128 bucket, count(*) n from t where job_id is not null and trim(job_id) <> '' group by 1, 2")
def value_replace_repartition(spark, d):
    doc = document_records(spark, d).selectExpr("id", "if(id like '%3', 'Test', 'SFT') dataset_type", "case when id like '%9' then ' ' when id like '%8' then null else job_id end job_id")
    kept = doc.where(~C.is_blank(F.col("job_id"))).replace("Test", "RL", ["dataset_type"])
    return kept.withColumn("bucket", C.bucket(F.col("job_id"))).groupBy("dataset_type", "bucket").agg(F.count("*").alias("n"))


@query(f"with {EV}, a as (select dt, count(*) source_n from ev group by dt), b as (select dt, count(*) copy_n from ev where dt < '2024-01-20' and not (dt = '2024-01-07' and is_terminal) group by dt) select a.dt, source_n, coalesce(copy_n, 0) copy_n, case when source_n = coalesce(copy_n, 0) then 'complete' when coalesce(copy_n, 0) = 0 then 'missing' else 'partial' end state from a left join b on a.dt = b.dt")
def archive_count_verify(spark, d):
    ev = event_records(spark, d).select("dt", "is_terminal")
    return A.compare_counts(ev, ev.where("dt < '2024-01-20' and not (dt = '2024-01-07' and is_terminal)"), "dt")


@query(f"with {EV}, b as (select id, job_id, dt, reward from ev where created_at % 10 <> 0), a as (select case when created_at % 10 = 1 then 'x-'||id else id end id, job_id, dt, case when created_at % 10 = 2 then reward + 1 else reward end reward from ev where created_at % 10 <> 3) select coalesce(b.id, a.id) id, case when a.id is null then 'missing' when b.id is null then 'unexpected' else 'different' end state from b full join a on a.id = b.id where a.id is null or b.id is null or a.reward is distinct from b.reward")
def table_diff(spark, d):
    ev = event_records(spark, d).select("id", "job_id", "dt", "reward", "created_at")
    before = ev.where("created_at % 10 <> 0")
    after = ev.where("created_at % 10 <> 3").selectExpr("if(created_at % 10 = 1, concat('x-', id), id) id", "job_id", "dt", "if(created_at % 10 = 2, reward + 1, reward) reward")
    return X.table_differences(before, after, ["job_id", "dt", "reward"])


@query(f"with {EV}, u as (select id, job_id, dt, reward, case when created_at % 4 = 0 then 'z' else job_id end job2, case when created_at % 6 = 0 then null else dt end dt2 from ev) select id, list_filter([case when job_id is distinct from job2 then 'job_id' end, case when dt is distinct from dt2 then 'dt' end], lambda x: x is not null) changed from u where job_id is distinct from job2 or dt is distinct from dt2")
def landing_diff_patches(spark, d):
    ev = event_records(spark, d).select("id", "job_id", "dt", "created_at")
    return X.field_changes(ev, ev.selectExpr("id", "if(created_at % 4 = 0, 'z', job_id) job_id", "if(created_at % 6 = 0, null, dt) dt"), ["job_id", "dt"])


# Sessions and windows


@query(f"with {EV} select distinct job_id, session_id from ev where source_updated_at > 1704240000000 and source_updated_at <= 1704300000000")
def incremental_window_sessions(spark, d):
    return S.dirty_sessions(event_records(spark, d).where(S.in_window(1704240000000, 1704300000000)))


@query(f"with {EV} select distinct job_id, session_id from ev where source_updated_at between 1704067200000 and 1704100000000")
def range_backfill_sessions(spark, d):
    return S.dirty_sessions(event_records(spark, d).where(S.in_window(1704067200000, 1704100000000, closed=True)))


@query(f"with {EV}, k as (select distinct job_id, session_id from ev where source_updated_at > 1704240000000 and source_updated_at <= 1704250000000) select ev.id, ev.step_id from ev join k using (job_id, session_id)")
def session_reload_semi(spark, d):
    ev = event_records(spark, d)
    return S.whole_sessions(ev, S.dirty_sessions(ev.where(S.in_window(1704240000000, 1704250000000)))).select("id", "step_id")


@query(f"with {EV} select distinct job_id, session_id from ev where source_updated_at <= 1704300000000 except select job_id, session_id from ev where is_terminal and source_updated_at <= 1704300000000")
def dirty_handoff_anti(spark, d):
    ev = event_records(spark, d).where(S.in_window(None, 1704300000000))
    return S.dirty_sessions(ev).join(S.dirty_sessions(ev.where("is_terminal")), list(S.SESSION), "left_anti")


_BROKEN = (
    "case when created_at % 331 = 0 then null else step_id end step_id",
    "case when created_at % 401 = 0 then '' else id end id",
    "case when created_at % 509 = 0 then -1 else source_updated_at end source_updated_at",
    "case when created_at % 7 = 0 then 'env-b' when created_at % 7 = 1 and session_id like '%7' then 'env-a' else null end env_id",
)


@query(f"with {EV}, b as (select job_id, session_id, {', '.join(_BROKEN)} from ev), g as (select job_id, session_id, count(*) n, count_if(id is null or trim(id) = '') no_id, count(distinct id) ids, count_if(step_id is null) no_step, count(distinct step_id) steps, count_if(source_updated_at is null or source_updated_at < 0) bad, count(distinct env_id) envs from b group by 1, 2) select job_id, session_id, n, case when no_id > 0 then 'missing id' when ids < n then 'duplicate id' when no_step > 0 then 'missing step_id' when steps < n then 'duplicate step_id' when bad > 0 then 'bad source_updated_at' when envs > 1 then 'several env_id' end error from g")
def session_validation(spark, d):
    return S.session_errors(event_records(spark, d).selectExpr("job_id", "session_id", *_BROKEN))


@query(f"with {EV} select id, '__discovery__' stage, case when created_at % 2 = 0 then 'blank job_id' else 'blank session_id' end error from ev where created_at % 50 < 2")
def discovery_failures(spark, d):
    ev = event_records(spark, d).selectExpr("id", "if(created_at % 50 = 0, ' ', job_id) job_id", "if(created_at % 50 = 1, null, session_id) session_id")
    return S.discovery_failures(ev)


@query(f"with {REC} select job_id, session_id, bool_or(is_session_completed) completed, arg_max(is_session_completed, step_id) on_last from rec group by 1, 2")
def session_completed_last(spark, d):
    return S.completion(conversation_records(spark, d))


@query(f"with {EV} select job_id, session_id, bool_or((meta_json::json->>'$.status_code')::int <> 200) blocked from ev group by 1, 2")
def status_gate(spark, d):
    return S.status_gate(event_records(spark, d))


_FOLD = """r as (select session_id sid, row_number() over (partition by session_id order by step_id) - 1 step, step_id, json_extract(messages, '$[*]')::varchar[] fps from rec),
 st as (select sid, -1::bigint step, []::struct(fps varchar[], step int)[] acc from (select distinct sid from r) union all
 select st.sid, r.step, list_append(list_filter(st.acc, lambda t: not (r.fps[1:len(t.fps)]=t.fps and len(t.fps)=coalesce(list_max(list_transform(list_filter(st.acc, lambda u: r.fps[1:len(u.fps)]=u.fps), lambda u: len(u.fps))),-1))), {'fps':r.fps,'step':r.step_id})
 from st join r on r.sid=st.sid and r.step=st.step+1),
 tails as (select sid, unnest(acc).step step_id from (select sid, arg_max(acc, step) acc from st group by sid))"""
_GATE = "gate as (select session_id, not bool_or(meta_json like '%429%') and bool_or(is_session_completed) ok from rec group by 1)"


@query(f"with recursive {REC}, {_FOLD} select sid session_id, step_id from tails")
def trainable_chain_tails(spark, d):
    return S.chain_tails(conversation_records(spark, d)).select("session_id", F.explode("tails").alias("step_id"))


@query(f"with recursive {REC}, {_FOLD}, {_GATE} select rec.id, case when gate.ok then exists(select 1 from tails where sid = rec.session_id and tails.step_id = rec.step_id) end is_trainable from rec join gate using (session_id)")
def landing_enrichment(spark, d):
    return enriched(spark, d).select("id", "is_trainable")


_TRACE = "'['||substr(messages, 2, length(messages) - 2)||','||response||']'"


@query(f"with {REC} select id, {_TRACE} chosen_trace from rec")
def chosen_trace(spark, d):
    return conversation_records(spark, d).select("id", J.append_json(F.col("messages"), F.col("response")).alias("chosen_trace"))


@query(f"with {REC} select id, array_to_string(list_filter([case when step_id > 3 then agent_model end, case when step_id % 3 = 0 then '' when step_id % 3 = 1 then '  ' else 'x' end, case when step_id % 2 = 1 then session_id end], lambda x: trim(x) <> ''), chr(10)) search_text from rec where step_id > 3 or step_id % 3 = 2 or step_id % 2 = 1")
def search_text(spark, d):
    rec = conversation_records(spark, d)
    parts = [F.expr("if(step_id > 3, agent_model, null)"), F.expr("case when step_id % 3 = 0 then '' when step_id % 3 = 1 then '  ' else 'x' end"), F.expr("if(step_id % 2 = 1, session_id, null)")]
    return rec.select("id", C.joined_text(*parts).alias("search_text")).where("search_text is not null")


@query(f"with {DOC} select id, case when len(ps) = 4 and list_bool_and(list_transform(ps, lambda x: x <> '')) then ps end tags from (select id, list_transform(string_split(job_id, '#'), lambda x: trim(x))[1:4] ps from doc)")
def job_tags(spark, d):
    return document_records(spark, d).select("id", C.job_tags(F.col("job_id")).alias("tags"))


_PUBLISHED = f"with recursive {REC}, {_FOLD}, {_GATE}, pub as (select rec.id, rec.job_id, rec.session_id, rec.step_id, {_TRACE} chosen_trace, rec.agent_model, rec.meta_json from rec join gate using (session_id) join tails on tails.sid = rec.session_id and tails.step_id = rec.step_id where gate.ok)"


@query(f"{_PUBLISHED} select id, chosen_trace, concat_ws(chr(10), chosen_trace, agent_model, meta_json) search_text, string_split(job_id, '#')[1:4] tags from pub")
def landing_to_serving(spark, d):
    return LANDING_TO_SERVING.process(enriched(spark, d)).records().select("id", "chosen_trace", "search_text", "tags")


@query(f"{_PUBLISHED} select id, chosen_trace, concat_ws(chr(10), chosen_trace, agent_model, meta_json) search_text, string_split(job_id, '#')[1:4] tags from pub")
def incremental_publish(spark, d):
    landing, serving = record_table(conversation_records(spark, d).limit(0), RECORD), record_table(conversation_records(spark, d).limit(0), RECORD)
    landing.append(conversation_records(spark, d).withColumns({"dataset_type": F.lit("RL"), "created_at": F.lit(1_700_000_000)}), 1_700_000_000_000)
    engine = Engine(landing, serving)
    for p in (LANDING_ENRICHMENT, LANDING_TO_SERVING):
        if engine.run_incremental(p, start_from=0).failures:
            raise RuntimeError(f"{p.name} failed")
    return serving.read().select("id", "chosen_trace", "search_text", "tags")


def landing_and_serving(spark: SparkSession, d: str) -> tuple[Table, Table]:
    """Enriched records as a landing table, each conversation changed at one of ten times, and an empty serving table."""
    at = F.expr("1000L * (cast(substr(session_id, 2) as int) % 10)")
    rows = enriched(spark, d).withColumns({"dataset_type": F.lit("RL"), "created_at": F.lit(1_700_000_000), "dt": F.lit("2023-11-14"), "source_updated_at": at})
    return record_table(rows, RECORD), record_table(spark.createDataFrame([], RECORD), RECORD)


def published_ids(serving: Table) -> DataFrame:
    return serving.read().select("id", F.size("tags").alias("n_tags"))


@query(f"{_PUBLISHED} select id, 4 n_tags from pub where substr(session_id, 2)::int % 10 between 3 and 5")
def range_publish(spark, d):
    landing, serving = landing_and_serving(spark, d)
    Engine(landing, serving).run_range(LANDING_TO_SERVING, 3000, 5000)
    return published_ids(serving)


@query(f"{_PUBLISHED} select id, 4 n_tags from pub where job_id in ('conv#chat#m1#task0#x', 'conv#chat#m2#task2#x')")
def job_publish(spark, d):
    landing, serving = landing_and_serving(spark, d)
    Engine(landing, serving).run_jobs(LANDING_TO_SERVING, ["conv#chat#m1#task0#x", " conv#chat#m2#task2#x "])
    return published_ids(serving)


@query(f"{_PUBLISHED} select id, 4 n_tags from pub where session_id in (select session_id from rec where step_id = 5 and agent_model <> 'model-2')")
def filter_publish(spark, d):
    landing, serving = landing_and_serving(spark, d)
    Engine(landing, serving).run_filter(LANDING_TO_SERVING, "step_id = 5 and agent_model <> 'model-2'")
    return published_ids(serving)


@query(f"{_PUBLISHED} select id, 4 n_tags from pub where substr(session_id, 2)::int % 13 = 0")
def session_publish(spark, d):
    landing, serving = landing_and_serving(spark, d)
    Engine(landing, serving).run_sessions(LANDING_TO_SERVING, landing.read().where("cast(substr(session_id, 2) as int) % 13 = 0").select("job_id", "session_id"))
    return published_ids(serving)


@query(f"{_PUBLISHED} select id, 4 n_tags from pub")
def stream_publish(spark, d):
    landing, serving = landing_and_serving(spark, d)
    publish_available(landing, serving, LANDING_TO_SERVING, f"{shared_folder(spark)}/skeinwork/stream-{uuid.uuid4().hex}", lambda: 1_700_000_000_000)
    return published_ids(serving)


@query(f"with {REC} select distinct 'landing_to_serving_pipeline|2|landing|serving|' || b id, b::int bucket, 'IDLE' status, 6000::bigint committed_until_ms from (select ('0x' || substr(md5(job_id), 1, 8))::bigint % 128 b from rec)")
def incremental_checkpoints(spark, d):
    landing, serving = landing_and_serving(spark, d)
    store = FileCheckpoints(spark, f"{shared_folder(spark)}/skeinwork/checkpoints-{uuid.uuid4().hex}")
    store.initialize()
    engine = Engine(landing, serving, store)
    for started in (4000, 6000):
        engine.run_incremental(LANDING_TO_SERVING, start_from=0, started_ms=started)
    return store.frame(spark).select("id", "bucket", "status", "committed_until_ms")


@query(f"with {EV} select id, source_updated_at from ev where (bucket % 2 = 0 and source_updated_at <= 1704240000000) or (bucket % 2 = 1 and source_updated_at <= 1704100000000)")
def late_rows(spark, d):
    ev = event_records(spark, d).select("id", "bucket", "source_updated_at")
    committed = ev.select("bucket").distinct().withColumn("committed_until_ms", F.expr("if(bucket % 2 = 0, 1704240000000, 1704100000000)"))
    return find_late_rows(ev, committed).select("id", "source_updated_at")


@query(f"{_PUBLISHED}, g as (select rec.session_id, count(*) rows_read, (select count(*) from pub where pub.session_id = rec.session_id) rows_written, case when any_value(not gate.ok) then 'skipped' end error from rec join gate using (session_id) group by 1) select count(*) sessions, sum(rows_read)::bigint rows_read, sum(rows_written)::bigint rows_written, count_if(error is not null)::bigint failures, list_sort(list_distinct(list(error))) errors from g")
def run_summary(spark, d):
    rec = enriched(spark, d)
    each = rec.groupBy(*S.SESSION).agg(F.count("*").alias("rows_read"), F.count_if("is_trainable").alias("rows_written"), F.when(F.bool_and(F.col("is_trainable").isNull()), "skipped").alias("error"))
    return A.run_summary(each)


# Functions


@query(f"with {EV} select id, 'p|'||dt||'|landing|serving|'||bucket identity from ev")
def checkpoint_identity(spark, d):
    ev = event_records(spark, d).withColumns({"p": F.lit("p"), "a": F.lit("landing"), "b": F.lit("serving")})
    return ev.select("id", C.checkpoint_identity("p", "dt", "a", "b", "bucket").alias("identity"))


_KEYS_IN_ORDER = r"""with said as (select conv_id, turn, '{"content": ' || to_json(text) || ', "role": ' || to_json(role) || '}' j from conversations),
 whole as (select conv_id, '[' || string_agg(j, ', ' order by turn) || ']' messages, count(*) n from said group by conv_id)"""


@query(_KEYS_IN_ORDER + """ select conv_id, 'evt_' || substr(md5(case when conv_id % 4 = 3 then '{"n": ' || n || ', "tag": "t' || conv_id % 9 || '"}' else messages end), 1, 16) event_id from whole""")
def deterministic_id(spark, d):
    said = F.to_json(F.struct("role", F.col("text").alias("content")))  # keys out of order
    whole = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", said.alias("j")))).alias("m"), F.count("*").alias("n"))
    text = F.concat(F.lit(" [ "), F.array_join(F.transform("m", lambda x: x.j), " , "), F.lit("]"))
    rec = whole.select("conv_id", F.expr("concat('t', conv_id % 9)").alias("tag"), "n", F.when(F.col("conv_id") % 4 < 3, text).alias("messages"), F.lit("{}").alias("meta_json"), F.col("conv_id").alias("created_at"))
    return rec.select("conv_id", J.deterministic_id(rec.drop("conv_id")).alias("event_id"))


@query("with t as (select event_id, case when event_id % 4 = 0 then (epoch_us(ts)//1000000)::varchar when event_id % 4 = 1 then (epoch_us(ts)//1000)::varchar when event_id % 4 = 2 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') else 'soon' end s, epoch_us(ts) us from events) select event_id, case when event_id % 4 = 1 then us // 1000 when event_id % 4 = 3 then null else us // 1000000 * 1000 end ms from t")
def parse_time(spark, d):
    e = table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    said = F.expr("case when event_id % 4 = 0 then cast(unix_seconds(t) as string) when event_id % 4 = 1 then cast(unix_millis(t) as string) when event_id % 4 = 2 then date_format(t, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") else 'soon' end")
    return e.select("event_id", C.parse_time(said).alias("ms"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad((epoch_us(ts)//1000%1000)::varchar, 3, '0') || 'Z' iso from events")
def iso_time(spark, d):
    return table(spark, d, "events").select("event_id", C.iso_time(F.unix_millis(F.col("ts").cast("timestamp"))).alias("iso"))


@query("select event_id, strftime(ts, '%Y-%m-%d') dt from events")
def dt_derivation(spark, d):
    return table(spark, d, "events").select("event_id", C.day_of_seconds(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("dt"))


@query("""select conv_id, turn, case when turn % 4 = 0 then ['s3://b/' || conv_id || '.png'] when turn % 4 = 1 then ['s3://b/x.png', 's3://b/' || turn || '.wav'] else []::varchar[] end links from conversations""")
def blob_manifest(spark, d):
    c = table(spark, d, "conversations")
    a = F.expr("""concat('[{"type":"image_url","image_url":{"detail":"low","url":"s3://b/', conv_id, '.png"}},{"image_url":{"url":"https://x/y.png"}}]')""")
    # deep ones, an escaped slash, one under a link's own object, and plain texts under the same keys
    b = F.expr(r"""concat('{"input_audio": "s3://b/', conv_id, '.wav", "a":[{"b":[[{"image_url":{"url":"s3:\\/\\/b/x.png", "c":{"d":{"input_audio":{"url":"s3://b/', turn, '.wav"}}}}}]]}], "url":"s3://b/z"}')""")
    m = F.when(F.col("turn") % 4 == 0, a).when(F.col("turn") % 4 == 1, b).when(F.col("turn") % 4 == 2, F.concat(a, F.lit("]")))
    return c.select("conv_id", "turn", J.blob_links(m, m).alias("links"))


@query(f"""with {REC} select '{{"id":"' || id || '","step_id":' || step_id || ',"reward":' || case when step_id % 3 = 0 then 'null' else (step_id / 2)::double::varchar end || ',"raw":{{"encoding":"base64","data":"' || base64(encode(id)) || '"}},"tags":null,"meta_json":' ||
 case when meta_json like '%429%' then '{{"env_state":{{"status_code":429}}}}' else '{{"status_code":"200"}}' end || ',"response":' || case when step_id % 2 = 0 then response else '"{{oops"' end || '}}' "value" from rec""")
def json_output(spark, d):
    odd = {"reward": F.expr("if(step_id % 3 = 0, double('nan'), step_id / 2)"), "raw": F.col("id").cast("binary"), "tags": F.lit(None).cast("array<string>"), "response": F.expr("if(step_id % 2 = 0, response, '{oops')")}
    rows = conversation_records(spark, d).withColumns(odd).select("id", "step_id", "reward", "raw", "tags", "meta_json", "response")
    return J.json_rows(rows, JSON_COLUMNS)


@query("select page_id, case when page_id % 3 = 0 then true else false end is_json, case when page_id % 3 = 0 then 'OBJECT' end kind from pages")
def json_decode_status(spark, d):
    said = F.expr("case page_id % 3 when 0 then to_json(named_struct('url', url)) when 1 then concat('{', url) else null end")
    p = table(spark, d, "pages").select("page_id", said.alias("j"))
    return p.select("page_id", F.coalesce(J.is_json(F.col("j")), F.lit(False)).alias("is_json"), J.json_kind(F.col("j")).alias("kind"))


@query(f"""with {ENV} select id, case when image is null then to_json({{'env_id': env_id, 'finished': finished}})::varchar else to_json({{'env_id': env_id, 'image': image, 'finished': finished}})::varchar end j from env""")
def compact_json_rows(spark, d):
    return env_configs(spark, d).select("id", J.compact_row("env_id", "image", "finished").alias("j"))


@query("""select 'ev-'||event_id id, strftime(ts, '%Y-%m-%d') dt, case when event_id % 2 = 0 then 5 else 1700000000000 end source_updated_at, null::bigint serving_updated_at, case when event_id % 3 = 0 then ['s3://b/'||event_id] else []::varchar[] end blob_manifest from events""")
def ingest_derive_defaults(spark, d):
    e = table(spark, d, "events").selectExpr("concat('ev-', event_id) id", "unix_seconds(cast(ts as timestamp)) created_at", "if(event_id % 2 = 0, 5L, null) source_updated_at", "7L serving_updated_at", """if(event_id % 3 = 0, concat('[{"image_url":{"url":"s3://b/', event_id, '"}}]'), null) messages""")
    return X.ingest_defaults(e, 1700000000000).select("id", "dt", "source_updated_at", "serving_updated_at", "blob_manifest")
