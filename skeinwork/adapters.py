"""The test tables seen as trajectory records and environment configs, with the same views in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.columns import bucket


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("job_id", F.expr("concat(event_type,'#h',user_id%3,'#m',user_id%5,'#t',user_id%2,'#x')"))
    ts = F.col("ts").cast("timestamp")
    step = F.row_number().over(Window.partitionBy("job_id", "user_id").orderBy("event_id")) - 1
    return e.select(
        F.expr("concat('ev-',event_id)").alias("id"),
        "job_id",
        F.expr("concat('u',user_id)").alias("session_id"),
        step.cast("int").alias("step_id"),
        F.unix_seconds(ts).alias("created_at"),
        F.unix_millis(ts).alias("source_updated_at"),
        (F.col("event_type") == "purchase").alias("is_terminal"),
        F.col("value").alias("reward"),
        F.expr("""concat('{"status_code":', case when cast(get_json_object(props,'$.k') as int)%10=0 then 500 else 200 end,'}')""").alias("meta_json"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        bucket(F.col("job_id")).alias("bucket"),
    )


EV = """ev as (with k as (select *, event_type||'#h'||(user_id%3)||'#m'||(user_id%5)||'#t'||(user_id%2)||'#x' job_id from events)
 select 'ev-'||event_id id, job_id, 'u'||user_id session_id, (row_number() over (partition by job_id,user_id order by event_id)-1)::int step_id,
 epoch_us(ts)//1000000 created_at, epoch_us(ts)//1000 source_updated_at, event_type in ('purchase') is_terminal, value reward,
 '{"status_code":'||(case when (props::json->>'$.k')::int%10=0 then 500 else 200 end)||'}' meta_json,
 strftime(ts,'%Y-%m-%d') dt, ('0x'||substr(md5(job_id),1,8))::bigint % 128 bucket from k)"""


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.join(labels, "doc_id", "left").select(
        F.expr("concat('doc-',doc_id)").alias("id"),
        F.expr("concat(lang,'#',source,'#m',doc_id%4,'#',case when doc_id%7=0 then '' else 'web' end)").alias("job_id"),
        F.expr("split(concat(lang,'#',source),'#')").alias("tags"),
        F.col("text").alias("search_text"),
        (F.col("quality") == 1).alias("is_trainable"),
    )


DOC = """doc as (select 'doc-'||d.doc_id id, lang||'#'||source||'#m'||(d.doc_id%4)||'#'||(case when d.doc_id%7=0 then '' else 'web' end) job_id,
 string_split(lang||'#'||source,'#') tags, text search_text, l.quality=1 is_trainable from documents d left join labels l on l.doc_id=d.doc_id)"""


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each assistant turn: messages are the turns before it, response is the turn.

    In every third conversation, later turns leave the first message out, so its sessions branch into several chains.
    One window over each conversation; no self-join.
    """
    c = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id")
    said = F.to_json(F.struct("role", F.col("text").alias("content")))
    m = c.withColumn("j", said).withColumn("before", F.collect_list("j").over(w.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)))
    m = m.withColumn("last", F.max(F.when(F.col("role") == "assistant", F.col("turn"))).over(w))
    m = m.where("role = 'assistant'").withColumn("before", F.expr("if(conv_id%3=0 and turn>=4, slice(before, 2, greatest(size(before)-1, 0)), before)")).where("size(before) > 0")
    return m.select(
        F.expr("concat('rec-',conv_id,'-',turn)").alias("id"),
        F.expr("concat('conv#chat#m',conv_id%4,'#task',conv_id%3,'#x')").alias("job_id"),
        F.expr("concat('c',conv_id)").alias("session_id"),
        F.col("turn").cast("int").alias("step_id"),
        F.concat(F.lit("["), F.array_join("before", ","), F.lit("]")).alias("messages"),
        F.col("j").alias("response"),
        (F.col("turn") == F.col("last")).alias("is_session_completed"),
        F.when(F.expr("conv_id%11=0 and turn=last"), F.lit('{"env_state":"{\\"status_code\\":429}"}')).otherwise(F.lit('{"status_code":"200"}')).alias("meta_json"),
        F.expr("concat('model-',conv_id%4)").alias("agent_model"),
    )


REC = r"""rec as (with m as (select *, to_json({'role':role,'content':text})::varchar j from conversations),
 last as (select conv_id, max(turn) t from conversations where role='assistant' group by conv_id)
 select 'rec-'||r.conv_id||'-'||r.turn id, 'conv#chat#m'||(r.conv_id%4)||'#task'||(r.conv_id%3)||'#x' job_id, 'c'||r.conv_id session_id, r.turn::int step_id,
 '['||string_agg(p.j, ',' order by p.turn)||']' messages, any_value(r.j) response, any_value(r.turn=l.t) is_session_completed,
 any_value(case when r.conv_id%11=0 and r.turn=l.t then '{"env_state":"{\"status_code\":429}"}' else '{"status_code":"200"}' end) meta_json, 'model-'||(r.conv_id%4) agent_model
 from m r join m p on p.conv_id=r.conv_id and p.turn<r.turn and p.turn >= case when r.conv_id%3=0 and r.turn>=4 then 1 else 0 end join last l on l.conv_id=r.conv_id
 where r.role='assistant' group by r.conv_id, r.turn)"""


def env_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey+1 id", "concat('env-',p_partkey) env_id", "p_brand env_name", "case p_partkey%3 when 0 then null when 1 then '' else concat(p_type,':',p_size) end image", "p_size%2=0 finished"
    )


ENV = """env as (select p_partkey+1 id, concat('env-',p_partkey) env_id, p_brand env_name,
 case p_partkey%3 when 0 then null when 1 then '' else concat(p_type,':',p_size) end image, p_size%2=0 finished from part)"""
