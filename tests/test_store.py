import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from skeinwork.functions.columns import bucket, bucket_of, event_id
from skeinwork.operators.reads import export_batches, page, pages, search
from skeinwork.plans.checkpoints import Checkpoint, CheckpointError, FileCheckpoints
from skeinwork.plans.engine import Engine, unserved
from skeinwork.plans.pipeline import LANDING_ENRICHMENT, LANDING_TO_SERVING
from skeinwork.schema import RECORD
from skeinwork.sources import blobs
from skeinwork.sources.envs import EnvConfigs
from skeinwork.sources.files import Folder
from skeinwork.sources.pruning import pinned_buckets
from skeinwork.sources.store import Exists, Table, archive, list_tables, repartitioned
from skeinwork.streaming.incremental import buffered_append, late_rows, publish_available


def rows(spark, items):
    base = {"dataset_type": "RL", "created_at": 1_700_000_000, "job_id": "d#h#m#t#x", "session_id": "s", "step_id": 0, "messages": '[{"role":"user","content":"q"}]', "response": '{"a":1}', "meta_json": "{}", "agent_model": "m"}
    names = "id dataset_type created_at source_updated_at job_id session_id step_id messages response meta_json agent_model is_session_completed is_trainable tags".split()
    schema = ", ".join(f"{n} {RECORD[n].dataType.simpleString()}" for n in names)
    return spark.createDataFrame([tuple((base | i).get(n) for n in names) for i in items], schema)


def made(spark, **layout):
    return Table.create(spark, f"t_{uuid.uuid4().hex[:12]}", RECORD, **({"buckets": 8} | layout))


@pytest.fixture
def table(spark):
    t = made(spark)
    yield t
    if spark.catalog.tableExists(t.name):
        t.drop()


def test_append_read_and_refusals(spark, table):
    assert table.append(rows(spark, []), 5) == 0
    assert table.append(rows(spark, [{"id": f"r{k}", "job_id": f"j{k % 5}"} for k in range(20)]), 5) == 20
    got = table.read().first()
    assert (got.dt, got.source_updated_at, got.serving_updated_at, got.blob_manifest) == ("2023-11-14", 5, None, [])
    assert table.count() == 20 and table.read_job("j3").count() == 4
    table.append(rows(spark, [{"id": "r99", "job_id": "j1"}]), 6)
    assert table.count() == 21
    for bad in ({"id": None}, {"id": " "}, {"id": "a", "created_at": None}, {"id": "a", "dataset_type": None}):
        with pytest.raises(ValueError, match="blank id|null in"):
            table.append(rows(spark, [{"id": "fine"}, bad]), 5)
    assert table.count() == 21
    with pytest.raises(Exists):
        Table.create(spark, table.name, RECORD)
    with pytest.raises(FileNotFoundError):
        Table(spark, "nowhere")


def test_nan_in_a_whole_numbers_place_is_null(spark, table):
    df = rows(spark, [{"id": "a"}, {"id": "b"}]).drop("step_id").withColumn("step_id", F.when(F.col("id") == "a", F.lit(float("nan"))).otherwise(F.lit(3.0)))
    table.append(df, 5)
    assert {r.id: r.step_id for r in table.read().collect()} == {"a": None, "b": 3}


def scanned(df):
    return re.search(r"PartitionFilters: \[[^\]]*bucket", df._jdf.queryExecution().executedPlan().toString())


def test_a_filter_on_jobs_lists_their_buckets_only(spark, table):
    table.append(rows(spark, [{"id": f"r{k}", "job_id": f"j{k}"} for k in range(30)]), 5)
    one, two = bucket_of("j7", 8), {bucket_of("j7", 8), bucket_of("j3", 8)}
    cases = {
        "job_id = 'j7'": {one},
        "'j7' = job_id and step_id = 0": {one},
        "job_id = concat('j', '7')": {one},
        "job_id like 'j7'": {one},
        "job_id in ('j7', 'j3')": two,
        "job_id = 'j7' or job_id = 'j3'": two,
        "(job_id = 'j7' or job_id = 'j3') and job_id in ('j7', 'j9')": {one},
        "job_id in (" + ",".join(f"'j{k}'" for k in range(12)) + ") and job_id <=> 'j7'": {one},
        "job_id = 'j7' and job_id = 'j3'": set(),
    }
    for where, want in cases.items():
        got = pinned_buckets(spark.table(table.name).where(where), "job_id", 8)
        assert set(got) == want, where
        df = table.read(where=where)
        assert {r.job_id for r in df.collect()} == {r.job_id for r in spark.table(table.name).where(where).collect()}, where
        assert not want or scanned(df), where
    for where in ("job_id = 'j7' or step_id = 0", "job_id like 'j7%'", "not job_id = 'j7'", "agent_model = \"job_id = 'j7'\"", "job_id <> 'j7'", "lower(job_id) = 'j7'"):
        assert pinned_buckets(spark.table(table.name).where(where), "job_id", 8) is None, where
        assert table.read(where=where).count() == spark.table(table.name).where(where).count()
    assert {r.bucket for r in table.read_job("j7").collect()} == {one}
    assert spark.range(1).select(bucket(F.lit("j7"), 8)).first()[0] == one
    assert table.read([]).count() == 0


def test_upsert_update_delete_compact(spark, table):
    table.append(rows(spark, [{"id": f"r{k}", "job_id": f"j{k % 5}"} for k in range(20)]), 5)
    fresh = rows(spark, [{"id": "r3", "job_id": "j3", "agent_model": "new"}, {"id": "x", "job_id": "j3"}]).withColumn("dt", F.lit("d")).withColumn("source_updated_at", F.lit(1))
    assert table.upsert(fresh, 77) == 2 and table.upsert(fresh.limit(0), 78) == 0
    got = {r.id: (r.agent_model, r.serving_updated_at) for r in table.read().collect()}
    assert len(got) == 21 and got["r3"] == ("new", 77) and got["x"] == ("m", 77) and got["r4"] == ("m", None)
    for bad in ([{"id": "a", "job_id": " "}], [{"id": "a"}, {"id": "a"}]):
        with pytest.raises(ValueError):
            table.upsert(rows(spark, bad), 1)
    assert table.update("agent_model = 'new'", {"agent_model": "newer"}, 99) == 1
    assert table.read().where("id = 'r3'").select("agent_model", "source_updated_at").first() == ("newer", 99)
    assert table.update("id = 'nobody'", {"agent_model": "z"}) == 0
    for bad in (("", {"tags": None}), ("id = 'a'", {}), ("id = 'a'", {"id": "b"}), ("id = 'a'", {"nope": 1}), ("id = 'a'", {"dt": None}), ("id = 'r3'", {"dt": F.lit(None)})):
        with pytest.raises(ValueError):
            table.update(*bad)
    assert table.delete("serving_updated_at = 77 and id = 'x'") == 1 and table.delete("serving_updated_at > 1000") == 0 and table.count() == 20
    table.append(rows(spark, [{"id": "late", "job_id": "j3"}]), 6)
    done = table.compact()
    assert done["files_after"] == len(table.partitions()) < done["files_before"] and table.count() == 21
    assert table.compact([999])["errors"]
    own = table.read_job("j3").first().bucket
    gone = table.count(f"bucket = {own}")
    assert table.delete(F.col("bucket") == own) == gone and own not in table.partitions() and table.count() == 21 - gone
    table.append(rows(spark, [{"id": "again", "job_id": "j3"}]), 7)
    assert table.count(f"bucket = {own}") == 1


def test_an_id_moves_with_its_job(spark, table):
    table.append(rows(spark, [{"id": "a", "job_id": "j0"}, {"id": "b", "job_id": "j1"}]), 5)
    assert bucket_of("j0", 8) != bucket_of("j4", 8)
    moved = rows(spark, [{"id": "a", "job_id": "j4"}]).withColumn("dt", F.lit("d")).withColumn("source_updated_at", F.lit(1))
    table.upsert(moved, 9)
    assert sorted((r.id, r.job_id) for r in table.read().collect()) == [("a", "j4"), ("b", "j1")]
    assert bucket_of("j0", 8) not in table.partitions() or bucket_of("j0", 8) == bucket_of("j1", 8)


def test_schema_growth_indexes_and_catalog(spark, table):
    table.append(rows(spark, [{"id": "a"}]), 5)
    assert table.add_columns({"extra": "bigint", "id": "string"}) == ["extra"]
    assert table.read().select("id", "extra").first() == ("a", None)
    table.append(rows(spark, [{"id": "b"}]).withColumn("extra", F.lit(4)), 5)
    assert {r.id: r.extra for r in table.read().collect()} == {"a": None, "b": 4}
    table.set_index("id", "BTREE")
    assert table.missing_indexes({"id": "BTREE", "dt": "BITMAP"}) == ["dt"]
    assert table.name in list_tables(spark)
    assert table.describe()["existing"] == table.partitions() and not table.schema()["id"].nullable
    where = table.location
    table.drop_bucket(table.partitions()[0])
    assert table.count() == 0
    table.drop()
    assert table.name not in list_tables(spark) and not Folder(spark, where).exists("")


def test_a_table_at_a_path_of_its_own(spark, tmp_path):
    t = made(spark, path=f"file://{tmp_path}/own")
    t.append(rows(spark, [{"id": "a"}, {"id": "b"}]), 5)
    assert t.delete("id = 'a'") == 1 and t.delete("true") == 1 and t.count() == 0 and not list(tmp_path.glob("own/bucket=*"))
    t.drop()
    assert not (tmp_path / "own").exists()


def test_repartition_and_archive(spark, table, tmp_path):
    src = rows(spark, [{"id": f"r{k}", "job_id": None if k == 3 else " " if k == 4 else f"j{k}", "dataset_type": "Test" if k % 2 else "RL"} for k in range(10)]).withColumn("dt", F.concat(F.lit("2024-01-0"), (F.expr("substr(id, 2)").cast("int") % 3 + 1).cast("string"))).withColumn("source_updated_at", F.lit(1).cast("long"))
    with pytest.raises(ValueError):
        repartitioned(src, table, drop_blank=False)
    table.append(rows(spark, [{"id": "old"}]), 5)
    done = repartitioned(src, table)
    assert (done["rows"], done["dropped"], done["types"]) == (8, 2, {"RL": 8})
    backup = Table(spark, done["backup"])
    assert [r.id for r in backup.read().collect()] == ["old"]
    with pytest.raises(ValueError, match="null in created_at"):
        repartitioned(src.withColumn("created_at", F.lit(None).cast("long")), table)
    assert table.count() == 8 and not [n for n in list_tables(spark) if "__staging_" in n]
    backup.drop()
    assert {r[0] for r in table.read().select("dataset_type").distinct().collect()} == {"RL"}
    path = f"file://{tmp_path}/archive"
    one = archive(src.select("id", "dt"), path)
    assert [r["state"] for r in one] == ["complete"] * 3 and archive(src.select("id", "dt"), path) == one
    with pytest.raises(RuntimeError):
        archive(src.select("id", "dt").union(spark.createDataFrame([("z", "2024-01-01")], "id string, dt string")), path)


def test_pages_lose_no_ties_and_export_checks_ids(spark, table):
    table.append(rows(spark, [{"id": f"r{k:02}", "created_at": 1_700_000_000 + k // 7, "job_id": f"j{k % 3}"} for k in range(25)]), 5)
    df = table.read()
    assert [r.id for p in pages(df, 10) for r in p.collect()] == [f"r{k:02}" for k in range(25)]
    strict = page(df, (1_700_000_000, None), 100, strict=True)
    assert strict.count() == 18
    per = {r.bucket: sorted(x.id for x in df.collect() if x.bucket == r.bucket) for r in df.collect()}
    got = [(b.export["bucket"], b.export["batch"], b.export["manifest_rows"], [r.id for r in b.collect()]) for b in export_batches(df, 4, ["id"])]
    assert got == [(b, k // 4, 25, ids[k : k + 4]) for b, ids in sorted(per.items()) for k in range(0, len(ids), 4)]
    assert [b.columns for b in export_batches(df.limit(1), 4, ["job_id", "messages"], parse_json=True)] == [["job_id", "messages"]]
    for bad in (0, True, 2.5):
        with pytest.raises(ValueError):
            next(export_batches(df, bad))
    with pytest.raises(RuntimeError):
        next(export_batches(df.union(df.limit(1)), 4))
    with pytest.raises(ValueError):
        search(df, "x", fields=["messages"])


def landing_and_serving(spark, tmp_path):
    return made(spark, buckets=4), made(spark, buckets=4)


def test_incremental_windows_checkpoints_and_handoff(spark, tmp_path):
    landing, serving = landing_and_serving(spark, tmp_path)
    landing.append(rows(spark, [{"id": "a0", "session_id": "a", "source_updated_at": 5000}, {"id": "a1", "session_id": "a", "step_id": 1, "is_session_completed": True, "messages": '[{"role":"user","content":"q"},1]', "source_updated_at": 5000}, {"id": "b0", "session_id": "b", "is_session_completed": True, "source_updated_at": 5001}]), 1)
    store = FileCheckpoints(spark, f"file://{tmp_path}/state")
    with pytest.raises(CheckpointError):
        store.load("")
    assert store.initialize() and not store.initialize()
    engine = Engine(landing, serving, store)
    with pytest.raises(ValueError):
        engine.run_incremental(LANDING_ENRICHMENT, started_ms=5000)
    dry = engine.run_incremental(LANDING_ENRICHMENT, start_from=0, started_ms=5000, dry_run=True)
    assert (dry.sessions, dry.rows_written) == (1, 2) and not store.load("")
    run = engine.run_incremental(LANDING_ENRICHMENT, start_from=0, started_ms=5000)
    assert (run.sessions, run.rows_read, run.rows_written, run.failures) == (1, 2, 2, 0)
    assert {r.id: r.is_trainable for r in landing.read().collect()} == {"a0": False, "a1": True, "b0": None}
    kept = FileCheckpoints(spark, f"file://{tmp_path}/state").frame(spark).collect()
    assert {r.status for r in kept} == {"IDLE"} and {r.committed_until_ms for r in kept} == {5000}
    again = engine.run_incremental(LANDING_ENRICHMENT, started_ms=6000)
    assert again.sessions == 1  # b at 5001; the patched rows of a carry the time of the patch, which is later
    served = engine.run_filter(LANDING_TO_SERVING, "session_id = 'a'")
    assert served.rows_written == 1 and [r.id for r in serving.read().collect()] == ["a1"]
    assert serving.read().first().tags == ["d", "h", "m", "t"]
    every = landing.read().select("job_id", "session_id").distinct()
    assert [r.session_id for r in unserved(every, every.where("session_id = 'a'")).collect()] == ["b"]
    assert engine.run_jobs(LANDING_TO_SERVING, ["d#h#m#t#x"]).sessions == 2 and serving.count() == 2
    assert engine.run_range(LANDING_TO_SERVING, 5001, 5001, dry_run=True).sessions <= 1
    merged = run.merge(again)
    assert merged.sessions == 2 and json.dumps(merged.report())


def test_a_failed_window_is_taken_again(spark, tmp_path):
    landing, serving = landing_and_serving(spark, tmp_path)
    landing.append(rows(spark, [{"id": "a0", "session_id": "a", "is_trainable": True, "response": "{oops", "source_updated_at": 10}]), 1)
    engine = Engine(landing, serving)
    assert engine.run_incremental(LANDING_TO_SERVING, start_from=0, started_ms=100).failures == 1
    c = next(iter(engine.checkpoints.load(LANDING_TO_SERVING.name).values()))
    assert (c.status, c.active_window_end_ms, c.committed_until_ms) == ("FAILED", 100, -1)
    landing.update("id = 'a0'", {"response": "{}"})
    done = engine.run_incremental(LANDING_TO_SERVING, started_ms=200)
    assert done.failures == 0 and serving.count() == 1
    c = next(iter(engine.checkpoints.load(LANDING_TO_SERVING.name).values()))
    assert (c.status, c.committed_until_ms, c.active_window_end_ms) == ("IDLE", 200, None)


def test_buckets_fail_alone(spark, tmp_path):
    landing, serving = landing_and_serving(spark, tmp_path)
    good = [{"id": f"g{k}", "job_id": f"d#h#m#t#{k}", "session_id": "s", "is_trainable": True, "response": "{}", "source_updated_at": 10} for k in range(3)]
    landing.append(rows(spark, [*good, {**good[0], "id": "bad", "job_id": "d#h#m#t#bad", "response": "{oops"}]), 1)
    own = {r.job_id: r.bucket for r in landing.read().collect()}
    bad = own["d#h#m#t#bad"]
    assert set(own.values()) - {bad}
    engine = Engine(landing, serving)
    run = engine.run_incremental(LANDING_TO_SERVING, start_from=0, started_ms=100)
    assert run.failures == 1 and run.failed_buckets == [bad] and serving.count() == 3
    states = {c.bucket: (c.status, c.committed_until_ms) for c in engine.checkpoints.load(LANDING_TO_SERVING.name).values()}
    assert states == {b: ("FAILED", -1) if b == bad else ("IDLE", 100) for b in own.values()}


def test_an_env_id_is_a_value_not_a_filter(spark, tmp_path):
    envs = EnvConfigs(spark, f"env_{uuid.uuid4().hex[:12]}", create=True)
    envs.save([{"env_name": "one"}, {"env_name": "two", "env_id": "it's \\' or true --"}])
    assert not envs.delete("\\' or true --") and envs.count() == 2
    assert envs.delete("it's \\' or true --") and [r.env_name for r in envs.read().collect()] == ["one"]


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    landing, serving = landing_and_serving(spark, tmp_path)
    landing.append(rows(spark, [{"id": f"a{k}", "session_id": f"s{k % 3}", "step_id": k, "is_trainable": k % 2 == 0} for k in range(9)]), 1)
    publish_available(landing, serving, LANDING_TO_SERVING, f"{tmp_path}/ck", lambda: 7)
    first = sorted(r.id for r in serving.read().collect())
    landing.append(rows(spark, [{"id": "z", "session_id": "s9", "is_trainable": True}]), 1)
    publish_available(landing, serving, LANDING_TO_SERVING, f"{tmp_path}/ck", lambda: 8)
    assert first == ["a0", "a2", "a4", "a6", "a8"] and serving.count() == 6


def test_a_buffered_stream_is_appended(spark, table, tmp_path):
    source = rows(spark, [{"id": f"r{k}", "job_id": f"j{k % 3}"} for k in range(12)])
    source.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    buffered_append(stream(), table, f"{tmp_path}/ck", lambda: 9)
    buffered_append(stream(), table, f"{tmp_path}/ck", lambda: 10)  # nothing new
    assert sorted(r.id for r in table.read().collect()) == sorted(f"r{k}" for k in range(12)) and {r.source_updated_at for r in table.read().collect()} == {9}


def test_rows_that_come_too_late_are_found(spark):
    changes = spark.createDataFrame([("a", 0, 5), ("b", 0, 11), ("c", 1, 5), ("d", 2, 5)], "id string, bucket long, source_updated_at long")
    committed = spark.createDataFrame([(0, 10), (1, 4)], "bucket long, committed_until_ms long")
    assert [r.id for r in late_rows(changes, committed).collect()] == ["a"]


def test_event_ids(spark):
    got = [r[0] for r in spark.range(50).select(event_id()).collect()]
    assert len(set(got)) == 50 and all(re.fullmatch(r"evt_\d{10}_[0-9a-f]{8}", x) for x in got)


def test_env_ids_are_claimed_once(spark, tmp_path):
    name = f"env_{uuid.uuid4().hex[:12]}"
    env = EnvConfigs(spark, name, create=True)
    env.save({"env_name": "a"})
    Folder(spark, env.table.location).create("_claims/2", "1")  # another writer is at it
    with pytest.raises(Exists):
        env.save({"env_name": "b"})
    assert env.count() == 1


def test_env_configs(spark, tmp_path):
    env = EnvConfigs(spark, f"env_{uuid.uuid4().hex[:12]}", create=True, path=f"file://{tmp_path}/env")
    assert env.save([{"env_name": "e", "env_params": {"a": 1}}, {"env_name": " f ", "image": " i "}]) == [1, 2]
    assert env.save({"env_name": "e", "image": "j"}) == [3]
    with pytest.raises(ValueError):
        env.save([{"env_name": "ok"}, {"env_name": " "}])
    assert env.count() == 3 and [r.id for r in env.page(1, 1).collect()] == [2]
    assert {r.env_name: r.image for r in env.images().collect()} == {"e": "j", " f ": " i "}
    assert {r.image: r.env_name for r in env.envs_by_image().collect()} == {"i": "f", "j": "e"}
    assert env.update("env-1", {"finished": True, "env_params": {"b": 2}}) and not env.update("nobody", {"finished": True})
    assert env.page(where="finished").first().env_params == '{"b": 2}'
    assert env.delete("env-2") and env.clear() == 2 and env.count() == 0


def test_blobs(spark, tmp_path):
    path = f"file://{tmp_path}/b/x.png"
    assert blobs.write_blob(spark, path, b"abc") == "image/png" and blobs.blob_exists(spark, path) and not blobs.blob_exists(spark, path + "x")
    assert blobs.read_blobs(spark, [path]).select("length").first()[0] == 3
    (tmp_path / "local.wav").write_bytes(b"12345")
    assert blobs.upload_file(spark, f"{tmp_path}/local.wav", f"file://{tmp_path}/b/y.wav").startswith("audio/") and blobs.read_blobs(spark, f"file://{tmp_path}/b", "*.wav").first().length == 5


def test_checkpoints_are_compared_and_set(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    a, b = FileCheckpoints(spark, path), FileCheckpoints(spark, path)
    a.initialize()
    at = lambda n, k=0: Checkpoint(pipeline_name="p|x", pipeline_version="1", source_table="s/t", target_table="t", bucket=k, committed_until_ms=n)
    a.save([at(1), at(1, 3)])
    assert b.load("p|x|1|s/t|t") == {0: at(1), 3: at(1, 3)}
    b.save([at(5, 3)])
    with pytest.raises(CheckpointError, match="another run"):
        a.save([at(2, 3)])
    a.save([at(7)])
    assert a.load("p|x|1|s/t|t") == {0: at(7), 3: at(5, 3)} == FileCheckpoints(spark, path).load("p|x|1|s/t|t")
    for k in range(5):
        a.save([at(8 + k)])
    assert FileCheckpoints(spark, path).load("p|x|1|s/t|t")[0] == at(12) and len(list((tmp_path / "state/records").glob("*%7C0/[0-9]*.json"))) == 2
    a.delete([at(0).id])
    assert list(FileCheckpoints(spark, path).load("p|x|1|s/t|t")) == [3] and {r.bucket for r in a.frame(spark).collect()} == {3}
    with pytest.raises(CheckpointError, match="committed_until_ms"):
        a.save([at(None)])
    Folder(spark, path).replace(f"records/{next((tmp_path / 'state/records').glob('*%7C3')).name}/2.json", '{"bucket": 3}')
    with pytest.raises(CheckpointError, match="fields"):
        b.load("p|x")
    Folder(spark, path).replace("schema.json", '{"type":"struct","fields":[]}')
    with pytest.raises(CheckpointError, match="other records"):
        b.initialize()


def test_clean_buckets_catch_up_though_another_failed(spark, tmp_path):
    landing, serving = landing_and_serving(spark, tmp_path)
    good = {"id": "g", "job_id": "d#h#m#t#0", "session_id": "s", "is_trainable": True, "response": "{}", "source_updated_at": 10}
    bad = next({**good, "id": "bad", "job_id": f"d#h#m#t#{k}", "response": "{oops"} for k in range(1, 20) if bucket_of(f"d#h#m#t#{k}", 4) != bucket_of("d#h#m#t#0", 4))
    landing.append(rows(spark, [good, bad, {**good, "id": "g2", "session_id": "s2", "source_updated_at": 150}]), 1)
    engine = Engine(landing, serving)
    own = bucket_of("d#h#m#t#0", 4)
    begun = Checkpoint(pipeline_name=LANDING_TO_SERVING.name, pipeline_version=LANDING_TO_SERVING.version, source_table="landing", target_table="serving", bucket=own, committed_until_ms=0, active_window_start_ms=0, active_window_end_ms=100, status="RUNNING")
    engine.checkpoints.save([begun])
    run = engine.run_incremental(LANDING_TO_SERVING, start_from=0, started_ms=200)
    assert run.failed_buckets == [bucket_of(bad["job_id"], 4)] and sorted(r.id for r in serving.read().collect()) == ["g", "g2"]
    states = {c.bucket: (c.status, c.committed_until_ms) for c in engine.checkpoints.load(LANDING_TO_SERVING.name).values()}
    assert states == {own: ("IDLE", 200), bucket_of(bad["job_id"], 4): ("FAILED", -1)}
    assert {r.session_id for r in run.keys.collect()} == {"s", "s2"}
