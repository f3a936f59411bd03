import hashlib
import json
import uuid

import pytest
from pyspark.sql import functions as F

from skeinwork.functions.json import deterministic_id, expanded_json, json_rows, with_member
from skeinwork.plans.checks import ready_to_rebuild, rebuilt, smoke_test
from skeinwork.schema import RECORD
from skeinwork.sources.store import Table

from .test_store import rows


def test_json_members_and_expansion(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{}",), ("[1]",), ("oops \"x\"",), (None,)], "m string")
    got = [json.loads(r[0]) for r in df.select(with_member(F.col("m"), "k", F.lit("2"))).collect()]
    assert got == [{"a": 1, "k": 2}, {"k": 2}, {"value": [1], "k": 2}, {"value": 'oops "x"', "k": 2}, {"value": None, "k": 2}]
    df = spark.createDataFrame([('{"a":"{\\"b\\":\\"[1]\\"}"}',), ("{oops",), (None,)], "m string")
    assert [r[0] for r in df.select(expanded_json("m")).collect()] == ['{"a":{"b":[1]}}', "{oops", None]


def test_ids_follow_content_not_spelling(spark):
    texts = ['[{"role":"u","content":{"b":1,"a":[2.5,null]}}]', ' [ {"content": {"a": [2.5, null], "b": 1}, "role": "u"} ]', '[{"role":"u","content":{"b":1,"a":[null,2.5]}}]', "{oops", None, None]
    df = spark.createDataFrame([(t, k, "m" if k < 5 else "other", "{}") for k, t in enumerate(texts)], "messages string, created_at int, agent_model string, meta_json string")
    got = [r[0] for r in df.select(deterministic_id(df)).collect()]
    spelled = [json.dumps(json.loads(texts[0]), sort_keys=True, ensure_ascii=False), None, json.dumps(json.loads(texts[2]), sort_keys=True), '"{oops"', '{"agent_model": "m"}', '{"agent_model": "other"}']
    assert got == ["evt_" + hashlib.md5((t or spelled[0]).encode()).hexdigest()[:16] for t in spelled] and got[0] == got[1] != got[2]
    assert [r[0] for r in df.where("messages is null").select(deterministic_id(df.drop("messages", "agent_model"))).collect()] == ["evt_" + hashlib.md5(b"{}").hexdigest()[:16]] * 2


def test_json_rows(spark):
    df = spark.createDataFrame([("a", '{"x":"[1,{\\"y\\":\\"{}\\"}]"}', float("nan"), bytearray(b"\xff"), [1.0, float("nan")]), ("b", "{oops", 2.0, None, None), ("c", None, None, None, None)], "id string, messages string, reward double, raw binary, list array<double>")
    got = [json.loads(r.value) for r in json_rows(df, ("messages",)).collect()]
    assert got[0] == {"id": "a", "messages": {"x": [1, {"y": {}}]}, "reward": None, "raw": {"encoding": "base64", "data": "/w=="}, "list": [1.0, None]}
    assert got[1] == {"id": "b", "messages": "{oops", "reward": 2.0, "raw": None, "list": None} and got[2]["messages"] is None
    assert json_rows(df.select("id"), ("messages",)).first().value == '{"id":"a"}' and json_rows(df.limit(0), ("messages",)).count() == 0


def test_round_trip_and_gates(spark, tmp_path):
    source = rows(spark, [{"id": f"r{k}", "job_id": f"j{k % 2}"} for k in range(12)]).withColumn("dt", F.lit("2024-01-01")).withColumn("source_updated_at", F.lit(1).cast("long"))
    target = Table.create(spark, f"t_{uuid.uuid4().hex[:12]}", RECORD, buckets=4)
    assert smoke_test(source, target, 5) == {"job_id": "j0-smoke", "rows": 5}
    with pytest.raises(RuntimeError):
        smoke_test(source, target, 50)
    target.append(source)
    with pytest.raises(RuntimeError):
        smoke_test(source, target, 5)
    whole = spark.createDataFrame(target.read().drop("bucket").collect(), RECORD)
    assert ready_to_rebuild(target, whole, RECORD, 4) == []
    assert ready_to_rebuild(target, whole.limit(3), RECORD, 8) == ["4 buckets, not 8", "12 rows, 3 in the archive"]
    for other in (whole.withColumn("agent_model", F.lit("z")), whole.drop("tags"), whole.limit(3)):
        with pytest.raises(RuntimeError):
            rebuilt(target, other, RECORD, 4)
    assert target.count() == 12
    again = rebuilt(target, whole, RECORD, 4)
    assert again.name == target.name and again.count() == 0 and again.append(whole) == 12
