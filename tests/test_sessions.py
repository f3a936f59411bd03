import json
import random

import pytest
from pyspark.sql import functions as F

from skeinwork.functions.json import append_json, blob_links, decoded, status_not_200
from skeinwork.operators import sessions as S
from skeinwork.plans.pipeline import LANDING_ENRICHMENT, LANDING_TO_SERVING, Pipeline, pipeline
from skeinwork.plans.stages import BUILD_CHOSEN_TRACE, BUILD_SEARCH_TEXT, Stage, session_stage


def tails(lists):
    live = []
    for step, fps in lists:
        fits = [t for t in live if fps[: len(t[1])] == t[1]]
        if fits:
            live.remove(max(fits, key=lambda t: len(t[1])))
        live.append((step, fps))
    return sorted(s for s, _ in live)


def test_chain_tails_equal_a_plain_model(spark):
    r = random.Random(5)
    rows, want = [], {}
    cases = [[[1, 2], [1], [1, 2, 3]], [[], [1]], [[1], [1], [1]], [[], []]] + [[[r.randrange(2) for _ in range(r.randrange(5))] for _ in range(r.randrange(1, 8))] for _ in range(150)]
    for k, case in enumerate(cases):
        for step, m in enumerate(case):
            rows.append(("j", f"s{k}", step * 3, json.dumps([{"role": "u", "content": x} for x in m])))
        want[f"s{k}"] = tails([(i * 3, m) for i, m in enumerate(case)])
    df = spark.createDataFrame(rows, "job_id string, session_id string, step_id int, messages string")
    got = {x.session_id: sorted(x.tails) for x in S.chain_tails(df).collect()}
    assert got == want
    assert want["s0"] == [3, 6]


@pytest.mark.parametrize(
    "meta, bad",
    [
        (None, False), ("not json", False), ("{}", False), ('{"status_code":200}', False), ('{"status_code":" 200 "}', False), ('{"status_code":500}', True), ('{"status_code":200.0}', True), ('{"status_code":true}', True),
        ('{"status_code":null}', True), ('{"env_state":{"status_code":429}}', True), ('{"env_state":"{\\"status_code\\":503}"}', True), ('{"telemetry":"oops"}', False), ('{"telemetry":{"status_code":"200"}}', False), ("[1]", False),
    ],
)
def test_status_gate(spark, meta, bad):
    df = spark.createDataFrame([(meta,)], "m string")
    assert df.select(status_not_200(F.col("m"))).first()[0] is bad


def test_traces_links_and_decoding(spark):
    df = spark.createDataFrame([('[{"b":1,"a":2.50}]', '{"z":1,"y":[]}'), ("[]", '[1, 2]'), ("[ ]", '"x"')], "m string, r string")
    assert [r[0] for r in df.select(append_json(F.col("m"), F.col("r"))).collect()] == ['[{"b":1,"a":2.50},{"z":1,"y":[]}]', "[1, 2]", '["x"]']
    doc = json.dumps([{"content": [{"image_url": {"url": "s3://a/1"}}, {"input_audio": {"url": "s3://a/2", "x": [{"y": {"image_url": {"url": "s3://a/4"}}}]}}, {"image_url": {"url": "s3://a/1"}}, {"other": {"url": "s3://a/3"}}, {"image_url": "s3://a/5"}, {"image_url": {"url": "http://a/6"}}, {"image_url": [{"url": "s3://a/7"}]}]}])
    df = spark.createDataFrame([(doc, None), (doc[:-1], '{"input_audio":{"url":"s3://a/8"}}'), (None, None), ('"s3://a/9"', "{}")], "m string, r string")
    assert [r[0] for r in df.select(blob_links(F.col("m"), F.col("r"))).collect()] == [["s3://a/1", "s3://a/2", "s3://a/4"], ["s3://a/8"], [], []]
    got = spark.createDataFrame([('{"a":1}',), ("{oops",), (None,)], "m string").select(F.to_json(decoded(F.col("m"))).alias("x")).collect()
    assert [r.x for r in got] == ['{"a":1}', '"{oops"', None]


ROW = {"job_id": "d#h#m#t#x", "messages": '[{"role":"user","content":"q"}]', "response": '{"role":"assistant"}', "meta_json": "{}", "agent_model": "m", "source_updated_at": 1}


def records(spark, rows):
    kinds = "id string, job_id string, session_id string, step_id int, messages string, response string, meta_json string, agent_model string, rejected_trace string, is_session_completed boolean, is_trainable boolean, source_updated_at long, env_id string"
    names = [x.split()[0] for x in kinds.split(", ")]
    return spark.createDataFrame([tuple((ROW | r).get(n) for n in names) for r in rows], kinds)


def test_enrichment_gates_and_failures(spark):
    rows = records(spark, [
        {"id": "a0", "session_id": "a", "step_id": 0}, {"id": "a1", "session_id": "a", "step_id": 1, "is_session_completed": True, "messages": '[{"role":"user","content":"q"},{"x":1}]'},
        {"id": "b0", "session_id": "b", "step_id": 0, "is_session_completed": True, "meta_json": '{"status_code":500}'},
        {"id": "c0", "session_id": "c", "step_id": 0, "is_session_completed": True}, {"id": "c1", "session_id": "c", "step_id": 1},
        {"id": "d0", "session_id": "d", "step_id": 0, "is_session_completed": True, "messages": "{}"},
        {"id": "e0", "session_id": "e", "step_id": 0}, {"id": "e1", "session_id": "e", "step_id": 0},
    ])
    done = LANDING_ENRICHMENT.process(rows)
    assert {r.id: r.is_trainable for r in done.changes().collect()} == {"a0": False, "a1": True}
    assert sorted((r.session_id, r.stage, r.error) for r in done.failures.collect()) == [
        ("c", "update_is_trainable", "completed flag is not on the final row"), ("d", "update_is_trainable", "messages is not a JSON array"),
        ("e", "__validation__", "duplicate step_id"), ("e", "__validation__", "duplicate step_id"),
    ]


def test_publishing_voids_a_failing_session(spark):
    rows = records(spark, [
        {"id": "a0", "session_id": "a", "step_id": 0, "is_trainable": True}, {"id": "a1", "session_id": "a", "step_id": 1, "is_trainable": False},
        {"id": "b0", "session_id": "b", "step_id": 0, "is_trainable": True}, {"id": "b1", "session_id": "b", "step_id": 1, "is_trainable": True, "response": "{oops"},
        {"id": "c0", "session_id": "c", "step_id": 0, "is_trainable": True, "job_id": "x##y#z"},
    ])
    done = LANDING_TO_SERVING.process(rows)
    got = {r.id: (r.chosen_trace, r.search_text, r.tags) for r in done.records().collect()}
    trace = '[{"role":"user","content":"q"},{"role":"assistant"}]'
    assert got == {"a0": (trace, f"{trace}\nm\n{{}}", ["d", "h", "m", "t"]), "c0": (trace, f"{trace}\nm\n{{}}", None)}
    assert [(r.id, r.stage, r.error) for r in done.failures.collect()] == [("b1", "build_chosen_trace", "b1: response is not JSON")]


def test_python_stage_and_its_contract(spark):
    def upper(rows, context):
        if rows[0]["session_id"] == "bad":
            return {"nope": {"agent_model": "x"}}
        return {r["id"]: {"agent_model": f"{r['agent_model']}-{context.version}-{len(rows)}"} for r in rows if r["step_id"] == 0}

    p = Pipeline("shout", "7", "landing", (session_stage("upper", "1", ("agent_model",), ("agent_model",), upper),))
    rows = records(spark, [{"id": "a0", "session_id": "a", "step_id": 0}, {"id": "a1", "session_id": "a", "step_id": 1}, {"id": "b0", "session_id": "bad", "step_id": 0}])
    done = p.process(rows)
    assert [(r.id, r.changed, r.agent_model) for r in done.changes().collect()] == [("a0", ["agent_model"], "m-7-2")]
    assert [(r.session_id, "unknown id" in r.error) for r in done.failures.collect()] == [("bad", True)]


def test_dag_rules():
    one = lambda name, outs, depends=(): Stage(name, "1", (), outs, lambda r, c: r, depends)
    assert [s.name for s in Pipeline("p", "1", "serving", (BUILD_SEARCH_TEXT, BUILD_CHOSEN_TRACE)).ordered()] == ["build_chosen_trace", "build_search_text"]
    for stages in ((one("a", ("id",)),), (one("a", ("tags",)), one("b", ("tags",))), (one("a", ("nope",)),), (one("a", ("tags",), ("b",)),), (one("a", ("tags",), ("b",)), one("b", ("search_text",), ("a",))), ()):
        with pytest.raises(ValueError):
            Pipeline("p", "1", "serving", stages)
    with pytest.raises(KeyError):
        pipeline("nope")
