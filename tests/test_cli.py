import json
import uuid

import pytest
from pyspark.sql import functions as F

from skeinwork import cli, metrics
from skeinwork.schema import RECORD
from skeinwork.sources.store import list_tables

from .test_store import rows


def landing(spark):
    return cli.Workspace(spark, cli.settings("test")).landing


def serving(spark):
    return cli.Workspace(spark, cli.settings("test")).serving


@pytest.fixture
def root(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("SKEINWORK_ROOT", f"file://{tmp_path}")
    monkeypatch.setenv("SKEINWORK_DATABASE", "d" + tmp_path.name.replace("-", "_") + uuid.uuid4().hex[:6])
    assert cli.main(["create"], spark) == 0
    table = landing(spark)
    table.append(rows(spark, [{"id": "a0", "session_id": "a", "source_updated_at": 10}, {"id": "a1", "session_id": "a", "step_id": 1, "is_session_completed": True, "messages": '[{"role":"user","content":"q"},1]', "source_updated_at": 10, "tags": ["x", "y"]}, {"id": "b0", "session_id": "b", "messages": "{oops", "source_updated_at": 10}]), 1)
    return tmp_path


def test_reports_and_changes(spark, root, capsys):
    assert cli.main(["count", "--where", "session_id = 'a'"], spark) == 0
    assert capsys.readouterr().out.strip() == "2"
    assert cli.main(["query", "--where", "id = 'b0'", "--columns", "id,messages,tags"], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"id": "b0", "messages": "{oops"}
    assert cli.undecodable(landing(spark).read()).first().messages == 1
    for command in (["tags"], ["duplicates"], ["describe"], ["undecodable"], ["tables"], ["maintain"], ["maintain", "--bucket", "d#h#m#t#x", "--no-create-missing"]):
        assert cli.main(command, spark) == 0
    capsys.readouterr()
    assert cli.main(["update", "--where", "id = 'b0'", "--set", '{"messages": [1, 2], "is_trainable": null}', "--yes"], spark) == 0
    assert capsys.readouterr().out.split("\n")[:2] == ['{"would_change": 1}', '{"left": 0}']
    assert cli.main(["delete", "--where", "id = 'b0'"], spark) == 0 and landing(spark).count() == 3
    assert cli.main(["delete", "--where", "id = 'b0'", "--yes"], spark) == 0 and landing(spark).count() == 2


def test_json_output_and_named_sessions(spark, root, capsys):
    assert cli.main(["query", "--where", "job_id = 'd#h#m#t#x' and id = 'a0'", "--columns", "id,meta_json,reward", "--output", f"file://{root}/out"], spark) == 0
    assert [json.loads(r.value) for r in spark.read.text(f"file://{root}/out").collect()] == [{"id": "a0", "meta_json": {}, "reward": None}]
    capsys.readouterr()
    assert cli.main(["run", "--pipeline", "landing_enrichment_pipeline", "--session", "d#h#m#t#x", "a", "--dry-run"], spark) == 0
    assert json.loads(capsys.readouterr().out)["rows_written"] == 2
    with pytest.raises(SystemExit):
        cli.main(["run", "--session", "j", "s", "--buckets", "1"], spark)
    for wrong in (["drop", "--confirm", "other"], ["maintain", "--table", "environments"]):
        with pytest.raises(SystemExit):
            cli.main(wrong, spark)
    assert cli.main(["drop", "--confirm", "landing_test"], spark) == 0 and "landing_test" not in list_tables(spark, cli.settings("test").database)


def test_run_hands_changed_sessions_on(spark, root, capsys):
    with pytest.raises(SystemExit):
        cli.main(["run", "--filter", "true", "--jobs", "x"], spark)
    with pytest.raises(SystemExit):
        cli.main(["--profile", "production", "run"], spark)
    assert cli.main(["run", "--start-from", "0", "--report-dir", f"file://{root}/reports"], spark) == 0
    served = serving(spark).read()
    assert [r.id for r in served.collect()] == ["a1"] and len(list((root / "reports").glob("*.json"))) == 2
    assert served.first().search_text.startswith('[{"role"') and served.schema["tags"].dataType == RECORD["tags"].dataType


def test_times_names_and_metrics(spark, tmp_path):
    assert [cli.parse_time(x) for x in ("1700000000", "1700000000000", "2023-11-14T22:13:20Z", "2023-11-14T22:13:20")] == [1_700_000_000_000] * 4
    assert cli.safe_name("a b/c::d ") == "a_b_c_d"
    path = f"{tmp_path}/m.jsonl"
    with metrics.timed("read", path) as m:
        m["rows"] = 5
    with pytest.raises(ValueError), metrics.timed("read", path):
        raise ValueError
    with metrics.timed("lost", "/nowhere/x"):
        pass
    with metrics.timed("copy", path) as m:
        metrics.watched(spark.createDataFrame([("é", 1, ["ab", "c"]), (None, None, None)], "s string, n long, l array<string>"), m).write.format("noop").mode("overwrite").save()
    assert (m["rows"], m["bytes"]) == (2, 13) and m["mb_per_s"] > 0
    got = {r.api: r for r in metrics.summary(spark, path).collect()}
    assert (got["read"].calls, got["read"].errors, got["read"].rows) == (2, 1, 5)
    assert (got["copy"].bytes, got[None].calls, got[None].rows) == (13, 3, 7) and got["copy"].mb_per_s > 0
