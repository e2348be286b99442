"""Files to marts, on a small feed."""

import json
import os
import shutil
import subprocess
import sys

import pytest

from tessera import cli, runs
from tessera.cli import _enforcer
from tessera.operators import business, checks
from tessera.plans import build
from tessera.plans.model import GITHUB
from tessera.sources import generator, ingest
from tessera.sources.store import TableStore


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake 1+2")  # a path that Spark escapes
    made = generator.generate(root / "landing", events=250, seed=7, corrupt=0.04)
    store = TableStore(spark, str(root))
    first = ingest.copy_into(store, str(root / "landing"), "r1")
    return store, root, made, first


def test_copy_into_is_exactly_once(lake):
    store, root, made, first = lake
    assert first["lines"] == 250 and first["events"] + first["quarantined"] == 250 and first["files_loaded"] == made["files"]
    assert first["quarantined"] == made["corrupt"] > 0
    assert ingest.copy_into(store, str(root / "landing"), "r2") == {"files_loaded": 0, "lines": 0, "events": 0, "quarantined": 0}
    (root / "landing" / "2030-01-01-0.ndjson").write_text("")
    assert ingest.copy_into(store, str(root / "landing"), "r3")["files_loaded"] == 0  # an empty file holds nothing
    assert ingest.copy_into(store, str(root / "landing"), "r4")["files_loaded"] == 0


def test_a_lost_ledger_entry_loads_nothing_twice(lake):
    store, root, _, first = lake
    shutil.rmtree(root / "bronze" / "ops")
    again = ingest.copy_into(store, str(root / "landing"), "r5")
    assert again["events"] == again["quarantined"] == 0
    assert store.read(ingest.EVENTS).count() == first["events"]


def test_vault_is_idempotent_and_marts_hold_their_grain(lake):
    store, root, _, first = lake
    added = build.load_raw_vault(store, GITHUB, _enforcer("r"))
    assert added["sat_actor_repo_event"] == first["events"] - added["quarantine"]
    assert build.verify_idempotent(store, GITHUB, _enforcer("r")) == {}
    assert all(build.build_business_vault(store).values())
    assert all(build.build_gold(store).values())
    for name in ("raw_vault/link_actor_repo", "raw_vault/sat_actor_repo_event", "gold/collaboration_mart", "gold/developer_360_mart", "gold/repo_activity_mart"):
        r = checks.run_suite(next(s for s in checks.vault_suites(GITHUB) if s.table == name), store.read)
        assert r.count("fail") == 0, [(x.check.describe(), x.observed) for x in r.results]
    report = json.loads(checks.write_report(r, root / "dq").read_text())
    assert report["pass_rate"] == 1.0


def test_metrics_record_failures_and_raise(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(RuntimeError, match="boom"), runs.track_step(store, "run-1", "p", "s"):
        raise RuntimeError("boom")
    with runs.track_step(store, "run-2", "p", "s") as m:
        m.rows_written = 3
    rows = runs.latest_run(store.read(runs.TABLE)).collect()
    assert [(r["run_id"], r["status"], r["rows_written"]) for r in rows] == [("run-2", "success", 3)]
    assert "run-2" in runs.text_report(rows) and "<table>" in runs.html_report(rows)


def test_store_publishes_whole_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.read("t")
    assert store.append("t", spark.createDataFrame([(1,)], "a int")) == 1
    assert store.append("t", spark.createDataFrame([(2, "x")], "a int, b string")) == 1
    assert sorted(map(tuple, store.read("t").collect())) == [(1, None), (2, "x")]
    assert store.overwrite("t", store.read("t").where("a = 2")) == 1
    assert store.insert_only("t", spark.createDataFrame([(2, "y"), (3, "z"), (3, "z")], "a int, b string"), ["a"]) == 1
    assert store.read("t").count() == 2


def test_compaction_and_vacuum_keep_the_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for i in range(4):
        store.append("t", spark.createDataFrame([(i, f"d{i % 2}")], "a int, d string"), ["d"])
    rows = sorted(map(tuple, store.read("t").collect()))
    assert store.read("t")._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 1  # one scan for four folders
    before = store.version("t")
    assert store.read("t", after=1).count() == 2 and store.read("t", after=before).count() == 0
    assert store.compact("t", 1) == 4 and sorted(map(tuple, store.read("t").collect())) == rows
    assert store.read("t", after=before).count() == 4  # written anew: all rows
    assert store.vacuum("t", keep=2) == 0 and store.vacuum("t") == 4
    assert sorted(map(tuple, store.read("t").collect())) == rows
    folders = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("load=")]
    assert len(folders) == 1 and {p.name for p in folders[0].iterdir() if p.is_dir()} == {"d=d0", "d=d1"}


def test_one_of_two_writers_loses(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append("t", spark.createDataFrame([(1,)], "a int"))
    claim = tmp_path / "t" / "_commits" / ".claim-1"
    claim.write_text("")
    with pytest.raises(RuntimeError, match="another writer"):
        store.append("t", spark.createDataFrame([(2,)], "a int"))
    assert store.read("t").count() == 1
    claim.unlink()
    assert store.append("t", spark.createDataFrame([(2,)], "a int")) == 1


def test_loads_in_parts_equal_one_load(spark, tmp_path):
    generator.generate(tmp_path / "all", events=160, seed=5, corrupt=0.0)
    files = sorted((tmp_path / "all").iterdir(), key=lambda p: [int(x) for x in p.stem.split("-")])
    parts, whole = TableStore(spark, str(tmp_path / "parts")), TableStore(spark, str(tmp_path / "whole"))
    (tmp_path / "some").mkdir()
    for half in (files[: len(files) // 2], files[len(files) // 2 :]):
        for f in half:
            shutil.copy(f, tmp_path / "some" / f.name)
        ingest.copy_into(parts, str(tmp_path / "some"), "r")
        added = build.load_raw_vault(parts, GITHUB, _enforcer("r"))
    assert added["sat_actor_repo_event"] < 160
    assert all(n == 0 for n in build.load_raw_vault(parts, GITHUB, _enforcer("r")).values())  # nothing new
    ingest.copy_into(whole, str(tmp_path / "all"), "r")
    build.load_raw_vault(whole, GITHUB, _enforcer("r"))
    for name in ("hub_actor", "link_actor_repo", "sat_pull_request_details", "sat_actor_repo_event"):
        a, b = (sorted(map(repr, s.read(f"raw_vault/{name}").drop("load_dts").collect())) for s in (parts, whole))
        assert a == b, name
    keys = ["lhk_issue_assignee", "hk_issue", "hk_actor"]
    a, b = (sorted(map(repr, business.resolve_effectivity(s.read("raw_vault/eff_sat_issue_assignee"), keys).collect())) for s in (parts, whole))
    assert a == b  # an interval that was open is resolved to its end
    assert build.verify_idempotent(parts, GITHUB, _enforcer("r")) == {}


def test_checks_by_the_command_line(spark, tmp_path, capsys, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    store.append("t", spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string"))
    monkeypatch.setattr(cli, "session", lambda *a, **k: spark)
    suites = tmp_path / "suites"
    suites.mkdir()
    (suites / "t.json").write_text(json.dumps({"table": "t", "layer": "x", "checks": [{"type": "not_null", "column": "v"}, {"type": "not_null", "column": "k", "severity": "warn"}]}))
    assert cli.main(["dq", "--root", str(tmp_path), "--suites", str(suites)]) == 0
    assert "warn: t: not_null" in capsys.readouterr().out
    (suites / "t.json").write_text(json.dumps({"table": "t", "checks": [{"type": "not_null", "column": "k"}]}))
    assert cli.main(["dq", "--root", str(tmp_path), "--suites", str(suites)]) == 1
    assert cli.main(["governance", "--root", str(tmp_path)]) == 0 and (tmp_path / "governance" / "pii_tags.sql").exists()
    assert cli.main(["report", "--root", str(tmp_path)]) == 0
    assert "dq" in capsys.readouterr().out and "<table>" in (tmp_path / "report.html").read_text()


def test_demo_runs_all_steps(tmp_path):
    env = os.environ | {"PYTHONPATH": os.getcwd()}
    r = subprocess.run([sys.executable, "-m", "tessera.cli", "demo", "--root", str(tmp_path), "--events", "60", "--master", "local[2]"], env=env, capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stdout[-2000:] + r.stderr[-2000:]
    assert all(f"{step}: ok" in r.stdout for step in cli.DEMO)


def test_generator_is_deterministic(tmp_path):
    a, b = (generator.generate(tmp_path / n, 300, 3, 0.1) for n in "ab")
    assert a == b
    assert all((tmp_path / "a" / p.name).read_bytes() == p.read_bytes() for p in (tmp_path / "b").iterdir())
    generator.generate(tmp_path / "c", 300, 3, 0.0)
    clean = [json.loads(x)["id"] for p in (tmp_path / "c").iterdir() for x in p.read_text().splitlines()]
    assert len(set(clean)) == 300
