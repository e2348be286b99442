import json
import math
import os
from datetime import datetime

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera import catalogue, governance
from tessera.functions.hashing import hash_hex, hash_key
from tessera.operators import business, checks, contracts, vault
from tessera.plans import build, model
from tessera.plans.model import GITHUB, Link, Satellite, Vault

SF = "/root/testdata/sf0.001"
STAGED = "event_id string, actor string, repo string, action string, record_source string, occurred_at timestamp"
T = lambda d, h=0: datetime(2024, 1, d, h)


def plain(rows):
    def f(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v.isoformat() if hasattr(v, "isoformat") else v

    return sorted((tuple(map(f, r)) for r in rows), key=repr)


@pytest.mark.parametrize(
    "name",
    [
        "entity_activity_mart",
        "collaboration_mart",
        "pit_user_day",
        "eff_after_resend",
        "sat_standard_states",
        "envelope_valid",
        "dq_suite_summary",
        "ledger_stream_ingest",
        "stage_events",
        "contract_violations_by_type",
        "copy_into_ledger",
        "store_tables",
        "quarantine_to_json",
        "user_360_mart",
    ],
)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df = catalogue.QUERIES[name](spark, SF)
    r = con.execute(catalogue.ORACLES[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == sorted(df.columns)
    assert plain(df.select(*names).collect()) == plain(r.fetchall())


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert catalogue.FLAGSHIP in entry.queries() and set(catalogue.ORACLES) <= set(entry.oracle_sql())


@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAB |^1"), st.integers()), min_size=1, max_size=4))
def test_hash_ignores_case_and_blanks_at_the_ends(values):
    shouted = [v if v is None else f"  {str(v).upper()} " for v in values]
    assert hash_hex(values) == hash_hex(shouted)
    assert len(hash_hex(values)) == 64


def test_hash_is_one_definition(spark):
    rows = [("octocat", None), (" OctoCat ", ""), (None, "x"), ("a", "b")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", hash_key(["a", "b"]).alias("h")).collect()
    assert all(r["h"] == hash_hex([r["a"], r["b"]]) for r in got)
    with pytest.raises(ValueError, match="part"):
        hash_key([])


def test_standard_satellite_keeps_first_of_each_state_and_replay_adds_none(spark):
    df = spark.createDataFrame([("10", "x", "r", "A", "s", T(1)), ("9", "x", "r", "A", "s", T(1)), ("11", "x", "r", "B", "s", T(2)), ("12", "x", "r", "a", "s", T(3))], STAGED)
    sat = vault.standard_satellite(df, "hk", ["repo"], ["action"])
    assert {(r["action"], r["occurred_at"]) for r in sat.collect()} == {("A", T(1)), ("B", T(2))}
    assert vault.new_rows(sat, sat, ["hk", "hash_diff"]).count() == 0
    nulls = spark.createDataFrame([(None, 1)], "k string, v int")
    assert vault.new_rows(nulls, nulls, ["k"]).count() == 0


def effectivity(spark, rows, **kw):
    df = spark.createDataFrame(rows, STAGED)
    out = vault.effectivity_satellite(df, "lhk", ("hk_repo", ["repo"]), ("hk_actor", ["actor"]), F.col("action") == "assigned", **kw)
    return business.resolve_effectivity(out, ["lhk", "hk_repo", "hk_actor"]).orderBy("start_dts").collect()


def test_effectivity_supersession_resend_and_spelling(spark):
    rows = [("1", "u", "r", "assigned", "s", T(1)), ("2", "v", "r", "assigned", "s", T(2)), ("3", "w", "R ", "assigned", "s", T(3))]
    got = effectivity(spark, rows)
    assert [(r["start_dts"], r["end_dts"], r["is_active"]) for r in got] == [(T(1), T(2), False), (T(2), T(3), False), (T(3), datetime(9999, 12, 31), True)]
    assert effectivity(spark, rows + rows) == got
    assert [r["is_active"] for r in effectivity(spark, rows[:2] + rows[:2], compat=True)] == [False, False]


def test_point_in_time_with_ties_and_ghosts(spark):
    hub = spark.createDataFrame([("h",), ("empty",)], "hk string")
    sat = spark.createDataFrame([("h", "b", T(2, 5)), ("h", "a", T(2, 5)), ("h", "c", T(3, 1))], "hk string, hash_diff string, occurred_at timestamp")
    spine = spark.createDataFrame([(T(d).date(),) for d in (1, 2, 4)], "as_of_date date")
    got = {(r["hk"], r["as_of_date"].day): r["s_pit_ts"] for r in business.point_in_time(hub, "hk", {"s": sat}, spine).collect()}
    ghost = datetime(1900, 1, 1)
    assert got == {("h", 1): ghost, ("h", 2): T(2, 5), ("h", 4): T(3, 1), **{("empty", d): ghost for d in (1, 2, 4)}}
    assert [r["hash_diff"] for r in business.at_pointer(sat, "hk").orderBy("occurred_at").collect()] == ["b", "c"]


def test_sparse_pointers_are_those_of_the_grid(spark):
    t = catalogue.Tables(spark, SF)
    grid = {(r[0], r[1]): tuple(r) for r in t.pit("pit_repo_day").collect()}
    sparse = t.pit("pit_repo_day", sparse=True).collect()
    assert 0 < len(sparse) < len(grid)
    assert all(grid[r[0], r[1]] == tuple(r) for r in sparse)


def test_one_scan_extracts_what_a_scan_per_frame_does(spark):
    w = catalogue.adapter.wide(catalogue.adapter.events(spark, SF))
    frames = {t: w[t] for t in w.frames}
    for x in (*GITHUB.hubs, *GITHUB.links):
        one, many = (vault.extracted(s, x.sources) for s in (w, frames))
        assert plain(one.select(*sorted(one.columns)).collect()) == plain(many.select(*sorted(one.columns)).collect()), x.name
        assert one._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 1


def test_a_vault_is_a_file(tmp_path, monkeypatch):
    raw = model.read_file(model.DATA / "vault.json")
    assert model.vault_from(raw) == GITHUB
    path = tmp_path / "other.yaml"
    path.write_text(
        """
source: {landing_dir: in}
storage: {lakehouse_root: lake, run_dir: runs, reports_dir: /elsewhere}
spark: {shuffle_partitions: 3}
event_types: [Order]
hubs:
  - {name: hub_customer, business_keys: [customer], sources: [{frame: Order, columns: {customer: cust}}]}
satellites:
  - {name: sat_customer, parent: hub_customer, attributes: [city], sources: [{frame: Order, columns: {customer: cust, city: town}}]}
pits:
  - {name: pit_customer_day, hub: hub_customer, satellites: [sat_customer]}
marts:
  - {name: customers, grain: [customer], pit: pit_customer_day}
"""
    )
    other = model.load_vault(path)
    assert other.hub("hub_customer").key == "hk_customer" and other.satellite("sat_customer").kind == "standard" and other.mart("customers").pit == "pit_customer_day"
    monkeypatch.setenv(model.ROOT, "/lake root")
    s = model.load_settings(path)
    assert (s.landing_dir, s.lakehouse_root, s.reports_dir, s.shuffle_partitions) == ("/lake root/in", "/lake root/lake", "/elsewhere", 3)
    assert model.load_settings(path, "/x").run_dir == "/x/runs"
    for change, message in (({"hubs": []}, "hubs"), ({"event_types": ["Other"]}, "Order"), ({"marts": [{"name": "m", "grain": ["a"], "pit": "none"}]}, "pointer")):
        with pytest.raises(ValueError, match=message):
            model.vault_from(model.read_file(path) | change)
    with pytest.raises(KeyError, match="no hub"):
        GITHUB.hub("hub_nothing")


def test_a_declared_vault_is_loaded(spark):
    raw = {"event_types": ["Order"], "hubs": [{"name": "hub_customer", "business_keys": ["customer"], "sources": [{"frame": "Order", "columns": {"customer": "cust"}, "where": "cust <> 'x'"}]}]}
    df = spark.createDataFrame([("1", "a", "s", T(1)), ("2", "A ", "s", T(2)), ("3", "x", "s", T(3))], "event_id string, cust string, record_source string, occurred_at timestamp")
    ((hub, keys),) = build.raw_vault(model.vault_from(raw), {"Order": df}).values()
    assert keys == ["hk_customer"] and [r["customer"] for r in hub.collect()] == ["a"]


def test_suites_are_files_for_every_object(tmp_path):
    files = {s.table: s for s in checks.load_suites()}
    assert files == {s.table: s for s in checks.vault_suites(GITHUB)}
    names = {f"raw_vault/{x.name}" for x in (*GITHUB.hubs, *GITHUB.links, *GITHUB.satellites)} | {f"gold/{m.name}" for m in GITHUB.marts}
    assert names | {"bronze/github_events"} <= set(files)
    (tmp_path / "a.yaml").write_text("table: t\nlayer: gold\nfilter: a > 1\nchecks:\n  - {type: not_null, column: a}\n  - {type: unique, columns: [a, b], severity: warn}\n")
    (tmp_path / "note.txt").write_text("no suite")
    (s,) = checks.load_suites(tmp_path)
    assert s.filter == "a > 1" and [c.type for c in s.checks] == ["not_null", "unique"] and s.checks[1].columns == ("a", "b")
    (tmp_path / "b.yaml").write_text("table: t\nchecks:\n  - {type: sparkles}\n")
    with pytest.raises(ValueError, match="sparkles"):
        checks.load_suites(tmp_path)


def test_contract_files_and_their_versions(tmp_path):
    folder = model.DATA / "contracts"
    assert all(not v for v in contracts.check_folder(folder).values()) and len(contracts.load_contracts(folder)) == 6
    raw = model.read_file(folder / "watch_event_v1.json")
    assert contracts.from_dict(raw) == contracts.GITHUB_CONTRACTS["WatchEvent"]
    (tmp_path / "watch_event_v1.json").write_text(json.dumps(raw))
    raw["version"], raw["fields"][-1]["allowed_values"] = 2, ["stopped"]
    (tmp_path / "watch_event_v2.yaml").write_text(json.dumps(raw))  # JSON is YAML
    assert contracts.load_contracts(tmp_path)["watch_event"].version == 2
    assert contracts.check_folder(tmp_path) == {"watch_event": ["v1 to v2: action lost values ['started']"]}


def test_model_refuses_what_does_not_fit():
    with pytest.raises(ValueError, match="driving"):
        Link("link_a", ("hub_x",), driving_key="hub_y")
    with pytest.raises(ValueError, match="subsequence"):
        Satellite("s", "hub_x", (), kind="multi_active")
    with pytest.raises(KeyError, match="hub_nowhere"):
        Vault((), (Link("link_a", ("hub_nowhere",)),), ())
    assert GITHUB.key_columns(GITHUB.link("link_actor_issue")) == ("actor_login", "repo_name", "issue_number", "repo_name")


def test_contracts(spark):
    c = contracts.Contract(
        "c",
        1,
        (contracts.Field("event_id", "string", False), contracts.Field("at", "timestamp", False), contracts.Field("action", "string", True, ("opened", "closed"))),
        ("event_id",),
        "at",
    )
    df = spark.createDataFrame([("1", "2024-01-01", "opened"), (None, "2024-01-01", "opened"), ("3", "never", "gone"), ("4", "2024-01-01", None)], "event_id string, at string, action string")
    good, bad = contracts.enforce(df, c)
    assert [r["event_id"] for r in good.orderBy("event_id").collect()] == ["1", "4"]
    assert sorted(tuple(r["violations"]) for r in bad.collect()) == [("null_violation:at", "enum_violation:action"), ("null_violation:event_id",)]
    wider = contracts.Contract("c", 2, (*c.fields[:2], contracts.Field("action", "string", True, ("opened",)), contracts.Field("more", "double", False)), ("event_id",), "at")
    assert contracts.breaking_changes(c, c) == []
    assert contracts.breaking_changes(c, wider) == ["action lost values ['closed']", "new field more is not nullable"]
    with pytest.raises(ValueError, match="not be nullable"):
        contracts.Contract("c", 1, (contracts.Field("k", "string"),), ("k",), "k")
    with pytest.raises(ValueError, match="category"):
        contracts.Field("x", "string", pii=True)
    assert set(contracts.GITHUB_CONTRACTS) == set(catalogue.adapter.KINDS.values()) | {"ForkEvent", "ReleaseEvent"}


def test_checks(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1, T(1)), ("b", 2, T(2)), ("b", 3, T(3)), (None, 4, T(4))], "key string, value int, at timestamp")
    ref = spark.createDataFrame([("a",), (None,)], "pk string")
    tables = {"t": df, "ref": ref}
    monkeypatch.setenv(checks.REFERENCE_TIME, "2024-01-04T12:00:00+00:00")
    suite = checks.suite_from({"table": "t", "checks": [
        {"type": "not_null", "column": "key"}, {"type": "unique", "columns": ["key"], "severity": "warn"}, {
            "type": "accepted_values",
            "column": "key",
            "values": ["a"],
        }, {"type": "row_count_between", "min_rows": 1, "max_rows": 4},
        {"type": "freshness", "column": "at", "max_age_hours": 24}, {
            "type": "referential_integrity",
            "column": "key",
            "ref_table": "ref",
            "ref_column": "pk",
        }, {"type": "row_count_match", "ref_table": "ref", "tolerance": 2},
    ]})
    r = checks.run_suite(suite, tables.__getitem__)
    assert [x.status for x in r.results] == ["fail", "warn", "fail", "pass", "pass", "fail", "pass"]
    assert [x.observed.split()[0] for x in r.results[:3]] == ["1", "1", "2"]
    assert checks.run_suite(checks.Suite("t", suite.checks[4:5], filter="key = 'none'"), tables.__getitem__).results[0].passed is False
    with pytest.raises(ValueError, match="no check"):
        checks.Check("nothing")


def test_governance(tmp_path):
    tags = governance.pii_tags()
    assert "silver.raw_vault.hub_actor ALTER COLUMN actor_login" in tags and tags == governance.pii_tags()
    with pytest.raises(LookupError, match="placement"):
        governance.pii_tags(placements={})
    matrix = governance.access_matrix()
    assert matrix.count("\n") == 6 and "| analysts | group |" in matrix and "| svc-ingest | service_principal |" in matrix
    with pytest.raises(LookupError, match="nobody"):
        governance.access_matrix([("nobody", "catalog/gold", ("SELECT",))])
    inventory = governance.pii_inventory()
    assert "| assignee_login | quasi_identifier | issues_event | gold.marts.collaboration_mart.active_assignee |" in inventory
    first = [p.read_text() for p in governance.write_generated(tmp_path / "g")]
    assert first[0] == tags and inventory in first[1] and first == [p.read_text() for p in governance.write_generated(tmp_path / "g")]
