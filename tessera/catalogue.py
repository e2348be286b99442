"""Every query of the vault engine over the test tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_diff, hash_key
from tessera.operators import business, checks, contracts, marts, vault
from tessera.oracles import ORACLES
from tessera.plans import build
from tessera.plans.build import raw_vault
from tessera.plans.model import GITHUB
from tessera.session import shared_dir
from tessera.sources import adapter, ingest
from tessera.sources.staging import EVENT_TYPES, classified, split, stage
from tessera.sources.store import TableStore

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]

FLAGSHIP = "entity_activity_mart"
EFF_KEYS = ["lhk_issue_assignee", "hk_issue", "hk_actor"]


class Tables:
    """The vault over one folder of test tables; objects are built as they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, resend: bool = False):
        self.spark, self.dir = spark, sf_dir
        e = adapter.events(spark, sf_dir)
        self.events = e.union(e.where("event_id % 3 = 0")) if resend else e
        self.raw = {k: df for k, (df, _) in raw_vault(GITHUB, adapter.wide(self.events)).items()}

    def table(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.dir, name)

    def resolved(self) -> DataFrame:
        return business.resolve_effectivity(self.raw["eff_sat_issue_assignee"], EFF_KEYS)

    def pit(self, name: str, sparse: bool = False) -> DataFrame:
        hub, sats = GITHUB.pits[name]
        key, mas = GITHUB.hub(hub).key, self.raw["sat_actor_repo_event"]
        active = marts.active_days(mas, self.raw["link_actor_repo"], key) if sparse else None
        return business.point_in_time(self.raw[hub], key, {s: self.raw[s] for s in sats}, business.date_spine(mas), active)

    def bridge(self) -> DataFrame:
        return business.bridge(*[self.raw[n] for n in ("hub_actor", "hub_repo", "hub_pull_request", "hub_issue", "link_actor_pull_request", "link_actor_issue")], self.resolved())

    def pr_life(self) -> DataFrame:
        return business.pr_lifecycle(self.raw["sat_pull_request_details"])

    def issue_life(self) -> DataFrame:
        return business.issue_lifecycle(self.raw["sat_issue_details"], self.resolved())


QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def hash_keys_user_entity(spark, d):
    e = adapter.events(spark, d).withColumn("entity", F.concat(F.lit(" k/"), "k"))
    return e.select(
        "event_id",
        hash_key(["user_id"]).alias("hk_user"),
        hash_key(["user_id", "entity"]).alias("lhk"),
        hash_diff([F.nullif(F.col("event_type"), F.lit("error")), F.col("k")]).alias("hash_diff"),
    )


@query
def envelope_valid(spark, d):
    valid, _ = split(classified(adapter.lines(adapter.events(spark, d)), adapter.TYPES))
    return valid.select("event_key", "event_type", (F.col("created_ts").cast("long") * 1000).alias("ts_ms"))


@query
def envelope_quarantine_reasons(spark, d):
    _, bad = split(classified(adapter.lines(adapter.events(spark, d)), adapter.TYPES))
    return bad.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def envelope_reasons_compat(spark, d):
    df = classified(adapter.lines(adapter.events(spark, d)), adapter.TYPES, compat=True)
    return df.groupBy(F.coalesce("error_reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _landed(spark, d, name: str) -> str:
    """A lakehouse root whose folder `landing` has the feed's lines as text."""
    root = shared_dir(spark, name)
    adapter.feed(adapter.events(spark, d)).select("value").write.option("compression", "none").text(f"{root}/landing")
    return root


def _staged(spark, d):
    """The frames of the sound lines of the feed, as read from files."""
    valid, _ = split(classified(ingest.read_lines(spark, [f"{_landed(spark, d, 'feed')}/landing"]), EVENT_TYPES))
    return stage(valid)


STAGED = {
    "actor_login": "string", "actor_display_login": "string", "repo_name": "string", "action": "string", "push_size": "int", "ref_name": "string", "pr_number": "int", "pr_title": "string", "pr_merged": "boolean", "head_ref": "string",
    "base_repo_owner": "string", "base_repo_license": "string", "base_repo_stargazers": "bigint", "issue_number": "int", "issue_state": "string", "issue_comments": "int", "assignee_login": "string",
}


@query
def stage_events(spark, d):
    """Lines of nested JSON, classified, parsed by type and laid flat."""
    columns = [lambda df, c=c, k=k: (F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in STAGED.items()]
    return vault.union([df.select("event_id", "record_source", F.col("occurred_at").cast("long").alias("occurred_s"), *[f(df) for f in columns]) for df in _staged(spark, d).values()])


@query
def contract_violations_by_type(spark, d):
    """What the feed's contracts reject, by event type and violation."""
    enforce = lambda t, df: (lambda good, bad: (good, bad.select("event_id", "violations")))(*contracts.enforce(df, contracts.GITHUB_CONTRACTS[t]))
    _, bad = build.enforced(_staged(spark, d), enforce)
    return bad.select("event_type", F.explode("violations").alias("violation")).groupBy("event_type", "violation").agg(F.count(F.lit(1)).alias("n"))


def _table(spark, rows: list[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame([(k, int(n)) for k, n in rows], "what string, n long")


@query
def copy_into_ledger(spark, d):
    """Two runs of the exactly-once load of files; what they report, and what bronze, quarantine and ledger then hold."""
    root = _landed(spark, d, "copy-into")
    store, rows = TableStore(spark, root), []
    for run in ("first", "second"):
        n = ingest.copy_into(store, f"{root}/landing", run, suffix=".txt")
        rows += [(f"{run}/{k}", n[k]) for k in ("lines", "events", "quarantined")]
    count = F.count(F.lit(1)).alias("n")
    events, bad, ledger = (store.read(t) for t in (ingest.EVENTS, ingest.QUARANTINE, ingest.LEDGER))
    return vault.union(
        [
            _table(spark, rows),
            events.groupBy(F.concat(F.lit("event/"), "event_type").alias("what")).agg(count),
            events.agg(F.count_distinct("event_key").alias("n")).select(F.lit("keys").alias("what"), "n"),
            bad.groupBy(F.concat(F.lit("bad/"), "error_reason").alias("what")).agg(count),
            ledger.agg(F.sum("rows_loaded").alias("n")).select(F.lit("ledger").alias("what"), "n"),
            ledger.join(events.select("source_ref").distinct(), F.col("file_path") == F.col("source_ref"), "left_anti").agg(count).select(F.lit("files without events").alias("what"), "n"),
        ]
    )


@query
def store_tables(spark, d):
    """Appends, conditional appends with a new column, an insert-only replay, compaction and an overwrite: rows and sums after each."""
    store, e = TableStore(spark, shared_dir(spark, "store")), adapter.events(spark, d)
    t, out = "events", []

    def state(step: str, n: int) -> None:
        types = F.count_distinct("event_type") if "event_type" in store.read(t).columns else F.lit(0).cast("long")
        r = store.read(t).agg(F.count(F.lit(1)), F.sum("event_id"), types).first()
        out.append((step, n, *r))

    old = e.select("event_id", "user_id")
    state("append", store.append(t, old.where("event_id % 4 = 0")))
    state("insert_only", store.insert_only(t, e.select("event_id", "user_id", "event_type").where("event_id % 2 = 0"), ["event_id"]))
    state("replay", store.insert_only(t, e.select("event_id", "user_id", "event_type").where("event_id % 2 = 0"), ["event_id"]))
    state("compact", store.compact(t))
    state("vacuum", store.vacuum(t))
    state("overwrite", store.overwrite(t, store.read(t).where("event_id % 8 = 0"), ["event_type"]))
    return spark.createDataFrame(out, "step string, written long, n_rows long, id_sum long, n_types long")


@query
def vault_load_counts(spark, d):
    """Two loads of the raw vault, from two halves of the feed as they come to bronze; rows added to each object by each."""
    root = shared_dir(spark, "vault-load")
    store, rows = TableStore(spark, root), []
    enforce = lambda t, df: (lambda good, bad: (good, contracts.quarantine_rows(bad, "run")))(*contracts.enforce(df, contracts.GITHUB_CONTRACTS[t]))
    e = adapter.events(spark, d)
    middle = e.agg(F.max("event_id")).first()[0] // 2
    for load, half in (("first", e.where(F.col("event_id") <= middle)), ("second", e.where(F.col("event_id") > middle))):
        adapter.feed(half).select("value").write.text(f"{root}/landing/{load}")
        valid, _ = split(classified(ingest.read_lines(spark, [f"{root}/landing/{load}"]), EVENT_TYPES))
        store.append(ingest.EVENTS, valid.select("event_key", "raw_value", "event_type", "source_ref"), ["event_type"])
        rows += [(f"{load}/{k}", n) for k, n in build.load_raw_vault(store, GITHUB, enforce).items()]
    return _table(spark, rows)


EVENT_CONTRACT = contracts.Contract(
    "event", 1,
    (
        contracts.Field("event_id", "bigint", False),
        contracts.Field("event_type", "string", False, ("click", "view", "purchase")),
        contracts.Field("k", "integer"),
        contracts.Field("ts", "timestamp", False),
    ),
    ("event_id",), "ts",
)


def _contracted(spark, d):
    return adapter.events(spark, d).select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "k", "ts")


@query
def contract_violations(spark, d):
    _, bad = contracts.enforce(_contracted(spark, d), EVENT_CONTRACT)
    return bad.select("event_id", F.array_join("violations", ";").alias("violations"))


@query
def contract_valid(spark, d):
    good, _ = contracts.enforce(_contracted(spark, d), EVENT_CONTRACT)
    return good.select("event_id", "event_type", "k")


@query
def quarantine_to_json(spark, d):
    _, bad = contracts.enforce(_contracted(spark, d), EVENT_CONTRACT)
    bad = bad.withColumns({"record_source": F.lit("events"), "occurred_at": F.col("ts")})
    return contracts.quarantine_rows(bad, "run").select("event_id", "record_source", "violations", "quarantined_run_id")


def _raw(name: str, query_name: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return Tables(spark, d).raw[name]

    QUERIES[query_name] = run


for _object, _name in {
    "hub_actor": "hub_user", "hub_repo": "hub_entity", "hub_pull_request": "hub_pull_request", "hub_issue": "hub_issue",
    "link_actor_repo": "link_user_entity", "link_actor_pull_request": "link_actor_pull_request", "link_actor_issue": "link_actor_issue", "link_issue_assignee": "link_issue_assignee",
    "sat_actor_profile": "sat_actor_profile", "sat_repo_profile": "sat_repo_profile", "sat_repo_stats": "sat_repo_stats", "sat_pull_request_details": "sat_standard_states", "sat_issue_details": "sat_issue_details",
    "eff_sat_issue_assignee": "eff_intervals",
}.items():
    _raw(_object, _name)


@query
def hub_lineitem_composite(spark, d):
    cols = adapter.table(spark, d, "lineitem")
    rows = cols.withColumns({"event_id": F.concat_ws("/", "l_partkey", "l_suppkey"), "record_source": F.concat(F.lit("lineitem."), "l_returnflag"), "occurred_at": F.col("l_shipdate")})
    return vault.hub(rows, "hk_lineitem", ["l_orderkey", "l_linenumber"])


@query
def link_customer_order_nation(spark, d):
    o = adapter.table(spark, d, "orders").join(adapter.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.withColumns({"event_id": F.col("o_orderkey").cast("string"), "record_source": F.lit("orders"), "occurred_at": F.col("o_orderdate")})
    return vault.link(o, "lhk", {"hk_customer": ["o_custkey"], "hk_order": ["o_orderkey"], "hk_nation": ["c_nationkey"]})


@query
def sat_fast_slow_split(spark, d):
    e = adapter.events(spark, d).withColumns({"event_id": F.col("event_id").cast("string"), "record_source": F.lit("events"), "occurred_at": F.col("ts"), "bucket": F.floor(F.col("value") / 10)})
    parts = [vault.standard_satellite(e, "hk_entity", ["k"], [a]).select("hk_entity", "hash_diff", F.lit(name).alias("satellite"), F.col(a).cast("string").alias("state"), "occurred_at") for name, a in (("slow", "event_type"), ("fast", "bucket"))]
    return vault.union(parts)


@query
def mas_user_entity_event(spark, d):
    return Tables(spark, d, resend=True).raw["sat_actor_repo_event"]


@query
def eff_resolved(spark, d):
    return Tables(spark, d).resolved()


@query
def eff_after_resend(spark, d):
    return Tables(spark, d, resend=True).resolved()


@query
def insert_only_replay(spark, d):
    """A first load of half of the events' states, then one of all, then the same again."""
    e = adapter.events(spark, d)
    half, whole = (raw_vault(GITHUB, adapter.wide(x))["link_actor_repo"][0] for x in (e.where("event_id % 2 = 0"), e))
    first = vault.new_rows(half, None, ["lhk_actor_repo"])
    second = vault.new_rows(whole, first, ["lhk_actor_repo"])
    third = vault.new_rows(whole, first.unionByName(second), ["lhk_actor_repo"])
    return vault.union([x.agg(F.count(F.lit(1)).alias("rows_added")).withColumn("load", F.lit(i)) for i, x in enumerate((first, second, third), 1)])


@query
def date_spine(spark, d):
    return business.date_spine(adapter.events(spark, d), "ts")


@query
def pit_entity_day(spark, d):
    return Tables(spark, d).pit("pit_repo_day")


@query
def pit_user_day(spark, d):
    return Tables(spark, d).pit("pit_actor_day")


@query
def pit_pull_request_day(spark, d):
    return Tables(spark, d).pit("pit_pull_request_day")


@query
def bridge_collaboration(spark, d):
    return Tables(spark, d).bridge()


@query
def lifecycle_item(spark, d):
    return Tables(spark, d).pr_life()


@query
def lifecycle_with_churn(spark, d):
    return Tables(spark, d).issue_life()


@query
def entity_activity_mart(spark, d):
    t = Tables(spark, d)
    return marts.repo_activity(t.raw["sat_actor_repo_event"], t.raw["link_actor_repo"], t.raw["hub_repo"], t.pit("pit_repo_day", sparse=True), t.raw["sat_repo_profile"], t.raw["sat_repo_stats"])


@query
def user_360_mart(spark, d):
    t = Tables(spark, d)
    return marts.developer_360(t.raw["sat_actor_repo_event"], t.raw["link_actor_repo"], t.raw["hub_actor"], t.pit("pit_actor_day", sparse=True), t.raw["sat_actor_profile"], t.bridge(), t.pr_life())


@query
def collaboration_mart(spark, d):
    t = Tables(spark, d)
    return marts.collaboration(t.bridge(), t.pr_life(), t.issue_life(), t.raw["sat_pull_request_details"])


@query
def latest_state(spark, d):
    return business.latest_state(Tables(spark, d).raw["sat_issue_details"], "hk_issue").select("hk_issue", "action", "issue_state", "hash_diff", "occurred_at")


@query
def dq_not_null(spark, d):
    return _contracted(spark, d).agg(checks.nulls("event_type").alias("null_values"))


@query
def dq_unique(spark, d):
    return adapter.table(spark, d, "lineitem").agg(checks.duplicates(["l_orderkey", "l_linenumber"]).alias("duplicate_keys"))


@query
def dq_accepted_values(spark, d):
    return _contracted(spark, d).agg(checks.outside("event_type", ["click", "view"]).alias("outside"))


@query
def dq_row_count_between(spark, d):
    return adapter.table(spark, d, "orders").agg(F.count(F.lit(1)).alias("row_count"), F.count(F.lit(1)).between(1, 10_000).alias("passed"))


ANCHOR = datetime(2024, 2, 1, tzinfo=UTC)


@query
def dq_freshness(spark, d):
    newest = F.max(F.unix_micros(F.col("ts").cast("timestamp")))
    return adapter.events(spark, d).agg(F.floor((F.lit(int(ANCHOR.timestamp())) - newest / 1e6) / 60).alias("age_minutes"))


@query
def dq_referential_integrity(spark, d):
    parts = adapter.table(spark, d, "part").where("p_size < 25")
    return checks.orphans(adapter.table(spark, d, "lineitem"), "l_partkey", parts, "p_partkey").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("orphans"))


@query
def dq_row_count_match(spark, d):
    n = [adapter.table(spark, d, t).agg(F.count(F.lit(1)).alias(f"n_{t}"), F.lit(1).alias("_one")) for t in ("orders", "customer")]
    out = n[0].join(n[1], "_one")
    return out.select("n_orders", "n_customer", F.abs(F.col("n_orders") - F.col("n_customer")).alias("drift"))


DQ_SUITE = checks.Suite(
    "lineitem",
    (
        checks.Check("not_null", column="l_orderkey"),
        checks.Check("unique", columns=("l_orderkey", "l_linenumber"), severity="warn"),
        checks.Check("accepted_values", column="l_returnflag", values=("A", "N")),
        checks.Check("row_count_between", min_rows=1),
        checks.Check("referential_integrity", column="l_partkey", ref_table="part", ref_column="p_partkey", ref_filter="p_size < 25"),
        checks.Check("row_count_match", ref_table="orders", tolerance=10),
    ),
)


@query
def dq_suite_summary(spark, d):
    r = checks.run_suite(DQ_SUITE, lambda name: adapter.table(spark, d, name))
    return spark.createDataFrame([(i, x.check.type, x.status, x.observed) for i, x in enumerate(r.results)], "position int, check_type string, status string, observed string")


@query
def tpch_chain_revenue(spark, d):
    t = lambda n: adapter.table(spark, d, n)
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("long") * (100 - F.round(F.col("l_discount") * 100).cast("long"))
    return rows.groupBy("r_name", "n_name").agg(F.sum(cents).alias("revenue_e4"), F.count(F.lit(1)).alias("line_items"))


@query
def metrics_latest_run(spark, d):
    from tessera import runs

    steps = adapter.events(spark, d).select(
        F.concat(F.lit("run-"), "user_id").alias("run_id"),
        F.col("event_type").alias("pipeline"),
        F.col("event_id").cast("string").alias("step"),
        F.col("ts").alias("started_at"),
    )
    return runs.latest_run(steps)


@query
def ledger_stream_ingest(spark, d):
    """Two runs of the stream over the events' lines, written as text; the second finds nothing new."""
    from tessera.streaming.ingest import stream_into

    base = shared_dir(spark, "stream")
    adapter.lines(adapter.events(spark, d)).where("value is not null").select("value").write.text(f"{base}/landing")
    for _ in range(2):
        out = stream_into(spark, f"{base}/landing", f"{base}/table", f"{base}/checkpoint", adapter.TYPES)
    return out.groupBy(F.coalesce("error_reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
