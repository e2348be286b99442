"""Compiles a declared vault to DataFrames, and runs the layers against a table store."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import business, marts, vault
from tessera.plans.model import EVENT_ATTRIBUTES, GITHUB, Satellite, Vault
from tessera.sources.staging import stage
from tessera.sources.store import TableStore


def _typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(k) if c in df.columns else F.lit(None).cast(k) for c, k in kinds.items()})


def _events(sat: Satellite, staged: dict[str, DataFrame] | vault.Wide) -> DataFrame:
    """The multi-active rows; attributes that an event type lacks are null."""
    if isinstance(staged, vault.Wide):
        rows = staged.extracted(sat.sources, ("frame", "event_id", "record_source", "occurred_at"))
        return _typed(rows.withColumnRenamed("frame", "event_type"), EVENT_ATTRIBUTES)
    parts = []
    for s in sat.sources:
        if s.frame in staged:
            parts.append(_typed(s.of(staged).withColumn("event_type", F.lit(s.frame)), EVENT_ATTRIBUTES))
    return vault.union(parts)


def raw_vault(model: Vault, staged: dict[str, DataFrame] | vault.Wide) -> dict[str, tuple[DataFrame, list[str]]]:
    """Object -> (candidates, merge keys), parents before children."""
    out: dict[str, tuple[DataFrame, list[str]]] = {}
    there = lambda x: any(s.frame in staged for s in x.sources)
    for h in filter(there, model.hubs):
        out[h.name] = vault.hub(vault.extracted(staged, h.sources), h.key, h.business_keys), [h.key]
    for ln in filter(there, model.links):
        out[ln.name] = vault.link(vault.extracted(staged, ln.sources), ln.key, model.parent_keys(ln)), [ln.key]
    for sat in filter(there, model.satellites):
        parent = model.parent(sat)
        if sat.kind == "multi_active":
            df, keys = vault.multi_active_satellite(_events(sat, staged), parent.key, model.key_columns(parent), sat.attributes, sat.subsequence_key), [parent.key, sat.subsequence_key]
        elif sat.kind == "effectivity":
            driving, other = (model.hub(h) for h in sorted(parent.hubs, key=lambda h: h != parent.driving_key))
            df = vault.effectivity_satellite(vault.extracted(staged, sat.sources), parent.key, (driving.key, driving.business_keys), (other.key, other.business_keys), F.col("action") == "assigned")
            keys = [parent.key, "start_dts", "end_dts"]
        else:
            df, keys = vault.standard_satellite(vault.extracted(staged, sat.sources), parent.key, model.key_columns(parent), sat.attributes), [parent.key, "hash_diff"]
        out[sat.name] = df, keys
    return out


BRONZE, STATE = "bronze/github_events", "raw_vault/ops/loads"
Enforce = Callable[[str, DataFrame], tuple[DataFrame, DataFrame]]


def _loaded_version(store: TableStore) -> int | None:
    """The version of bronze that the last whole load has taken up."""
    return store.read(STATE).agg(F.max("bronze_version")).first()[0] if store.exists(STATE) else None


def enforced(staged: dict[str, DataFrame], enforce: Enforce) -> tuple[dict[str, DataFrame], DataFrame]:
    """Valid frames, and the rows that break their contract with their `event_type`."""
    results = {t: enforce(t, df) for t, df in staged.items()}
    bad = vault.union([r[1].withColumn("event_type", F.lit(t)) for t, r in results.items()])
    return {t: r[0] for t, r in results.items()}, bad


def _effectivity_history(model: Vault, new: dict[str, DataFrame], whole: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frames for the effectivity satellites: all events of the driving keys that the new events name, for intervals end later."""
    out = dict(new)
    for sat in (s for s in model.satellites if s.kind == "effectivity"):
        parent = model.parent(sat)
        columns = model.hub(parent.driving_key).business_keys
        touched = vault.extracted(new, sat.sources).select(*[F.col(c).alias(f"_t_{c}") for c in columns]).distinct()
        for s in sat.sources:
            same = reduce(lambda a, b: a & b, [F.col(s.columns[c]) == F.col(f"_t_{c}") for c in columns])
            out[s.frame] = whole[s.frame].join(touched, same, "left_semi")
    return out


def load_raw_vault(store: TableStore, model: Vault = GITHUB, enforce: Enforce | None = None, full: bool = False) -> dict[str, int]:
    """Rows added to each object, from the events that came to bronze since the last whole load; all of them if `full`.

    Every object is insert-only, so a load that broke off is taken up again. Intervals need the history of their driving
    keys: for the keys that new events name, all events are read. Staged frames are cached for the run, as every object reads them.
    `enforce` maps (event type, frame) to (valid, quarantined); quarantined rows are merged on event_id, and counted for each
    event type as `quarantine/<type>`.
    """
    version, after = store.version(BRONZE), None if full else _loaded_version(store)
    staged = stage(store.read(BRONZE, after))
    added: dict[str, int] = {}
    if enforce:
        staged, bad = enforced(staged, enforce)
        bad = bad.persist()
        added["quarantine"] = store.insert_only("raw_vault/quarantine", bad.drop("event_type"), ["event_id"])
        counts = {r["event_type"]: r["n"] for r in bad.groupBy("event_type").agg(F.count_distinct("event_id").alias("n")).collect()}
        added |= {f"quarantine/{t}": counts.get(t, 0) for t in staged}
        bad.unpersist()
    staged = {t: df.persist() for t, df in staged.items()}
    try:
        objects = raw_vault(model, staged)
        if after is not None:
            whole = stage(store.read(BRONZE))
            whole = enforced(whole, enforce)[0] if enforce else whole
            history = raw_vault(model, _effectivity_history(model, staged, whole))
            objects |= {s.name: history[s.name] for s in model.satellites if s.kind == "effectivity"}
        for name, (candidates, keys) in objects.items():
            added[name] = store.insert_only(f"raw_vault/{name}", candidates.withColumn("load_dts", F.current_timestamp()), keys)
    finally:
        for df in staged.values():
            df.unpersist()
    store.append(STATE, store.spark.range(1).select(F.lit(version).cast("long").alias("bronze_version"), F.current_timestamp().alias("loaded_at")))
    return added


def verify_idempotent(store: TableStore, model: Vault = GITHUB, enforce: Enforce | None = None) -> dict[str, int]:
    """Loads all of bronze again; the objects that gained rows. A correct vault gives none."""
    return {k: n for k, n in load_raw_vault(store, model, enforce, full=True).items() if n and "/" not in k}


def build_business_vault(store: TableStore, model: Vault = GITHUB) -> dict[str, int]:
    read = lambda name: store.read(f"raw_vault/{name}")
    resolved = business.resolve_effectivity(read("eff_sat_issue_assignee"), ["lhk_issue_assignee", "hk_issue", "hk_actor"])
    spine = business.date_spine(read("sat_actor_repo_event"))
    objects = {
        "bsat_pr_lifecycle": business.pr_lifecycle(read("sat_pull_request_details")),
        "bsat_issue_lifecycle": business.issue_lifecycle(read("sat_issue_details"), resolved),
        **{p: business.point_in_time(read(hub), model.hub(hub).key, {s: read(s) for s in sats}, spine) for p, (hub, sats) in model.pits.items()},
        "bridge_repo_collaboration": business.bridge(*[read(n) for n in ("hub_actor", "hub_repo", "hub_pull_request", "hub_issue", "link_actor_pull_request", "link_actor_issue")], resolved),
    }
    return {name: store.overwrite(f"business_vault/{name}", df) for name, df in objects.items()}


def build_gold(store: TableStore) -> dict[str, int]:
    raw = lambda *names: [store.read(f"raw_vault/{n}") for n in names]
    biz = lambda n: store.read(f"business_vault/{n}")
    objects = {
        "repo_activity_mart": marts.repo_activity(*raw("sat_actor_repo_event", "link_actor_repo", "hub_repo"), biz("pit_repo_day"), *raw("sat_repo_profile", "sat_repo_stats")),
        "developer_360_mart": marts.developer_360(
            *raw("sat_actor_repo_event", "link_actor_repo", "hub_actor"),
            biz("pit_actor_day"),
            *raw("sat_actor_profile"),
            biz("bridge_repo_collaboration"),
            biz("bsat_pr_lifecycle"),
        ),
        "collaboration_mart": marts.collaboration(biz("bridge_repo_collaboration"), biz("bsat_pr_lifecycle"), biz("bsat_issue_lifecycle"), *raw("sat_pull_request_details")),
    }
    return {name: store.overwrite(f"gold/{name}", df) for name, df in objects.items()}
