"""Business-vault operators: resolved intervals, lifecycles, current states, point-in-time tables and the bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_key
from tessera.operators.vault import GHOST_DTS, HIGH_DTS, keep_first, union


def _dts(df: DataFrame, column: str, value: str) -> Column:
    return F.lit(value).cast(dict(df.dtypes)[column])


def hours_between(start: str, end: str) -> Column:
    """Hours as a double; both ends are floored to seconds."""
    seconds = lambda c: F.col(c).cast("timestamp").cast("long")
    return (seconds(end) - seconds(start)) / F.lit(3600.0)


def resolve_effectivity(eff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The earliest end of each interval start; active where even that is open."""
    out = eff.groupBy(*keys, "start_dts").agg(F.min("end_dts").alias("end_dts"))
    return out.withColumn("is_active", F.col("end_dts") == _dts(eff, "end_dts", HIGH_DTS))


def when_min(condition: Column) -> Column:
    return F.min(F.when(condition, F.col("occurred_at")))


def pr_lifecycle(details: DataFrame, key: str = "hk_pull_request") -> DataFrame:
    """First opening and closing, last merging close, whether any state was merged, last activity, hours to the first close."""
    merged = F.coalesce(F.col("pr_merged"), F.lit(False))
    out = details.groupBy(key).agg(
        when_min(F.col("action") == "opened").alias("opened_at"),
        when_min(F.col("action") == "closed").alias("closed_at"),
        F.max(F.when(merged & (F.col("action") == "closed"), F.col("occurred_at"))).alias("merged_at"),
        F.bool_or(merged).alias("is_merged"),
        F.max("occurred_at").alias("last_activity_at"),
    )
    return out.withColumn("cycle_time_hours", hours_between("opened_at", "closed_at"))


def issue_lifecycle(details: DataFrame, resolved: DataFrame, key: str = "hk_issue", assignee: str = "hk_actor") -> DataFrame:
    """First opening and closing, last activity, hours to close, assignments and the active assignee."""
    out = details.groupBy(key).agg(when_min(F.col("action") == "opened").alias("opened_at"), when_min(F.col("action") == "closed").alias("closed_at"), F.max("occurred_at").alias("last_activity_at"))
    churn = resolved.groupBy(key).agg(F.count(F.lit(1)).alias("assignee_change_count"), F.max(F.when(F.col("is_active"), F.col(assignee))).alias("active_assignee_hk"))
    out = out.withColumn("time_to_close_hours", hours_between("opened_at", "closed_at")).join(churn, key, "left")
    return out.withColumn("assignee_change_count", F.coalesce("assignee_change_count", F.lit(0).cast("long")))


def latest_state(details: DataFrame, key: str) -> DataFrame:
    """The last state of each parent; ties go to the greatest hash_diff."""
    return keep_first(details, [key], [F.col("occurred_at").desc_nulls_last(), F.col("hash_diff").desc_nulls_last()])


def date_spine(activity: DataFrame, column: str = "occurred_at") -> DataFrame:
    """The days on which anything happened."""
    return activity.select(F.to_date(column).alias("as_of_date")).where("as_of_date is not null").distinct()


def point_in_time(hub: DataFrame, key: str, satellites: dict[str, DataFrame], spine: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """For each hub row and day, a pointer `<satellite>_pit_ts` per satellite: the last state by the end of that day, else the ghost.

    Daily maxima of all satellites are laid on the hub's days and carried forward by one running window, whose partitions
    hold the days of one hub row. The grid of hub rows and days is the result itself; the spine has a row per day, so it is
    sent to every task. With `active` (key, as_of_date), only these pairs get pointers: a fact table needs no others, and
    the grid, which grows with hub rows times days, is not made.
    """
    kind = dict(next(iter(satellites.values())).dtypes)["occurred_at"]
    ghost = F.lit(GHOST_DTS).cast(kind)
    first_day = F.lit("0001-01-01").cast("date")
    if active is None:
        grid = hub.select(key).distinct().join(F.broadcast(spine.select("as_of_date")))
    else:
        grid = active.select(key, "as_of_date").where("as_of_date is not null").distinct()
    daily = [grid.select(key, "as_of_date", F.lit(True).alias("_grid"), *[F.lit(None).cast(kind).alias(n) for n in satellites])]
    for name, sat in satellites.items():
        day = F.coalesce(F.to_date("occurred_at"), first_day)
        top = sat.groupBy(key, day.alias("as_of_date")).agg(F.max("occurred_at").alias("_ts"))
        daily.append(top.select(key, "as_of_date", F.lit(False).alias("_grid"), *[(F.col("_ts") if n == name else F.lit(None).cast(kind)).alias(n) for n in satellites]))
    carried = Window.partitionBy(key).orderBy("as_of_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = union(daily).select(key, "as_of_date", "_grid", *[F.coalesce(F.max(n).over(carried), ghost).alias(f"{n}_pit_ts") for n in satellites])
    return rows.where("_grid").drop("_grid")


def at_pointer(sat: DataFrame, key: str) -> DataFrame:
    """One state per parent and instant, so that a pointer matches one row: the greatest hash_diff of a tie."""
    return keep_first(sat, [key, "occurred_at"], [F.col("hash_diff").desc_nulls_last()])


def bridge(
    hub_actor: DataFrame,
    hub_repo: DataFrame,
    hub_pull_request: DataFrame,
    hub_issue: DataFrame,
    link_actor_pull_request: DataFrame,
    link_actor_issue: DataFrame,
    assignments: DataFrame,
) -> DataFrame:
    """Who collaborates on what: actors of pull requests, actors of issues and active assignees, with their business keys.

    An assignment knows no repository; its hash is made from the issue's repository name.
    """
    actors = hub_actor.select("hk_actor", "actor_login")
    repos = hub_repo.select("hk_repo", "repo_name")

    def traversal(rows: DataFrame, items: DataFrame, item_type: str, relation: str) -> DataFrame:
        rows = rows.join(items, "hk_item").join(actors, "hk_actor").join(repos, "hk_repo")
        return rows.select("hk_repo", "repo_name", "hk_actor", "actor_login", F.lit(item_type).alias("item_type"), "hk_item", "item_number", F.lit(relation).alias("relationship_type"))

    prs = hub_pull_request.select(F.col("hk_pull_request").alias("hk_item"), F.col("pr_number").alias("item_number"))
    issues = hub_issue.select(F.col("hk_issue").alias("hk_item"), F.col("issue_number").alias("item_number"))
    homes = hub_issue.select(F.col("hk_issue").alias("hk_item"), F.col("issue_number").alias("item_number"), hash_key(["repo_name"]).alias("hk_repo"))
    parts = [
        traversal(link_actor_pull_request.select("hk_actor", "hk_repo", F.col("hk_pull_request").alias("hk_item")), prs, "pull_request", "pr_actor"),
        traversal(link_actor_issue.select("hk_actor", "hk_repo", F.col("hk_issue").alias("hk_item")), issues, "issue", "issue_actor"),
        traversal(assignments.where("is_active").select("hk_actor", F.col("hk_issue").alias("hk_item")), homes, "issue", "issue_assignee"),
    ]
    return union(parts).distinct()
