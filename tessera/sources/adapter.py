"""The test tables in the vault's vocabulary: `events` as staged frames of a source-control feed, and as raw lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.vault import Wide

TYPES = ["click", "error", "purchase", "signup", "view"]
#: events type -> feed type
KINDS = {"click": "PushEvent", "view": "WatchEvent", "signup": "PullRequestEvent", "purchase": "IssuesEvent", "error": "IssuesEvent"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return df.withColumn("k", F.from_json("props", "k int")["k"])


def wide(df: DataFrame) -> Wide:
    """All frames in one: an entity is a repository, a user an actor; numbers and actions follow from ids."""
    kind = F.coalesce(*[F.when(F.col("event_type") == s, F.lit(t)) for s, t in KINDS.items()])
    n, user, k, even = F.col("event_id"), F.col("user_id"), F.col("k"), F.col("event_id") % 2 == 0
    push, watch, pr, issue = (F.col("frame") == t for t in ("PushEvent", "WatchEvent", "PullRequestEvent", "IssuesEvent"))
    pr_action = F.element_at(F.array(*map(F.lit, ("opened", "closed", "reopened"))), (n % 3 + 1).cast("int"))
    bought = F.col("event_type") == "purchase"
    issue_action = F.when(bought & even, "assigned").when(bought, "opened").when(even, "unassigned").otherwise("closed")
    state = lambda action: F.when(action == "closed", "closed").otherwise("open")
    columns = {
        "push_size": (push, (n % 8).cast("int")),
        "push_distinct_size": (push, (n % 4).cast("int")),
        "ref_name": (push, F.lit("main")),
        "pr_number": (pr, (user % 7).cast("int")),
        "pr_title": (pr, F.concat(F.lit("t"), user % 7)),
        "pr_state": (pr, state(pr_action)),
        "pr_merged": (pr, (pr_action == "closed") & even),
        "base_ref": (pr, F.lit("main")),
        "head_ref": (pr, F.concat(F.lit("h"), user % 2)),
        "base_repo_owner": (pr, F.concat(F.lit("o"), k % 10)),
        "base_repo_language": (pr, F.concat(F.lit("l"), n % 2)),
        "base_repo_default_branch": (pr, F.lit("main")),
        "base_repo_license": (pr & (k % 3 != 0), F.lit("mit")),
        "base_repo_created_at": (pr, F.lit(None).cast("timestamp_ntz")),
        "base_repo_stargazers": (pr, n % 3),
        "base_repo_forks": (pr, k.cast("long")),
        "base_repo_open_issues": (pr, user % 2),
        "base_repo_watchers": (pr, F.lit(1).cast("long")),
        "issue_number": (issue, (user % 5).cast("int")),
        "issue_title": (issue, F.concat(F.lit("i"), user % 5)),
        "issue_state": (issue, state(issue_action)),
        "issue_comments": (issue, (n % 3).cast("int")),
        "assignee_login": (issue, F.concat(F.lit("u"), (n + user) % 50)),
    }
    rows = df.withColumn("frame", kind).where("frame is not null").select(
        "frame",
        n.cast("string").alias("event_id"),
        F.concat(F.lit("u"), user).alias("actor_login"),
        F.concat(F.lit("U"), user, F.lit("-"), n % 2).alias("actor_display_login"),
        F.lit("a").alias("actor_avatar_url"),
        F.concat(F.lit("k/"), "k").alias("repo_name"),
        F.col("ts").alias("occurred_at"),
        F.concat(F.lit("events."), "frame").alias("record_source"),
        F.when(watch, "started").when(pr, pr_action).when(issue, issue_action).alias("action"),
        *[F.when(where, value).alias(c) for c, (where, value) in columns.items()],
    )
    return Wide(rows, tuple(dict.fromkeys(KINDS.values())))


def _damaged(text: Column, event_id: Column, kind: str) -> Column:
    """A line of JSON; those of seven remainders of event_id by 50 are damaged, each in its way."""
    m = event_id % 50
    return (
        F.when(m == 0, F.substring(text, F.lit(1), (F.length(text) / 2).cast("int")))
        .when(m == 1, F.replace(text, F.lit('"id"'), F.lit('"identifier"')))
        .when(m == 2, F.replace(text, F.lit('"created_at":"'), F.lit('"created_at":"x')))
        .when(m == 3, F.replace(text, F.concat(F.lit('"type":"'), kind), F.lit('"type":"party')))
        .when(m == 4, F.lit("  "))
        .when(m == 5, F.regexp_replace(text, '"type":"[A-Za-z]*",', ""))
        .when(m == 6, F.concat(F.lit("GARBAGE "), F.substring(text, 1, 40)))
        .otherwise(text)
    )


def _created_at(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at")


def lines(df: DataFrame) -> DataFrame:
    """Every event's envelope as a line of JSON, some damaged."""
    text = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"), _created_at("ts")))
    return df.select(_damaged(text, F.col("event_id"), "event_type").alias("value"), F.lit("events").alias("source_ref"), "event_id")


def feed(df: DataFrame) -> DataFrame:
    """Every event as a whole line of the feed, with actor, repository and payload, some damaged.

    Of the sound lines, remainder 7 has an unknown action where its type has one, and remainder 8 no actor's login.
    """
    e = wide(df).df.withColumn("n", F.col("event_id").cast("long"))
    m = F.col("n") % 50
    some = lambda where, *columns: F.when(where, F.struct(*columns))
    of = lambda column, name: F.col(column).alias(name)
    repo = F.struct(
        F.struct(of("base_repo_owner", "login")).alias("owner"),
        of("base_repo_language", "language"),
        of("base_repo_default_branch", "default_branch"),
        some(F.col("base_repo_license").isNotNull(), of("base_repo_license", "key")).alias("license"),
        of("base_repo_stargazers", "stargazers_count"),
        of("base_repo_forks", "forks_count"),
        of("base_repo_open_issues", "open_issues_count"),
        of("base_repo_watchers", "watchers_count"),
    )
    pr = some(
        F.col("pr_number").isNotNull(),
        of("pr_number", "number"),
        of("pr_title", "title"),
        of("pr_state", "state"),
        of("pr_merged", "merged"),
        F.struct(of("base_ref", "ref"), repo.alias("repo")).alias("base"),
        F.struct(of("head_ref", "ref")).alias("head"),
    )
    issue = some(F.col("issue_number").isNotNull(), of("issue_number", "number"), of("issue_title", "title"), of("issue_state", "state"), of("issue_comments", "comments"))
    payload = F.struct(
        F.when((m == 7) & F.col("action").isNotNull(), "bogus").otherwise(F.col("action")).alias("action"),
        of("push_size", "size"),
        of("push_distinct_size", "distinct_size"),
        of("ref_name", "ref"),
        pr.alias("pull_request"),
        issue.alias("issue"),
        some(F.col("assignee_login").isNotNull(), of("assignee_login", "login")).alias("assignee"),
    )
    actor = F.struct(F.when(m != 8, F.col("actor_login")).alias("login"), of("actor_display_login", "display_login"), of("actor_avatar_url", "avatar_url"))
    text = F.to_json(F.struct(of("event_id", "id"), of("frame", "type"), actor.alias("actor"), F.struct(of("repo_name", "name")).alias("repo"), payload.alias("payload"), _created_at("occurred_at")))
    e = e.select("frame", "n", text.alias("text"))
    return e.select(_damaged(F.col("text"), F.col("n"), "frame").alias("value"), F.lit("events").alias("source_ref"), F.col("n").alias("event_id"))
