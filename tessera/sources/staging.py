"""Raw event lines: envelope checks and staged frames per event type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the feed's format
ENVELOPE = "id string, type string, created_at string"
ACTOR = "actor struct<id bigint, login string, display_login string, avatar_url string>"
REPO = "repo struct<id bigint, name string, url string>"
FULL_REPO = "struct<id bigint, name string, full_name string, owner struct<login string>, language string, default_branch string, license struct<key string>, created_at string, stargazers_count bigint, forks_count bigint, open_issues_count bigint, watchers_count bigint>"
PAYLOADS = {
    "PushEvent": "struct<push_id bigint, size int, distinct_size int, ref string>",
    "PullRequestEvent": f"struct<action string, number int, pull_request struct<number int, title string, state string, merged boolean, base struct<ref string, repo {FULL_REPO}>, head struct<ref string>>>",
    "IssuesEvent": "struct<action string, issue struct<number int, title string, state string, comments int>, assignee struct<login string>>",
    "WatchEvent": "struct<action string>",
    "ForkEvent": f"struct<forkee {FULL_REPO}>",
    "ReleaseEvent": "struct<action string, release struct<tag_name string, name string, draft boolean, prerelease boolean>>",
}
EVENT_TYPES = list(PAYLOADS)
COMMON = {"event_id": "id", "actor_login": "actor.login", "actor_display_login": "actor.display_login", "actor_avatar_url": "actor.avatar_url", "repo_name": "repo.name", "created_at": "created_at:ts"}
#: event type: staged column -> path below the event; ":ts" parses a timestamp
COLUMNS = {
    "PushEvent": {"push_id": "payload.push_id", "push_size": "payload.size", "push_distinct_size": "payload.distinct_size", "ref_name": "payload.ref"},
    "PullRequestEvent": {
        "action": "payload.action", "pr_number": "payload.pull_request.number", "pr_title": "payload.pull_request.title", "pr_state": "payload.pull_request.state", "pr_merged": "payload.pull_request.merged",
        "base_ref": "payload.pull_request.base.ref", "head_ref": "payload.pull_request.head.ref", "base_repo_owner": "payload.pull_request.base.repo.owner.login", "base_repo_language": "payload.pull_request.base.repo.language",
        "base_repo_default_branch": "payload.pull_request.base.repo.default_branch", "base_repo_license": "payload.pull_request.base.repo.license.key", "base_repo_created_at": "payload.pull_request.base.repo.created_at:ts",
        "base_repo_stargazers": "payload.pull_request.base.repo.stargazers_count", "base_repo_forks": "payload.pull_request.base.repo.forks_count", "base_repo_open_issues": "payload.pull_request.base.repo.open_issues_count", "base_repo_watchers": "payload.pull_request.base.repo.watchers_count",
    },
    "IssuesEvent": {
        "action": "payload.action",
        "issue_number": "payload.issue.number",
        "issue_title": "payload.issue.title",
        "issue_state": "payload.issue.state",
        "issue_comments": "payload.issue.comments",
        "assignee_login": "payload.assignee.login",
    },
    "WatchEvent": {"action": "payload.action"},
    "ForkEvent": {
        "forkee_full_name": "payload.forkee.full_name",
        "forkee_owner": "payload.forkee.owner.login",
        "forkee_language": "payload.forkee.language",
        "forkee_default_branch": "payload.forkee.default_branch",
        "forkee_license": "payload.forkee.license.key",
        "forkee_created_at": "payload.forkee.created_at:ts",
    },
    "ReleaseEvent": {"action": "payload.action", "release_tag": "payload.release.tag_name", "release_name": "payload.release.name", "release_prerelease": "payload.release.prerelease"},
}


def classified(lines: DataFrame, event_types: list[str], compat: bool = False) -> DataFrame:
    """Adds event_key, event_type, created_ts and error_reason (null: valid) to lines (value, ...).

    Malformed JSON is told from JSON without an id, and a null type is unknown. With `compat`, only blank lines are
    unparseable, other malformed ones miss their id, and a null type passes.
    """
    e = F.from_json("value", f"{ENVELOPE}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    df = lines.withColumn("_e", e).withColumns({"event_key": F.col("_e.id"), "event_type": F.col("_e.type"), "created_ts": F.try_to_timestamp("_e.created_at")})
    known = F.col("event_type").isin(event_types)
    malformed = F.col("_e").isNull() | (F.trim("value") == "") if compat else F.col("_e").isNull() | (F.trim("value") == "") | F.col("_e._corrupt_record").isNotNull()
    reason = F.when(malformed, "unparseable_json").when(F.col("event_key").isNull(), "missing_id").when(F.col("created_ts").isNull(), "missing_or_bad_created_at")
    reason = reason.when(~known if compat else ~F.coalesce(known, F.lit(False)), "unknown_event_type")
    return df.withColumn("error_reason", reason).drop("_e")


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) of classified lines."""
    valid = df.where("error_reason is null").select(F.col("value").alias("raw_value"), "source_ref", "event_key", "event_type", "created_ts")
    return valid, df.where("error_reason is not null").select(F.col("value").alias("raw_line"), "error_reason", "source_ref")


def _path(path: str) -> Column:
    name, _, kind = path.partition(":")
    return F.try_to_timestamp(F.col(f"e.{name}")) if kind == "ts" else F.col(f"e.{name}")


def stage(bronze: DataFrame, prefix: str = "gharchive") -> dict[str, DataFrame]:
    """Event type -> flat frame with event_id, actor, repository, the type's columns, record_source and occurred_at.

    `bronze` has raw_value and event_type; each branch filters on event_type, which bronze is partitioned by, and parses once.
    """
    out = {}
    for kind, columns in COLUMNS.items():
        schema = f"{ENVELOPE}, {ACTOR}, {REPO}, payload {PAYLOADS[kind]}"
        # a value that is not deterministic keeps filters above from being pushed below, where each column would parse again
        parsed = F.when(F.monotonically_increasing_id() >= 0, F.from_json("raw_value", schema))
        df = bronze.where(F.col("event_type") == kind).select(parsed.alias("e"))
        df = df.select(*[_path(p).alias(c) for c, p in {**COMMON, **columns}.items()])
        out[kind] = df.withColumns({"record_source": F.lit(f"{prefix}.{kind}"), "occurred_at": F.col("created_at")})
    return out
