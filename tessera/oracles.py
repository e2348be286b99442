"""DuckDB SQL for the queries of the vault engine, written from their meaning and not from the engine's plans."""

from __future__ import annotations


def h(*parts: str) -> str:
    return "sha256(concat_ws('||', " + ", ".join(f"coalesce(upper(trim(({p})::VARCHAR)), '^^')" for p in parts) + "))"


HIGH, GHOST = "TIMESTAMP '9999-12-31 00:00:00'", "TIMESTAMP '1900-01-01 00:00:00'"
_K = "json_extract_string(props, '$.k')::INTEGER"
_ACTOR = "event_id, actor_login, actor_display_login, actor_avatar_url, repo_name, occurred_at"

#: the adapter's frames
BASE = f"""
e AS (SELECT event_id AS n, user_id, {_K} AS k, event_type AS st, event_id::VARCHAR AS event_id, 'u' || user_id AS actor_login,
  'U' || user_id || '-' || (event_id % 2) AS actor_display_login, 'a' AS actor_avatar_url, 'k/' || {_K} AS repo_name, ts AS occurred_at FROM events),
push AS (SELECT {_ACTOR}, 'PushEvent' AS event_type, (n % 8)::INTEGER AS push_size, (n % 4)::INTEGER AS push_distinct_size, 'main' AS ref_name, NULL AS action FROM e WHERE st = 'click'),
watch AS (SELECT {_ACTOR}, 'WatchEvent' AS event_type, 'started' AS action FROM e WHERE st = 'view'),
pr0 AS (SELECT *, CASE n % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' ELSE 'reopened' END AS action FROM e WHERE st = 'signup'),
pr AS (SELECT {_ACTOR}, 'PullRequestEvent' AS event_type, action, (user_id % 7)::INTEGER AS pr_number, 't' || (user_id % 7) AS pr_title,
  CASE WHEN action = 'closed' THEN 'closed' ELSE 'open' END AS pr_state, action = 'closed' AND n % 2 = 0 AS pr_merged, 'main' AS base_ref, 'h' || (user_id % 2) AS head_ref,
  'o' || (k % 10) AS owner_login, 'l' || (n % 2) AS language, 'main' AS default_branch, CASE WHEN k % 3 <> 0 THEN 'mit' END AS license, NULL::TIMESTAMP AS repo_created_at,
    n % 3 AS stargazers_count, k::BIGINT AS forks_count, user_id % 2 AS open_issues_count, 1::BIGINT AS watchers_count FROM pr0),
is0 AS (SELECT *, CASE WHEN st = 'purchase' THEN CASE WHEN n % 2 = 0 THEN 'assigned' ELSE 'opened' END ELSE CASE WHEN n % 2 = 0 THEN 'unassigned' ELSE 'closed' END END AS action FROM e
  WHERE st IN ('purchase', 'error')),
iss AS (SELECT {_ACTOR}, 'IssuesEvent' AS event_type, action, (user_id % 5)::INTEGER AS issue_number, 'i' || (user_id % 5) AS issue_title,
  CASE WHEN action = 'closed' THEN 'closed' ELSE 'open' END AS issue_state, (n % 3)::INTEGER AS issue_comments, 'u' || ((n + user_id) % 50) AS assignee_login FROM is0),
allev AS (SELECT {_ACTOR}, event_type, action, push_size, push_distinct_size, ref_name FROM push
  UNION ALL SELECT {_ACTOR}, event_type, action, NULL, NULL, NULL FROM watch UNION ALL SELECT {_ACTOR}, event_type, action, NULL, NULL, NULL FROM pr UNION ALL SELECT {_ACTOR},
    event_type, action, NULL, NULL, NULL FROM iss)"""


def first(rows: str, keys: str, columns: str, ties: str = "event_type") -> str:
    """The first row by time, event number and ties of each key."""
    return f"SELECT {columns} FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY occurred_at, event_id::BIGINT, event_id, {ties}) = 1"


_SRC = "'events.' || event_type AS record_source, occurred_at"
_actor_rows = f"SELECT {h('actor_login')} AS hk_actor, actor_login, event_id, event_type, occurred_at FROM (SELECT actor_login, event_id, event_type, occurred_at FROM allev UNION ALL SELECT assignee_login, event_id, event_type, occurred_at FROM iss)"
_ISSUE, _PR, _EVENT = h("repo_name", "issue_number"), h("repo_name", "pr_number"), h("actor_login", "repo_name")


def _sat(frame: str, key: str, key_sql: str, attributes: list[str]) -> str:
    rows = f"SELECT *, {key_sql} AS {key}, {h(*sorted(attributes))} AS hash_diff FROM {frame}"
    return first(rows, f"{key}, hash_diff", f"{key}, {', '.join(attributes)}, hash_diff, {_SRC}", ", ".join(attributes))


_MAS = ["event_type", "action", "push_size", "push_distinct_size", "ref_name"]
RAW = {
    "hub_actor": first(_actor_rows, "hk_actor", f"hk_actor, actor_login, {_SRC}", "actor_login, event_type"),
    "hub_repo": first(f"SELECT *, {h('repo_name')} AS hk_repo FROM allev", "hk_repo", f"hk_repo, repo_name, {_SRC}"),
    "hub_pull_request": first(f"SELECT *, {_PR} AS hk_pull_request FROM pr", "hk_pull_request", f"hk_pull_request, repo_name, pr_number, {_SRC}"),
    "hub_issue": first(f"SELECT *, {_ISSUE} AS hk_issue FROM iss", "hk_issue", f"hk_issue, repo_name, issue_number, {_SRC}"),
    "link_actor_repo": first(
        f"SELECT *, {_EVENT} AS lhk_actor_repo, {h('actor_login')} AS hk_actor, {h('repo_name')} AS hk_repo FROM allev",
        "lhk_actor_repo",
        f"lhk_actor_repo, hk_actor, hk_repo, {_SRC}",
    ),
    "link_actor_pull_request": first(
        f"SELECT *, {h('actor_login', 'repo_name', 'pr_number', 'repo_name')} AS lhk_actor_pull_request, {h('actor_login')} AS hk_actor, {_PR} AS hk_pull_request, {h('repo_name')} AS hk_repo FROM pr",
        "lhk_actor_pull_request",
        f"lhk_actor_pull_request, hk_actor, hk_pull_request, hk_repo, {_SRC}",
    ),
    "link_actor_issue": first(
        f"SELECT *, {h('actor_login', 'repo_name', 'issue_number', 'repo_name')} AS lhk_actor_issue, {h('actor_login')} AS hk_actor, {_ISSUE} AS hk_issue, {h('repo_name')} AS hk_repo FROM iss",
        "lhk_actor_issue",
        f"lhk_actor_issue, hk_actor, hk_issue, hk_repo, {_SRC}",
    ),
    "link_issue_assignee": first(
        f"SELECT *, {h('repo_name', 'issue_number', 'assignee_login')} AS lhk_issue_assignee, {_ISSUE} AS hk_issue, {h('assignee_login')} AS hk_actor FROM iss WHERE action IN ('assigned', 'unassigned')",
        "lhk_issue_assignee",
        f"lhk_issue_assignee, hk_issue, hk_actor, {_SRC}",
    ),
    "sat_actor_profile": _sat("(SELECT *, actor_display_login AS display_login, actor_avatar_url AS avatar_url FROM allev)", "hk_actor", h("actor_login"), ["display_login", "avatar_url"]),
    "sat_repo_profile": _sat("pr", "hk_repo", h("repo_name"), ["owner_login", "language", "default_branch", "license", "repo_created_at"]),
    "sat_repo_stats": _sat("pr", "hk_repo", h("repo_name"), ["stargazers_count", "forks_count", "open_issues_count", "watchers_count"]),
    "sat_pull_request_details": _sat("pr", "hk_pull_request", _PR, ["action", "pr_title", "pr_state", "pr_merged", "base_ref", "head_ref"]),
    "sat_issue_details": _sat("iss", "hk_issue", _ISSUE, ["action", "issue_title", "issue_state", "issue_comments"]),
    "sat_actor_repo_event": f"SELECT {_EVENT} AS lhk_actor_repo, event_id, {', '.join(_MAS)}, {h(*_MAS)} AS hash_diff, {_SRC} FROM allev",
    "eff_sat_issue_assignee": f"""SELECT * EXCLUDE (opens) FROM (SELECT {h('repo_name', 'issue_number', 'assignee_login')} AS lhk_issue_assignee, {_ISSUE} AS hk_issue,
      {h('assignee_login')} AS hk_actor, occurred_at AS start_dts,
      coalesce(lead(occurred_at) OVER (PARTITION BY {_ISSUE} ORDER BY occurred_at, event_id::BIGINT), {HIGH}) AS end_dts, 'events.IssuesEvent' AS record_source,
        action = 'assigned' AS opens FROM iss WHERE action IN ('assigned', 'unassigned')) WHERE opens""",
}

_hours = lambda a, b: f"(epoch(date_trunc('second', {b}))::BIGINT - epoch(date_trunc('second', {a}))::BIGINT) / 3600.0::DOUBLE"


def _min(action: str) -> str:
    return f"min(occurred_at) FILTER (WHERE action = '{action}')"


def _pit(hub: str, key: str, sats: list[str]) -> str:
    ptr = ", ".join(f"coalesce((SELECT max(occurred_at) FROM {s} x WHERE x.{key} = g.{key} AND x.occurred_at::DATE <= g.as_of_date), {GHOST}) AS {s}_pit_ts" for s in sats)
    return f"SELECT {key}, as_of_date, {ptr} FROM (SELECT {key}, as_of_date FROM {hub}, spine) g"


def _bridge(rows: str) -> str:
    return f"SELECT DISTINCT hk_repo, repo_name, hk_actor, actor_login, item_type, hk_item, item_number, relationship_type FROM ({rows})"


DERIVED = {
    "spine": "SELECT DISTINCT occurred_at::DATE AS as_of_date FROM allev",
    "resolved": f"SELECT lhk_issue_assignee, hk_issue, hk_actor, start_dts, min(end_dts) AS end_dts, min(end_dts) = {HIGH} AS is_active FROM eff_sat_issue_assignee GROUP BY 1, 2, 3, 4",
    "pr_life": f"SELECT *, {_hours('opened_at', 'closed_at')} AS cycle_time_hours FROM (SELECT hk_pull_request, {_min('opened')} AS opened_at, {_min('closed')} AS closed_at, max(occurred_at) FILTER (WHERE pr_merged AND action = 'closed') AS merged_at, bool_or(pr_merged) AS is_merged, max(occurred_at) AS last_activity_at FROM sat_pull_request_details GROUP BY 1)",
    "issue_life": f"""SELECT l.*, {_hours('opened_at', 'closed_at')} AS time_to_close_hours, coalesce(c.n, 0) AS assignee_change_count, c.a AS active_assignee_hk
      FROM (SELECT hk_issue, {_min('opened')} AS opened_at, {_min('closed')} AS closed_at, max(occurred_at) AS last_activity_at FROM sat_issue_details GROUP BY 1) l
      LEFT JOIN (SELECT hk_issue, count(*) AS n, max(hk_actor) FILTER (WHERE is_active) AS a FROM resolved GROUP BY 1) c USING (hk_issue)""",
    "pit_repo_day": _pit("hub_repo", "hk_repo", ["sat_repo_profile", "sat_repo_stats"]),
    "pit_actor_day": _pit("hub_actor", "hk_actor", ["sat_actor_profile"]),
    "pit_pull_request_day": _pit("hub_pull_request", "hk_pull_request", ["sat_pull_request_details"]),
    "bridge": _bridge(f"""
      SELECT l.hk_repo, r.repo_name, l.hk_actor, a.actor_login, 'pull_request' AS item_type, l.hk_pull_request AS hk_item, p.pr_number AS item_number, 'pr_actor' AS relationship_type
        FROM link_actor_pull_request l JOIN hub_actor a USING (hk_actor) JOIN hub_repo r USING (hk_repo) JOIN hub_pull_request p USING (hk_pull_request)
      UNION ALL SELECT l.hk_repo, r.repo_name, l.hk_actor, a.actor_login, 'issue', l.hk_issue, i.issue_number, 'issue_actor' FROM link_actor_issue l JOIN hub_actor a USING (hk_actor)
        JOIN hub_repo r USING (hk_repo) JOIN hub_issue i USING (hk_issue)
      UNION ALL SELECT r.hk_repo, r.repo_name, x.hk_actor, a.actor_login, 'issue', x.hk_issue, i.issue_number, 'issue_assignee' FROM resolved x JOIN hub_actor a USING (hk_actor)
        JOIN hub_issue i USING (hk_issue) JOIN hub_repo r ON r.hk_repo = {h('i.repo_name')} WHERE x.is_active"""),
}


def _at(sat: str, key: str) -> str:
    """One state per instant."""
    return f"(SELECT * FROM {sat} QUALIFY row_number() OVER (PARTITION BY {key}, occurred_at ORDER BY hash_diff DESC) = 1)"


_FACTS = "FROM sat_actor_repo_event m JOIN link_actor_repo l USING (lhk_actor_repo)"
MARTS = {
    "repo_activity": f"""SELECT r.repo_name, f.activity_date, f.event_type, f.events_count, f.distinct_actors, coalesce(f.push_commits, 0)::BIGINT AS push_commits,
      s.owner_login AS repo_owner, s.language AS repo_language, s.license AS repo_license, s.default_branch AS repo_default_branch,
      t.stargazers_count, t.forks_count, t.open_issues_count, t.watchers_count, f.hk_repo
      FROM (SELECT l.hk_repo, m.occurred_at::DATE AS activity_date, m.event_type, count(*) AS events_count, count(DISTINCT l.hk_actor) AS distinct_actors,
        sum(m.push_size)::BIGINT AS push_commits {_FACTS} GROUP BY ALL) f
      JOIN hub_repo r USING (hk_repo) LEFT JOIN pit_repo_day p ON p.hk_repo = f.hk_repo AND p.as_of_date = f.activity_date
      LEFT JOIN {_at('sat_repo_profile', 'hk_repo')} s ON s.hk_repo = f.hk_repo AND s.occurred_at = p.sat_repo_profile_pit_ts LEFT
        JOIN {_at('sat_repo_stats', 'hk_repo')} t ON t.hk_repo = f.hk_repo AND t.occurred_at = p.sat_repo_stats_pit_ts""",
    "developer_360": f"""SELECT a.actor_login, f.activity_date, f.* EXCLUDE (hk_actor, activity_date), s.display_login, s.avatar_url,
      (SELECT count(DISTINCT hk_item) FROM bridge b WHERE b.hk_actor = f.hk_actor AND item_type = 'pull_request') AS prs_acted, (SELECT count(DISTINCT hk_item) FROM bridge b
        WHERE b.hk_actor = f.hk_actor AND item_type = 'issue') AS issues_acted,
      (SELECT count(DISTINCT hk_item) FROM bridge b JOIN pr_life q ON q.hk_pull_request = b.hk_item
        WHERE b.hk_actor = f.hk_actor AND item_type = 'pull_request' AND relationship_type = 'pr_actor' AND q.is_merged) AS prs_merged, f.hk_actor
      FROM (SELECT l.hk_actor, m.occurred_at::DATE AS activity_date, count(*) AS events_count, count(DISTINCT l.hk_repo) AS repos_touched,
        count(*) FILTER (WHERE event_type = 'PushEvent') AS pushes, coalesce(sum(push_size) FILTER (WHERE event_type = 'PushEvent'), 0)::BIGINT AS commits_pushed,
        count(*) FILTER (WHERE event_type = 'WatchEvent') AS stars_given, count(*) FILTER (WHERE event_type = 'PullRequestEvent') AS pr_events,
          count(*) FILTER (WHERE event_type = 'IssuesEvent') AS issue_events {_FACTS} GROUP BY ALL) f
      JOIN hub_actor a USING (hk_actor) LEFT JOIN pit_actor_day p ON p.hk_actor = f.hk_actor AND p.as_of_date = f.activity_date LEFT
        JOIN {_at('sat_actor_profile', 'hk_actor')} s ON s.hk_actor = f.hk_actor AND s.occurred_at = p.sat_actor_profile_pit_ts""",
    "collaboration": f"""SELECT i.item_type, i.repo_name, i.item_number, i.participants, i.active_assignee, s.pr_title, s.pr_state, coalesce(q.opened_at, u.opened_at) AS opened_at,
      coalesce(q.closed_at, u.closed_at) AS closed_at, q.merged_at, q.is_merged,
      coalesce(q.cycle_time_hours, u.time_to_close_hours) AS resolution_hours, coalesce(u.assignee_change_count, 0) AS assignee_change_count, i.hk_item
      FROM (SELECT item_type, repo_name, item_number, hk_item, count(DISTINCT hk_actor) FILTER (WHERE relationship_type IN ('pr_actor', 'issue_actor')) AS participants,
        max(actor_login) FILTER (WHERE relationship_type = 'issue_assignee') AS active_assignee FROM bridge GROUP BY ALL) i
      LEFT JOIN pr_life q ON i.item_type = 'pull_request' AND q.hk_pull_request = i.hk_item LEFT JOIN issue_life u ON i.item_type = 'issue' AND u.hk_issue = i.hk_item
      LEFT JOIN (SELECT hk_pull_request, max(sat_pull_request_details_pit_ts) AS ts FROM pit_pull_request_day GROUP BY 1) z ON i.item_type = 'pull_request' AND z.hk_pull_request = i.hk_item
      LEFT JOIN {_at('sat_pull_request_details', 'hk_pull_request')} s ON s.hk_pull_request = z.hk_pull_request AND s.occurred_at = z.ts""",
}


def with_vault(sql: str) -> str:
    ctes = [BASE, *[f"{n} AS MATERIALIZED ({q})" for n, q in {**RAW, **DERIVED}.items() if n in sql or n in "".join(DERIVED.values())]]
    return "WITH " + ",\n".join(ctes) + "\n" + sql


def _vault(name: str) -> str:
    return with_vault(f"SELECT * FROM {name}")


_bad = "event_id % 50"
_ct = f"c AS (SELECT event_id, nullif(event_type, 'error') AS event_type, {_K} AS k FROM events), v AS (SELECT *, concat_ws(';', CASE WHEN event_type IS NULL THEN 'null_violation:event_type' END, CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'enum_violation:event_type' END) AS violations FROM c)"

_FRAME = "CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'PullRequestEvent' ELSE 'IssuesEvent' END"
_REASON = f"CASE {_bad} WHEN 1 THEN 'missing_id' WHEN 2 THEN 'missing_or_bad_created_at' WHEN 3 THEN 'unknown_event_type' WHEN 5 THEN 'unknown_event_type' ELSE 'unparseable_json' END"
#: what the feed's contracts reject among sound lines
_REJECTED = f"{_bad} = 8 OR ({_bad} = 7 AND event_type <> 'click')"


def _stage_events() -> str:
    columns = """actor_display_login, repo_name, push_size, ref_name, pr_number, pr_title, pr_merged, head_ref, owner_login AS base_repo_owner, license AS base_repo_license,
  stargazers_count AS base_repo_stargazers, issue_number, issue_state, issue_comments, assignee_login"""
    return f"""WITH {BASE}
SELECT event_id, 'gharchive.' || event_type AS record_source, epoch(date_trunc('second', occurred_at))::BIGINT AS occurred_s, CASE WHEN event_id::BIGINT % 50 <> 8 THEN actor_login END AS actor_login,
  CASE WHEN event_id::BIGINT % 50 = 7 AND action IS NOT NULL THEN 'bogus' ELSE action END AS action, {columns}
FROM (SELECT * FROM push UNION ALL BY NAME SELECT * FROM watch UNION ALL BY NAME SELECT * FROM pr UNION ALL BY NAME SELECT * FROM iss) WHERE event_id::BIGINT % 50 > 6"""


def _violations_by_type() -> str:
    return f"""SELECT {_FRAME} AS event_type, CASE {_bad} WHEN 7 THEN 'enum_violation:action' ELSE 'null_violation:actor_login' END AS violation, count(*) AS n
FROM events WHERE {_REJECTED} GROUP BY 1, 2"""


def _copy_into() -> str:
    total = f"SELECT count(*) AS lines, count(*) FILTER (WHERE {_bad} > 6) AS events, count(*) FILTER (WHERE {_bad} <= 6) AS quarantined FROM events"
    return f"""WITH t AS ({total})
SELECT 'first/' || k AS what, n FROM (UNPIVOT t ON lines, events, quarantined INTO NAME k VALUE n)
UNION ALL SELECT 'second/' || k, 0 FROM (VALUES ('lines'), ('events'), ('quarantined')) v(k)
UNION ALL SELECT 'event/' || {_FRAME}, count(*) FROM events WHERE {_bad} > 6 GROUP BY 1
UNION ALL SELECT 'keys', count(DISTINCT event_id) FROM events WHERE {_bad} > 6
UNION ALL SELECT 'bad/' || {_REASON}, count(*) FROM events WHERE {_bad} <= 6 GROUP BY 1
UNION ALL SELECT 'ledger', lines FROM t
UNION ALL SELECT 'files without events', 0"""


def _store_tables() -> str:
    def state(step: str, written: str, rows: str, types: str) -> str:
        return f"SELECT '{step}' AS step, ({written})::BIGINT AS written, count(*) AS n_rows, sum(event_id)::BIGINT AS id_sum, count(DISTINCT {types}) AS n_types FROM events WHERE {rows}"

    half, later = "event_id % 2 = 0", "CASE WHEN event_id % 4 <> 0 THEN event_type END"  # rows from before the column came have none
    added, everything = "SELECT count(*) FROM events WHERE event_id % 4 = 2", f"SELECT count(*) FROM events WHERE {half}"
    return "\nUNION ALL ".join(
        [
            state("append", "SELECT count(*) FROM events WHERE event_id % 4 = 0", "event_id % 4 = 0", "NULL::VARCHAR"),
            state("insert_only", added, half, later),
            state("replay", "SELECT 0", half, later),
            state("compact", everything, half, later),
            state("vacuum", "SELECT 2", half, later),
            state("overwrite", "SELECT count(*) FROM events WHERE event_id % 8 = 0", "event_id % 8 = 0", later),
        ]
    )


def _vault_loads() -> str:
    """Counts over the first half and over all; the second load adds the difference, for keys are only inserted."""
    first = " AND event_id <= (SELECT max(event_id) // 2 FROM events)"

    def base(half: str) -> str:
        kept = f"SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events WHERE {_bad} > 6 AND NOT ({_REJECTED}){half}"
        return BASE.replace("FROM events)", f"FROM ({kept}))")

    def counts(half: str) -> str:
        return f"(WITH {base(half)} " + " UNION ALL ".join(f"SELECT '{n}' AS what, count(*) AS n FROM ({q})" for n, q in RAW.items() if n != "eff_sat_issue_assignee") + ")"

    def intervals(half: str) -> str:
        return f"(WITH {base(half)} SELECT DISTINCT lhk_issue_assignee, start_dts, end_dts FROM ({RAW['eff_sat_issue_assignee']}))"

    types = "('PushEvent'), ('WatchEvent'), ('PullRequestEvent'), ('IssuesEvent'), ('ForkEvent'), ('ReleaseEvent')"
    rejected = f"SELECT CASE WHEN event_id <= (SELECT max(event_id) // 2 FROM events) THEN 'first' ELSE 'second' END AS load, {_FRAME} AS frame, event_id FROM events WHERE {_REJECTED}"
    return f"""WITH a AS {counts(first)}, b AS {counts("")}, i AS {intervals(first)}, j AS {intervals("")}, q AS ({rejected}), loads(load) AS (VALUES ('first'), ('second')),
      types(frame) AS (VALUES {types})
SELECT 'first/' || what AS what, n FROM a
UNION ALL SELECT 'second/' || what, b.n - a.n FROM a JOIN b USING (what)
UNION ALL SELECT 'first/eff_sat_issue_assignee', count(*) FROM i
UNION ALL SELECT 'second/eff_sat_issue_assignee', count(*) FROM (SELECT * FROM j EXCEPT SELECT * FROM i)
UNION ALL SELECT load || '/quarantine', count(q.event_id) FROM loads LEFT JOIN q USING (load) GROUP BY load
UNION ALL SELECT load || '/quarantine/' || frame, count(q.event_id) FROM loads CROSS JOIN types LEFT JOIN q USING (load, frame) GROUP BY load, frame"""


ORACLES = {
    "hash_keys_user_entity": f"SELECT event_id, {h('user_id')} AS hk_user, {h('user_id', f"' k/' || {_K}")} AS lhk, {h("nullif(event_type, 'error')", _K)} AS hash_diff FROM events",
    "envelope_valid": f"SELECT event_id::VARCHAR AS event_key, event_type, epoch(date_trunc('second', ts))::BIGINT * 1000 AS ts_ms FROM events WHERE {_bad} > 6",
    "envelope_quarantine_reasons": f"SELECT CASE {_bad} WHEN 1 THEN 'missing_id' WHEN 2 THEN 'missing_or_bad_created_at' WHEN 3 THEN 'unknown_event_type' WHEN 5 THEN 'unknown_event_type' ELSE 'unparseable_json' END AS error_reason, count(*) AS n FROM events WHERE {_bad} <= 6 GROUP BY 1",
    "envelope_reasons_compat": f"SELECT CASE WHEN {_bad} IN (0, 1, 6) THEN 'missing_id' WHEN {_bad} = 2 THEN 'missing_or_bad_created_at' WHEN {_bad} = 3 THEN 'unknown_event_type' WHEN {_bad} = 4 THEN 'unparseable_json' ELSE 'valid' END AS reason, count(*) AS n FROM events GROUP BY 1",
    "ledger_stream_ingest": f"SELECT CASE WHEN {_bad} IN (0, 4, 6) THEN 'unparseable_json' WHEN {_bad} = 1 THEN 'missing_id' WHEN {_bad} = 2 THEN 'missing_or_bad_created_at' WHEN {_bad} IN (3, 5) THEN 'unknown_event_type' ELSE 'valid' END AS reason, count(*) AS n FROM events GROUP BY 1",
    "stage_events": _stage_events(),
    "contract_violations_by_type": _violations_by_type(),
    "copy_into_ledger": _copy_into(),
    "store_tables": _store_tables(),
    "vault_load_counts": _vault_loads(),
    "contract_violations": f"WITH {_ct} SELECT event_id, violations FROM v WHERE violations <> ''",
    "contract_valid": f"WITH {_ct} SELECT event_id, event_type, k FROM v WHERE violations = ''",
    "quarantine_to_json": f"WITH {_ct} SELECT event_id, 'events' AS record_source, '[\"' || replace(violations, ';', '\",\"') || '\"]' AS violations, 'run' AS quarantined_run_id FROM v WHERE violations <> ''",
    "hub_user": _vault("hub_actor"), "hub_entity": _vault("hub_repo"), "hub_pull_request": _vault("hub_pull_request"), "hub_issue": _vault("hub_issue"),
    "link_user_entity": _vault("link_actor_repo"), "link_actor_pull_request": _vault(
        "link_actor_pull_request"
    ), "link_actor_issue": _vault("link_actor_issue"), "link_issue_assignee": _vault("link_issue_assignee"),
    "sat_actor_profile": _vault("sat_actor_profile"), "sat_repo_profile": _vault("sat_repo_profile"), "sat_repo_stats": _vault("sat_repo_stats"), "sat_issue_details": _vault("sat_issue_details"),
    # change detection first, then the first sighting of each changed state: an independent route to the same rows
    "sat_standard_states": with_vault(f"""SELECT hk_pull_request, action, pr_title, pr_state, pr_merged, base_ref, head_ref, hash_diff, {_SRC} FROM (
      SELECT * FROM (SELECT *, {_PR} AS hk_pull_request, {h('action', 'base_ref', 'head_ref', 'pr_merged', 'pr_state', 'pr_title')} AS hash_diff FROM pr)
      QUALIFY lag(hash_diff) OVER (PARTITION BY hk_pull_request ORDER BY occurred_at, event_id::BIGINT) IS DISTINCT FROM hash_diff)
      QUALIFY row_number() OVER (PARTITION BY hk_pull_request, hash_diff ORDER BY occurred_at, event_id::BIGINT) = 1"""),
    "eff_intervals": _vault("eff_sat_issue_assignee"), "eff_resolved": _vault("resolved"), "eff_after_resend": _vault("resolved"), "mas_user_entity_event": _vault("sat_actor_repo_event"),
    "hub_lineitem_composite": f"SELECT {h('l_orderkey', 'l_linenumber')} AS hk_lineitem, l_orderkey, l_linenumber, 'lineitem.' || l_returnflag AS record_source, l_shipdate AS occurred_at FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey::VARCHAR || '/' || l_suppkey, l_returnflag) = 1",
    "link_customer_order_nation": f"SELECT {h('o_custkey', 'o_orderkey', 'c_nationkey')} AS lhk, {h('o_custkey')} AS hk_customer, {h('o_orderkey')} AS hk_order, {h('c_nationkey')} AS hk_nation, 'orders' AS record_source, o_orderdate AS occurred_at FROM orders JOIN customer ON o_custkey = c_custkey",
    "sat_fast_slow_split": f"""WITH s AS (SELECT {_K} AS k, ts, event_id, event_type, floor(value / 10)::BIGINT AS bucket FROM events),
      u AS (SELECT k, ts, event_id, 'slow' AS satellite, event_type AS state FROM s UNION ALL SELECT k, ts, event_id, 'fast', bucket::VARCHAR FROM s)
      SELECT {h('k')} AS hk_entity, {h('state')} AS hash_diff, satellite, arg_min(state, (ts, event_id)) AS state, min(ts) AS occurred_at FROM u GROUP BY k, satellite, {h('state')}""",
    "insert_only_replay": f"""WITH p AS (SELECT DISTINCT user_id, {_K} AS k, event_id % 2 = 0 AS half FROM events), c AS (SELECT count(DISTINCT (user_id, k)) FILTER (WHERE half) AS a,
      count(DISTINCT (user_id, k)) AS b FROM p)
      SELECT a AS rows_added, 1 AS load FROM c UNION ALL SELECT b - a, 2 FROM c UNION ALL SELECT 0, 3""",
    "date_spine": "SELECT DISTINCT ts::DATE AS as_of_date FROM events",
    "pit_entity_day": _vault("pit_repo_day"), "pit_user_day": _vault("pit_actor_day"), "pit_pull_request_day": _vault("pit_pull_request_day"), "bridge_collaboration": _vault("bridge"),
    "lifecycle_item": _vault("pr_life"), "lifecycle_with_churn": _vault("issue_life"),
    "entity_activity_mart": with_vault(MARTS["repo_activity"]), "user_360_mart": with_vault(MARTS["developer_360"]), "collaboration_mart": with_vault(MARTS["collaboration"]),
    "latest_state": with_vault(
        "SELECT hk_issue, action, issue_state, hash_diff, occurred_at FROM sat_issue_details QUALIFY row_number() OVER (PARTITION BY hk_issue ORDER BY occurred_at DESC, hash_diff DESC) = 1"
    ),
    "dq_not_null": "SELECT count(*) FILTER (WHERE event_type = 'error') AS null_values FROM events",
    "dq_unique": "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_keys FROM lineitem",
    "dq_accepted_values": "SELECT count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'error')) AS outside FROM events",
    "dq_row_count_between": "SELECT count(*) AS row_count, count(*) BETWEEN 1 AND 10000 AS passed FROM orders",
    "dq_freshness": "SELECT floor((1706745600 - epoch_us(max(ts)) / 1e6) / 60)::BIGINT AS age_minutes FROM events",
    "dq_referential_integrity": "SELECT l_returnflag, count(*) AS orphans FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25) GROUP BY 1",
    "dq_row_count_match": "SELECT o AS n_orders, c AS n_customer, abs(o - c) AS drift FROM (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM customer) AS c)",
    "dq_suite_summary": """WITH n AS (SELECT count(*) AS n, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS dup, count(*) FILTER (WHERE l_returnflag NOT IN ('A',
      'N')) AS outside, count(*) FILTER (WHERE l_orderkey IS NULL) AS nul,
        count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)) AS orphans, (SELECT count(*) FROM orders) AS o FROM lineitem),
      r(position, check_type, bad, ok, observed) AS (SELECT 0, 'not_null', 'fail', nul = 0, nul || ' nulls' FROM n UNION ALL SELECT 1, 'unique', 'warn', dup = 0,
        dup || ' duplicate keys' FROM n UNION ALL SELECT 2, 'accepted_values', 'fail', outside = 0, outside || ' values outside' FROM n
        UNION ALL SELECT 3, 'row_count_between', 'fail', n >= 1, n || ' rows' FROM n UNION ALL SELECT 4, 'referential_integrity', 'fail', orphans = 0, orphans || ' orphans' FROM n
          UNION ALL SELECT 5, 'row_count_match', 'fail', abs(n - o) <= 10, n || ' rows, ' || o || ' in orders' FROM n)
      SELECT position, check_type, CASE WHEN ok THEN 'pass' ELSE bad END AS status, observed FROM r""",
    "tpch_chain_revenue": "SELECT r_name, n_name, sum(round(l_extendedprice * 100)::BIGINT * (100 - round(l_discount * 100)::BIGINT))::BIGINT AS revenue_e4, count(*) AS line_items FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
    "metrics_latest_run": "SELECT 'run-' || user_id AS run_id, event_type AS pipeline, event_id::VARCHAR AS step, ts AS started_at FROM events WHERE 'run-' || user_id = (SELECT 'run-' || user_id FROM events ORDER BY ts DESC, 'run-' || user_id DESC LIMIT 1)",
}
