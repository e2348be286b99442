"""A seeded feed of source-control events as hourly newline-delimited JSON files, with some lines damaged."""

from __future__ import annotations

import json
import random
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from pathlib import Path

# fixed values: the feed's clock and frequencies
START, STEP_SECONDS = datetime(2026, 1, 1, tzinfo=UTC), (5, 90)
WEIGHTS = {"PushEvent": 40, "PullRequestEvent": 18, "IssuesEvent": 18, "WatchEvent": 12, "ForkEvent": 7, "ReleaseEvent": 5}
PR_ACTIONS = {"opened": 5, "closed": 4, "reopened": 1}
ISSUE_ACTIONS = {"opened": 4, "closed": 3, "assigned": 3, "unassigned": 1, "reopened": 1}
ACTORS, REPOS = 20, 12
SYLLABLES = "ka lo mi ren tas vu bel dor fi gan hel jo".split()


@dataclass
class World:
    """Actors, repositories, pull requests and issues, and a random source that all choices come from."""

    rng: random.Random
    actors: list[dict] = field(default_factory=list)
    repos: list[dict] = field(default_factory=list)
    items: dict[str, list[dict]] = field(default_factory=dict)

    def word(self, n: int = 3) -> str:
        return "".join(self.rng.choices(SYLLABLES, k=n))

    def pick(self, weights: dict[str, int]) -> str:
        return self.rng.choices(list(weights), list(weights.values()))[0]

    def actor(self) -> dict:
        i = 1001 + len(self.actors)
        login = f"{self.word()}{i % 97}"
        self.actors.append({"id": i, "login": login, "display_login": login, "avatar_url": f"https://avatars.example.test/u/{i}"})
        return self.actors[-1]

    def repo(self, created_at: str, owner: dict | None = None, like: dict | None = None) -> dict:
        owner = owner or self.rng.choice(self.actors)
        i = 5001 + len(self.repos)
        name = f"{owner['login']}/{like['full_name'].split('/')[1] if like else self.word(2) + '-' + self.word(2) + str(i)}"
        r = {
            "id": i, "name": name.split("/")[1], "full_name": name, "owner": {"login": owner["login"]}, "language": self.rng.choice(
                ["Python", "Go", "Rust", "Scala", None]
            ), "default_branch": self.rng.choice(["main"] * 3 + ["trunk"]),
            "license": self.rng.choice(
                [{"key": "mit"}, {"key": "apache-2.0"}, None]
            ), "created_at": created_at, "stargazers_count": self.rng.randint(0, 50), "forks_count": self.rng.randint(0, 10), "open_issues_count": 0, "watchers_count": self.rng.randint(0, 30),
        }
        self.repos.append(r)
        return r

    def item(self, kind: str, repo: dict, wish: str) -> tuple[dict, str]:
        """An item for the wished action, and the action that is possible: without a fitting item, one is opened."""
        there = self.items.setdefault(f"{kind}/{repo['full_name']}", [])
        fits = [x for x in there if (x["state"] == "closed") == (wish == "reopened") and (wish != "unassigned" or x.get("assignee"))]
        if wish == "opened" or not fits:
            there.append({"number": len(there) + 1, "title": f"{self.word()} {self.word(2)}", "state": "open", "comments": 0, "merged": False, "head": f"feature/{self.word(2)}"})
            return there[-1], "opened"
        return self.rng.choice(fits), wish


def _payload(w: World, kind: str, repo: dict, now: str) -> dict:
    if kind == "PushEvent":
        size = w.rng.randint(1, 8)
        return {
            "push_id": w.rng.randint(10**6, 10**7),
            "size": size,
            "distinct_size": w.rng.randint(1, size),
            "ref": f"refs/heads/{repo['default_branch']}",
            "head": f"{w.rng.getrandbits(160):040x}",
            "before": f"{w.rng.getrandbits(160):040x}",
        }
    if kind == "PullRequestEvent":
        pr, action = w.item("pr", repo, w.pick(PR_ACTIONS))
        pr["state"] = "closed" if action == "closed" else "open"
        pr["merged"] = pr["merged"] or (action == "closed" and w.rng.random() < 0.7)
        return {
            "action": action,
            "number": pr["number"],
            "pull_request": {
                "number": pr["number"],
                "title": pr["title"],
                "state": pr["state"],
                "merged": pr["merged"],
                "base": {"ref": repo["default_branch"], "repo": dict(repo)},
                "head": {"ref": pr["head"]},
            },
        }
    if kind == "IssuesEvent":
        issue, action = w.item("issue", repo, w.pick(ISSUE_ACTIONS))
        repo["open_issues_count"] += {"opened": 1, "reopened": 1, "closed": -1}.get(action, 0)
        issue["state"] = "closed" if action == "closed" else "open"
        issue["comments"] += w.rng.randint(0, 2)
        out = {"action": action, "issue": {k: issue[k] for k in ("number", "title", "state", "comments")}}
        if action == "assigned":
            issue["assignee"] = w.rng.choice(w.actors)["login"]
        if action in ("assigned", "unassigned"):
            out["assignee"] = {"login": issue["assignee"]}
        return out
    if kind == "WatchEvent":
        repo["stargazers_count"] += 1
        return {"action": "started"}
    if kind == "ForkEvent":
        repo["forks_count"] += 1
        return {"forkee": dict(w.repo(now, w.rng.choice(w.actors), repo))}
    return {"action": "published", "release": {"tag_name": f"v{w.rng.randint(0, 9)}.{w.rng.randint(0, 99)}", "name": w.word(), "draft": False, "prerelease": w.rng.random() < 0.2}}


def damaged(line: str, rng: random.Random) -> str:
    kind = rng.choice(["cut", "no id", "not json"])
    return line[: len(line) // 2] if kind == "cut" else line.replace('"id":', '"identifier":', 1) if kind == "no id" else "GARBAGE " + line[:40]


def generate(folder: str | Path, events: int = 2000, seed: int = 42, corrupt: float = 0.02) -> dict[str, int]:
    """Writes YYYY-MM-DD-H.ndjson files; counts of events, damaged lines and files. The same arguments give the same bytes.

    Damage has a random source of its own, so that the events do not depend on it.
    """
    w, noise = World(random.Random(seed)), random.Random(seed + 1)
    for _ in range(ACTORS):
        w.actor()
    for _ in range(REPOS):
        w.repo("2025-06-01T00:00:00Z")
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    now, bad, files = START, 0, {}
    for i in range(events):
        now += timedelta(seconds=w.rng.randint(*STEP_SECONDS))
        at, kind = now.strftime("%Y-%m-%dT%H:%M:%SZ"), w.pick(WEIGHTS)
        actor, repo = w.rng.choice(w.actors), w.rng.choice(w.repos)
        payload = _payload(w, kind, repo, at)
        event = {
            "id": str(10**9 + i),
            "type": kind,
            "actor": actor,
            "repo": {"id": repo["id"], "name": repo["full_name"], "url": f"https://api.example.test/repos/{repo['full_name']}"},
            "payload": payload,
            "public": True,
            "created_at": at,
        }
        line = json.dumps(event)
        if noise.random() < corrupt:
            line, bad = damaged(line, noise), bad + 1
        files.setdefault(f"{now:%Y-%m-%d}-{now.hour}.ndjson", []).append(line)
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    return {"events": events, "corrupt": bad, "files": len(files)}
