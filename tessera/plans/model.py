"""The declared vault: hubs, links, satellites, point-in-time tables and marts, and where their columns come from.

A vault is a YAML or JSON file; `data/vault.json` is the one of the source-control feed.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from pathlib import Path

from tessera.operators.vault import Extract


@dataclass(frozen=True)
class Hub:
    name: str
    business_keys: tuple[str, ...]
    sources: tuple[Extract, ...] = ()

    @property
    def key(self) -> str:
        return "hk_" + self.name.removeprefix("hub_")


@dataclass(frozen=True)
class Link:
    """`hubs` are in hash order; `roles` maps a hub's business key to the column of the extract that holds it."""

    name: str
    hubs: tuple[str, ...]
    sources: tuple[Extract, ...] = ()
    driving_key: str | None = None

    def __post_init__(self):
        if self.driving_key and self.driving_key not in self.hubs:
            raise ValueError(f"{self.name}: driving key {self.driving_key!r} is not one of {self.hubs}")

    @property
    def key(self) -> str:
        return "lhk_" + self.name.removeprefix("link_")


@dataclass(frozen=True)
class Satellite:
    name: str
    parent: str
    attributes: tuple[str, ...]
    sources: tuple[Extract, ...] = ()
    kind: str = "standard"
    subsequence_key: str | None = None

    def __post_init__(self):
        if self.kind not in ("standard", "multi_active", "effectivity"):
            raise ValueError(f"{self.name}: unknown kind {self.kind!r}")
        if (self.kind == "multi_active") != (self.subsequence_key is not None):
            raise ValueError(f"{self.name}: a subsequence key belongs to multi-active satellites, and they need one")


@dataclass(frozen=True)
class Mart:
    name: str
    grain: tuple[str, ...]
    pit: str


@dataclass(frozen=True)
class Vault:
    hubs: tuple[Hub, ...]
    links: tuple[Link, ...]
    satellites: tuple[Satellite, ...]
    pits: dict[str, tuple[str, tuple[str, ...]]] = field(default_factory=dict)
    marts: tuple[Mart, ...] = ()

    def __post_init__(self):
        names = [x.name for x in (*self.hubs, *self.links, *self.satellites)]
        if len(set(names)) != len(names):
            raise ValueError("two objects have one name")
        for link in self.links:
            for h in link.hubs:
                self.hub(h)
        for sat in self.satellites:
            self.parent(sat)

    @staticmethod
    def _find(items, name: str, what: str):
        for x in items:
            if x.name == name:
                return x
        raise KeyError(f"no {what} {name!r}; there are {[x.name for x in items]}")

    def hub(self, name: str) -> Hub:
        return self._find(self.hubs, name, "hub")

    def link(self, name: str) -> Link:
        return self._find(self.links, name, "link")

    def satellite(self, name: str) -> Satellite:
        return self._find(self.satellites, name, "satellite")

    def mart(self, name: str) -> Mart:
        return self._find(self.marts, name, "mart")

    def parent(self, sat: Satellite) -> Hub | Link:
        return self._find((*self.hubs, *self.links), sat.parent, "parent")

    def parent_keys(self, link: Link) -> dict[str, tuple[str, ...]]:
        """hash key -> business keys of the link's hubs, in hash order."""
        return {self.hub(h).key: self.hub(h).business_keys for h in link.hubs}

    def key_columns(self, name: Hub | Link) -> tuple[str, ...]:
        """The columns that are hashed; a business key that two hubs share is hashed for each."""
        return name.business_keys if isinstance(name, Hub) else tuple(c for cols in self.parent_keys(name).values() for c in cols)


@dataclass(frozen=True)
class Settings:
    """What a deployment sets besides the vault; folders are absolute or below the root."""

    landing_dir: str
    lakehouse_root: str
    run_dir: str
    reports_dir: str
    driver_memory: str = "3g"
    shuffle_partitions: int = 8
    session_timezone: str = "UTC"


#: The multi-active satellite's attributes with their types, in hash order.
EVENT_ATTRIBUTES = {"event_type": "string", "action": "string", "push_size": "int", "push_distinct_size": "int", "ref_name": "string"}
#: The environment's root for relative folders of a configuration.
ROOT = "LAKEHOUSE_ROOT"
DATA = Path(__file__).resolve().parents[1] / "data"


def read_file(path: str | Path) -> dict:
    """A YAML or JSON file."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(text)
    return json.loads(text)


def vault_from(raw: dict) -> Vault:
    """A vault from its declaration; unknown keys, names that are not there and empty lists fail here."""

    def sources(x: dict) -> tuple[Extract, ...]:
        return tuple(Extract(s["frame"], dict(s["columns"]), s.get("where")) for s in x.get("sources", ()))

    def made(kind: type, x: dict):
        rest = {k: tuple(v) if isinstance(v, list) else v for k, v in x.items() if k != "sources"}
        return kind(**rest, sources=sources(x))

    if not raw.get("hubs") or not raw.get("event_types"):
        raise ValueError("a vault has event types and hubs")
    frames = set(raw["event_types"])
    for x in (*raw["hubs"], *raw.get("links", ()), *raw.get("satellites", ())):
        if lost := {s["frame"] for s in x.get("sources", ())} - frames:
            raise ValueError(f"{x['name']}: no event types {sorted(lost)}")
    pits = {p["name"]: (p["hub"], tuple(p["satellites"])) for p in raw.get("pits", ())}
    marts = tuple(Mart(m["name"], tuple(m["grain"]), m["pit"]) for m in raw.get("marts", ()))
    objects = {k: tuple(made(kind, x) for x in raw.get(k, ())) for k, kind in (("hubs", Hub), ("links", Link), ("satellites", Satellite))}
    vault = Vault(**objects, pits=pits, marts=marts)
    for hub, satellites in pits.values():
        vault.hub(hub)
        for s in satellites:
            vault.satellite(s)
    for m in marts:
        if m.pit not in pits or not m.grain:
            raise ValueError(f"{m.name}: needs a grain and one of the pointer tables {sorted(pits)}")
    return vault


def load_vault(path: str | Path = DATA / "vault.json") -> Vault:
    return vault_from(read_file(path))


def load_settings(path: str | Path = DATA / "vault.json", root: str | None = None) -> Settings:
    """The settings of a configuration; relative folders lie below `root`, else the environment's root, else the current folder."""
    raw = read_file(path)
    root = root or os.environ.get(ROOT) or os.getcwd()
    folders = {"landing_dir": raw["source"]["landing_dir"], **raw["storage"]}
    return Settings(**{k: os.path.normpath(os.path.join(root, v)) for k, v in folders.items()}, **raw.get("spark", {}))


GITHUB = load_vault()
