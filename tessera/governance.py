"""Tags of personal data and the access matrix, rendered from contracts and from `data/governance.json`."""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from tessera.operators.contracts import GITHUB_CONTRACTS, Contract

_RAW = json.loads((Path(__file__).resolve().parent / "data" / "governance.json").read_text(encoding="utf-8"))
#: Where contract fields land: field -> (table, column).
PLACEMENTS: dict[str, list[tuple[str, str]]] = {f: [tuple(x) for x in places] for f, places in _RAW["placements"].items()}
#: principal -> what it is.
PRINCIPALS: dict[str, str] = {p["name"]: p["kind"] for p in _RAW["principals"]}
#: (principal, securable, privileges)
GRANTS = [(g["principal"], g["securable"], tuple(g["privileges"])) for g in _RAW["grants"]]


def pii_tags(contracts: Iterable[Contract] = tuple(GITHUB_CONTRACTS.values()), placements: dict = PLACEMENTS) -> str:
    """SET TAGS statements, sorted; fails for a personal field without a place."""
    out = set()
    for c in contracts:
        for f in c.pii_fields:
            if f.name not in placements:
                raise LookupError(f"{c.contract}.{f.name} is personal data without a placement")
            out |= {f"ALTER TABLE {t} ALTER COLUMN {col} SET TAGS ('pii' = 'true', 'pii_category' = '{f.pii_category}');" for t, col in placements[f.name]}
    return "\n".join(sorted(out)) + "\n"


def access_matrix(grants: list[tuple[str, str, tuple[str, ...]]] = GRANTS, principals: dict[str, str] = PRINCIPALS) -> str:
    """Markdown: a row per principal with its kind, a column per securable; fails for a grant to nobody known."""
    if lost := {g[0] for g in grants} - set(principals):
        raise LookupError(f"grants to unknown principals {sorted(lost)}")
    what = sorted({g[1] for g in grants})
    held: dict[tuple[str, str], set[str]] = {}
    for p, s, v in grants:
        held.setdefault((p, s), set()).update(v)
    cell = lambda p, s: ", ".join(sorted(held[p, s])) if (p, s) in held else "-"
    lines = ["| principal | kind | " + " | ".join(what) + " |", "|---" * (len(what) + 2) + "|"]
    return "\n".join([*lines, *[f"| {p} | {kind} | " + " | ".join(cell(p, s) for s in what) + " |" for p, kind in sorted(principals.items())]]) + "\n"


def pii_inventory(contracts: Iterable[Contract] = tuple(GITHUB_CONTRACTS.values()), placements: dict = PLACEMENTS) -> str:
    """Markdown: a row per personal field with its category, the contracts that have it, and where it lands."""
    found: dict[str, tuple[str, set[str]]] = {}
    for c in contracts:
        for f in c.pii_fields:
            found.setdefault(f.name, (f.pii_category, set()))[1].add(c.contract)
    lines = ["| field | category | contracts | columns |", "|---|---|---|---|"]
    for name, (category, where) in sorted(found.items()):
        lines.append(f"| {name} | {category} | {', '.join(sorted(where))} | {', '.join(f'{t}.{c}' for t, c in placements.get(name, [])) or '-'} |")
    return "\n".join(lines) + "\n"


def write_generated(folder: str | Path) -> list[Path]:
    """Writes pii_tags.sql and access_matrix.md (with the inventory of personal data)."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    out = {"pii_tags.sql": pii_tags(), "access_matrix.md": "# Access\n\n" + access_matrix() + "\n# Personal data\n\n" + pii_inventory()}
    for name, text in out.items():
        (folder / name).write_text(text, encoding="utf-8")
    return [folder / name for name in out]
