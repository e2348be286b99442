"""Declarative data-quality checks. All checks of a suite that look at one table alone are computed in a single aggregate."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFERENCE_TIME = "LAKEHOUSE_DQ_REFERENCE_TIME"
SEVERITIES = ("error", "warn")


def reference_time() -> datetime:
    """What freshness is measured against: the environment's instant if set, else now."""
    pinned = os.environ.get(REFERENCE_TIME)
    at = datetime.fromisoformat(pinned) if pinned else datetime.now(UTC)
    return at if at.tzinfo else at.replace(tzinfo=UTC)


@dataclass(frozen=True)
class Check:
    """type is one of TYPES; the other fields are those that type uses."""

    type: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    values: tuple = ()
    min_rows: int = 0
    max_rows: int | None = None
    max_age_hours: float | None = None
    ref_table: str | None = None
    ref_column: str | None = None
    ref_filter: str | None = None
    tolerance: int = 0
    severity: str = "error"

    def __post_init__(self):
        if self.type not in TYPES:
            raise ValueError(f"no check {self.type!r}; there are {sorted(TYPES)}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"no severity {self.severity!r}")
        for need in TYPES[self.type]:
            if getattr(self, need) in (None, ()):
                raise ValueError(f"{self.type} needs {need}")

    def describe(self) -> str:
        shown = {k: v for k, v in vars(self).items() if k not in ("type", "severity") and v not in (None, (), 0)}
        return f"{self.type}({', '.join(f'{k}={v}' for k, v in shown.items())})"


#: check -> the fields it cannot do without
TYPES: dict[str, tuple[str, ...]] = {
    "not_null": ("column",),
    "unique": ("columns",),
    "accepted_values": ("column", "values"),
    "row_count_between": (),
    "freshness": ("column", "max_age_hours"),
    "referential_integrity": ("column", "ref_table", "ref_column"),
    "row_count_match": ("ref_table",),
}


@dataclass(frozen=True)
class Suite:
    table: str
    checks: tuple[Check, ...]
    layer: str = ""
    filter: str | None = None


@dataclass(frozen=True)
class CheckResult:
    check: Check
    passed: bool
    observed: str

    @property
    def status(self) -> str:
        return "pass" if self.passed else "fail" if self.check.severity == "error" else "warn"


@dataclass(frozen=True)
class SuiteResult:
    suite: Suite
    row_count: int
    results: tuple[CheckResult, ...]
    executed_at: datetime = field(default_factory=lambda: datetime.now(UTC))

    def count(self, status: str) -> int:
        return sum(r.status == status for r in self.results)

    @property
    def pass_rate(self) -> float:
        return self.count("pass") / len(self.results) if self.results else 1.0


def nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def duplicates(columns: Sequence[str]) -> Column:
    """Rows beyond the first of each key; a null is a value."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*columns))


def outside(column: str, values: Sequence) -> Column:
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def orphans(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """The rows whose value is not null and not in the referenced column."""
    keys = ref.select(F.col(ref_column).alias("_ref")).where("_ref is not null").distinct()
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_ref"), "left_anti")


def _measure(check: Check) -> Column | None:
    match check.type:
        case "not_null":
            return nulls(check.column)
        case "unique":
            return duplicates(check.columns)
        case "accepted_values":
            return outside(check.column, check.values)
        case "freshness":
            return F.max(F.unix_micros(F.col(check.column).cast("timestamp")))
    return None


def run_suite(suite: Suite, resolve: Callable[[str], DataFrame]) -> SuiteResult:
    """One aggregate over the table for its own checks; one job per referential check and one count per referenced table."""
    df = resolve(suite.table)
    df = df.where(suite.filter) if suite.filter else df
    own = {i: m for i, c in enumerate(suite.checks) if (m := _measure(c)) is not None}
    row = df.agg(F.count(F.lit(1)).alias("n"), *[m.alias(f"c{i}") for i, m in own.items()]).first()
    n, results = row["n"], []
    for i, c in enumerate(suite.checks):
        v = row[f"c{i}"] if i in own else None
        ref = None
        if c.ref_table:
            ref = resolve(c.ref_table)
            ref = ref.where(c.ref_filter) if c.ref_filter else ref
        match c.type:
            case "not_null":
                passed, seen = v == 0, f"{v} nulls"
            case "unique":
                passed, seen = v == 0, f"{v} duplicate keys"
            case "accepted_values":
                passed, seen = v == 0, f"{v} values outside"
            case "row_count_between":
                passed, seen = n >= c.min_rows and (c.max_rows is None or n <= c.max_rows), f"{n} rows"
            case "freshness":
                age = None if v is None else (reference_time().timestamp() - v / 1e6) / 3600
                passed, seen = age is not None and age <= c.max_age_hours, "no event time" if age is None else f"newest is {age:.1f} h old"
            case "referential_integrity":
                lost = orphans(df, c.column, ref, c.ref_column).count()
                passed, seen = lost == 0, f"{lost} orphans"
            case _:
                other = ref.count()
                passed, seen = abs(n - other) <= c.tolerance, f"{n} rows, {other} in {c.ref_table}"
        results.append(CheckResult(c, passed, seen))
    return SuiteResult(suite, n, tuple(results))


def suite_from(raw: dict) -> Suite:
    checks = tuple(Check(**{k: tuple(v) if isinstance(v, list) else v for k, v in c.items()}) for c in raw["checks"])
    return Suite(raw["table"], checks, raw.get("layer", ""), raw.get("filter"))


#: The suites of the feed's lakehouse, a file for each table.
SUITES = Path(__file__).resolve().parents[1] / "data" / "suites"


def load_suites(folder: str | Path = SUITES) -> list[Suite]:
    """Suites of a folder of YAML or JSON files; an unknown check fails here."""
    out = []
    for p in sorted(Path(folder).iterdir()):
        if p.suffix in (".yaml", ".yml"):
            import yaml

            out.append(suite_from(yaml.safe_load(p.read_text())))
        elif p.suffix == ".json":
            out.append(suite_from(json.loads(p.read_text())))
    return out


def write_report(result: SuiteResult, folder: str | Path) -> Path:
    path = Path(folder) / f"{result.suite.table.replace('/', '_')}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    body = {
        "table": result.suite.table, "layer": result.suite.layer, "row_count": result.row_count, "executed_at": result.executed_at.isoformat(), "pass_rate": result.pass_rate,
        "checks": [{"check": r.check.describe(), "severity": r.check.severity, "status": r.status, "observed": r.observed} for r in result.results],
    }
    path.write_text(json.dumps(body, indent=2, sort_keys=True) + "\n")
    return path


def vault_suites(model) -> list[Suite]:
    """Suites of all layers, derived from the declared vault: keys, references, reconciliation with bronze, grains."""
    from tessera.sources.staging import EVENT_TYPES

    null = lambda *cs: tuple(Check("not_null", column=c) for c in cs)
    ref = lambda column, table: Check("referential_integrity", column=column, ref_table=table, ref_column=column)
    out = [
        Suite(
            "bronze/github_events",
            (
                *null("event_key"),
                Check("unique", columns=("event_key",), severity="warn"),
                Check("accepted_values", column="event_type", values=tuple(EVENT_TYPES)),
                Check("row_count_between", min_rows=1),
            ),
            "bronze",
        )
    ]
    for h in model.hubs:
        out.append(Suite(f"raw_vault/{h.name}", (Check("unique", columns=(h.key,)), *null(h.key, *h.business_keys)), "silver"))
    for ln in model.links:
        out.append(Suite(f"raw_vault/{ln.name}", (Check("unique", columns=(ln.key,)), *null(ln.key), *[ref(model.hub(h).key, f"raw_vault/{h}") for h in ln.hubs]), "silver"))
    for s in model.satellites:
        parent = model.parent(s)
        key = {"multi_active": (parent.key, s.subsequence_key), "effectivity": (parent.key, "start_dts", "end_dts")}.get(s.kind, (parent.key, "hash_diff"))
        checks = (Check("unique", columns=key), *null(*key, "record_source"), ref(parent.key, f"raw_vault/{parent.name}"))
        out.append(Suite(f"raw_vault/{s.name}", checks, "silver"))
    for pit, (hub, _) in model.pits.items():
        key = model.hub(hub).key
        out.append(Suite(f"business_vault/{pit}", (Check("unique", columns=(key, "as_of_date")), ref(key, f"raw_vault/{hub}")), "silver"))
    for m in model.marts:
        out.append(Suite(f"gold/{m.name}", (Check("unique", columns=m.grain), *null(*m.grain), Check("row_count_between", min_rows=1)), "gold"))
    return out
