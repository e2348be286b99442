"""Versioned data contracts: the model, Spark schemas, enforcement in one pass, and compatibility of versions."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.staging import EVENT_TYPES

_NAME = re.compile(r"[a-z][a-z0-9_]*")
_DECIMAL = re.compile(r"decimal\((\d{1,2}),\s*(\d{1,2})\)")
_TYPES = {"string": T.StringType(), "integer": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType()}
PII_CATEGORIES = ("direct_identifier", "quasi_identifier", "sensitive", "financial")


def spark_type(name: str) -> T.DataType:
    if m := _DECIMAL.fullmatch(name):
        return T.DecimalType(int(m[1]), int(m[2]))
    if name not in _TYPES:
        raise ValueError(f"no contract type {name!r}")
    return _TYPES[name]


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    allowed_values: tuple[str, ...] = ()
    pii_category: str | None = None
    pii: bool | None = None
    description: str = ""

    def __post_init__(self):
        if not _NAME.fullmatch(self.name):
            raise ValueError(f"field name {self.name!r} is not snake case")
        spark_type(self.type)
        if self.pii is None:
            object.__setattr__(self, "pii", self.pii_category is not None)
        if self.pii != (self.pii_category is not None):
            raise ValueError(f"field {self.name!r}: personal data has a category, other data has none")
        if self.pii_category is not None and self.pii_category not in PII_CATEGORIES:
            raise ValueError(f"field {self.name!r}: no category {self.pii_category!r}")
        object.__setattr__(self, "allowed_values", tuple(self.allowed_values or ()))


@dataclass(frozen=True)
class Contract:
    contract: str
    version: int
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...]
    event_time_field: str
    owner: str = ""
    description: str = ""
    freshness_hours: int = 24

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if not _NAME.fullmatch(self.contract) or self.version < 1 or self.freshness_hours < 1 or not names or not self.primary_key:
            raise ValueError(f"contract {self.contract!r} is incomplete")
        if len(set(names)) != len(names):
            raise ValueError(f"contract {self.contract!r} names a field twice")
        for k in (*self.primary_key, self.event_time_field):
            if k not in names:
                raise ValueError(f"contract {self.contract!r} has no field {k!r}")
        for k in self.primary_key:
            if self.field(k).nullable:
                raise ValueError(f"primary key {k!r} must not be nullable")

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(f"contract {self.contract!r} has no field {name!r}")

    @property
    def pii_fields(self) -> list[Field]:
        return [f for f in self.fields if f.pii]

    def struct(self) -> T.StructType:
        """All fields nullable: nulls are for enforcement to find, not for the parser."""
        return T.StructType([T.StructField(f.name, spark_type(f.type), True) for f in self.fields])


def from_dict(raw: dict) -> Contract:
    raw = dict(raw)
    if "sla" in raw:
        raw["freshness_hours"] = raw.pop("sla")["freshness_hours"]
    raw["fields"] = tuple(Field(**f) for f in raw["fields"])
    raw["primary_key"] = tuple(raw["primary_key"])
    return Contract(**raw)


def load_contract(path: str | Path) -> Contract:
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith((".yaml", ".yml")):
        import yaml

        return from_dict(yaml.safe_load(text))
    return from_dict(json.loads(text))


def load_contracts(folder: str | Path) -> dict[str, Contract]:
    """The latest version of each contract in a folder of YAML or JSON files."""
    out: dict[str, Contract] = {}
    for c in all_versions(folder):
        if c.contract not in out or out[c.contract].version < c.version:
            out[c.contract] = c
    return out


def all_versions(folder: str | Path) -> list[Contract]:
    return [load_contract(p) for p in sorted(Path(folder).iterdir()) if p.suffix in (".yaml", ".yml", ".json")]


def violations(contract: Contract) -> Column:
    """The array of what a row breaks, in field order: null_violation:<field>, enum_violation:<field>."""
    checks = [F.when(F.col(f.name).isNull(), f"null_violation:{f.name}") for f in contract.fields if not f.nullable]
    checks += [F.when(F.col(f.name).isNotNull() & ~F.col(f.name).isin(*f.allowed_values), f"enum_violation:{f.name}") for f in contract.fields if f.allowed_values]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def coerced(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns in their types; what cannot be cast is null, a missing column too. Other columns stay."""
    return df.withColumns({f.name: F.col(f.name).try_cast(spark_type(f.type)) if f.name in df.columns else F.lit(None).cast(spark_type(f.type)) for f in contract.fields})


def enforce(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with `violations`), both from one evaluation per row."""
    marked = coerced(df, contract).withColumn("violations", violations(contract))
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def quarantine_rows(rejected: DataFrame, run_id: str) -> DataFrame:
    return rejected.select("event_id", "record_source", F.to_json("violations").alias("violations"), F.lit(run_id).alias("quarantined_run_id"), "occurred_at")


def breaking_changes(old: Contract, new: Contract) -> list[str]:
    """Why readers of `old` cannot read `new`; empty if they can."""
    out = [f"{what} changed" for what in ("primary_key", "event_time_field") if getattr(old, what) != getattr(new, what)]
    now = {f.name: f for f in new.fields}
    for f in old.fields:
        g = now.pop(f.name, None)
        if g is None:
            out.append(f"{f.name} removed")
            continue
        if g.type != f.type:
            out.append(f"{f.name} was {f.type}, is {g.type}")
        if f.nullable and not g.nullable:
            out.append(f"{f.name} tightened to not null")
        if lost := sorted(set(f.allowed_values) - set(g.allowed_values)):
            out.append(f"{f.name} lost values {lost}")
    return out + [f"new field {n} is not nullable" for n, g in now.items() if not g.nullable]


def check_folder(folder: str | Path) -> dict[str, list[str]]:
    """contract -> breaking changes between neighbouring versions."""
    by: dict[str, list[Contract]] = {}
    for c in all_versions(folder):
        by.setdefault(c.contract, []).append(c)
    out = {}
    for name, versions in by.items():
        versions.sort(key=lambda c: c.version)
        out[name] = [f"v{a.version} to v{b.version}: {x}" for a, b in zip(versions, versions[1:], strict=False) for x in breaking_changes(a, b)]
    return out


def contract_name(event_type: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", event_type).lower()


#: Event type -> contract of its staged frame, by the files of the feed's contracts.
GITHUB_CONTRACTS = {t: c for c in load_contracts(Path(__file__).resolve().parents[1] / "data" / "contracts").values() for t in EVENT_TYPES if contract_name(t) == c.contract}
