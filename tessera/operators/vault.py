"""Raw-vault operators: pure functions from staged frames to candidates, and the insert-only selection of new rows.

Staged frames have event_id, record_source and occurred_at besides their own columns. Orders are total: occurred_at, then
the numeric event id, then its text, then the source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_diff, hash_key

# fixed values: the end of an open interval, and the pointer of a day without a state
HIGH_DTS, GHOST_DTS = "9999-12-31 00:00:00", "1900-01-01 00:00:00"


@dataclass(frozen=True)
class Extract:
    """Where an object's columns come from in one staged frame: object column -> staged column; rows that pass `where`."""

    frame: str
    columns: dict[str, str]
    where: str | None = None

    def of(self, staged: dict[str, DataFrame], keep: Sequence[str] = ("event_id", "record_source", "occurred_at")) -> DataFrame:
        df = staged[self.frame]
        df = df.where(self.where) if self.where else df
        return df.select(*[F.col(s).alias(c) for c, s in self.columns.items()], *[c for c in keep if c not in self.columns])


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Wide:
    """Staged frames in one: the frame's name in `frame`, and the columns of all frames, null where a frame lacks them.

    An object is extracted from all its frames in one scan; `Wide` otherwise reads like a dict of frames.
    """

    df: DataFrame
    frames: tuple[str, ...]

    def __contains__(self, frame: str) -> bool:
        return frame in self.frames

    def __getitem__(self, frame: str) -> DataFrame:
        return self.df.where(F.col("frame") == frame).drop("frame")

    def extracted(self, sources: Sequence[Extract], keep: Sequence[str] = ("event_id", "record_source", "occurred_at")) -> DataFrame:
        """The rows of all extracts; a row whose frame has several extracts stands in each."""
        turns: list[dict[str, Extract]] = []  # no frame twice in a turn
        for s in (s for s in sources if s.frame in self.frames):
            turn = next((t for t in turns if s.frame not in t), None)
            if turn is None:
                turns.append(turn := {})
            turn[s.frame] = s
        columns = list(dict.fromkeys(c for s in sources for c in s.columns))
        rest = [F.col(c) for c in keep if c not in columns]

        def rows(turn: dict[str, Extract]) -> Column:
            here = [(F.col("frame") == f) & (F.expr(s.where) if s.where else F.lit(True)) for f, s in turn.items()]
            return reduce(lambda a, b: a | b, here)

        def value(turn: dict[str, Extract], column: str) -> Column:
            of = {f: s.columns[column] for f, s in turn.items() if column in s.columns}
            if len(set(of.values())) == 1 and len(of) == len(turn):
                return F.col(next(iter(of.values()))).alias(column)
            return F.coalesce(*[F.when(F.col("frame") == f, F.col(c)) for f, c in of.items()]).alias(column) if of else F.lit(None).alias(column)

        if len(turns) == 1:
            return self.df.where(rows(turns[0])).select(*[value(turns[0], c) for c in columns], *rest)
        each = F.array_compact(F.array(*[F.when(rows(t), F.struct(*[value(t, c) for c in columns])) for t in turns]))
        base = self.df.where(F.col("frame").isin(sorted({f for t in turns for f in t})))
        return base.select(F.explode(each).alias("_x"), *rest).select("_x.*", *rest)


def extracted(staged: dict[str, DataFrame] | Wide, sources: Sequence[Extract]) -> DataFrame:
    """The union of the extracts whose frames are there."""
    if isinstance(staged, Wide):
        return staged.extracted(sources)
    return union([s.of(staged) for s in sources if s.frame in staged])


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def event_order(ties: Sequence[str] = ("record_source",)) -> list[Column]:
    return [F.col("occurred_at").asc_nulls_last(), F.expr("try_cast(event_id as bigint)").asc_nulls_last(), F.col("event_id").asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The rank limit is applied before the shuffle, so a hot key sends one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def hub(rows: DataFrame, key: str, business_keys: Sequence[str]) -> DataFrame:
    """key, business keys, record_source, occurred_at of the first sighting; rows with a null business key are left out."""
    rows = not_null(rows, business_keys).withColumn(key, hash_key(business_keys))
    return keep_first(rows, [key], event_order([*business_keys, "record_source"])).select(key, *business_keys, "record_source", "occurred_at")


def link(rows: DataFrame, key: str, parents: dict[str, Sequence[str]]) -> DataFrame:
    """key and the parents' keys; `parents` maps a parent's key to its business-key columns, in hash order."""
    parts = [c for cols in parents.values() for c in cols]
    rows = not_null(rows, list(dict.fromkeys(parts))).withColumn(key, hash_key(parts))
    rows = rows.withColumns({k: hash_key(cols) for k, cols in parents.items()})
    return keep_first(rows, [key], event_order()).select(key, *parents, "record_source", "occurred_at")


def standard_satellite(rows: DataFrame, key: str, parent_keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Each state of a parent once, at its first sighting (A, B, A keeps the first A). States hash attributes by name order."""
    rows = not_null(rows, parent_keys).withColumn(key, hash_key(parent_keys)).withColumn("hash_diff", hash_diff(sorted(attributes)))
    return keep_first(rows, [key, "hash_diff"], event_order([*attributes, "record_source"])).select(key, *attributes, "hash_diff", "record_source", "occurred_at")


def multi_active_satellite(rows: DataFrame, key: str, parent_keys: Sequence[str], attributes: Sequence[str], subsequence: str = "event_id") -> DataFrame:
    """One row per parent and subsequence key. States hash attributes in the order given."""
    rows = not_null(rows, [*parent_keys, subsequence]).withColumn(key, hash_key(parent_keys)).withColumn("hash_diff", hash_diff(attributes))
    out = [key, subsequence, *[a for a in attributes if a != subsequence], "hash_diff", "record_source", "occurred_at"]
    return keep_first(rows, [key, subsequence], event_order([*attributes, "record_source"])).select(*out)


def effectivity_satellite(events: DataFrame, key: str, driving: tuple[str, Sequence[str]], other: tuple[str, Sequence[str]], opens: Column, compat: bool = False) -> DataFrame:
    """Intervals of a driving key: an opening event holds until the next event of that key; the last stays open.

    `driving` and `other` are (hash key, business keys). Events that are sent again count once, and timelines follow the hash
    key, so spellings of a key share one. With `compat`, repeated events are kept and timelines follow the raw key.
    """
    d_key, d_cols = driving
    o_key, o_cols = other
    events = not_null(events, [*d_cols, *o_cols]).withColumns({d_key: hash_key(d_cols), o_key: hash_key(o_cols), key: hash_key([*d_cols, *o_cols]), "_opens": opens})
    if not compat:
        events = keep_first(events, [d_key, "event_id"], event_order([o_key, "record_source"]))
    w = Window.partitionBy(*(d_cols if compat else [d_key])).orderBy(*event_order([o_key]))
    high = F.lit(HIGH_DTS).cast("timestamp_ntz" if dict(events.dtypes)["occurred_at"] == "timestamp_ntz" else "timestamp")
    events = events.withColumn("end_dts", F.coalesce(F.lead("occurred_at").over(w), high))
    return events.where("_opens").select(key, d_key, o_key, F.col("occurred_at").alias("start_dts"), "end_dts", "record_source")


def new_rows(candidates: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The candidates whose keys the target lacks, once each; nulls match nulls."""
    once = candidates.dropDuplicates(list(keys))
    if target is None:
        return once
    there = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    return once.join(there, same, "left_anti")
