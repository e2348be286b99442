"""Packing token sequences by a configuration linear program.

Texts are cut into pieces of at most `capacity` ids. Only the histogram of piece lengths, at most `capacity` counts,
reaches the driver. There the configuration program (as few bins as cover all counts, one variable per way to fill a bin)
is solved by multiplicative weights: the price of a length falls as it is covered, a knapsack dynamic program over the
capacity finds the filling worth most at these prices, and the filling is taken until its scarcest length is covered.
Every length ends up covered once; with few lengths the program is solved to its end with the same pricing.
The fractional solution is rounded down, then up by largest fraction, and what is left is solved and rounded again; the
little that no rounding takes is filled best-fit, largest length first. Plans have a bounded number of rows; the pieces
then take their places by their rank among those of their length, without meeting in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ranked, ship, written
from tessera.llm.tokens import default_path, encoder

CAPACITY = 2048
END_ID = 0
#: Lengths that are priced at once (the least covered, and the shortest for the gaps); fillings from one pricing, none
#: emptier than the best; learning rate.
PRICED, PER_ROUND, RATE = 1200, 100, 0.3
#: How often what rounding leaves is solved anew, at most.
SOLVES = 12
#: Lengths up to which the program is solved to its end, and pivots at most.
FEW, PIVOTS = 64, 1000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit).

    A document's ids are those of its text (null: empty) and id 0 at the end; only longer documents are cut. Repeated rows
    are packed as often as they occur.
    """
    path = path or default_path()
    step = 4 * capacity

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        encode, end = encoder(path), END_ID.to_bytes(4, "little")
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                for i, at in enumerate(range(0, len(ids), step)):
                    own = ids[at : at + step]
                    for col, v in zip(cols, (doc, i, at // 4, len(own) // 4, zlib.crc32(own), own if keep_ids else None), strict=True):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    ship(docs.sparkSession)
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)
    return out if keep_ids else out.drop("ids")


class Knapsack:
    """The most valuable fillings of every room up to `capacity` from `copies` of each length, by dynamic programming."""

    def __init__(self, lengths: np.ndarray, copies: np.ndarray, prices: np.ndarray, capacity: int):
        self.lengths, self.copies, self.capacity = lengths, copies, capacity
        self.parts: list[tuple[int, int]] = []  # (position, copies): copies in powers of two, so that any number can be made up
        for k, most in enumerate(np.minimum(copies, capacity // lengths).tolist()):
            n = 1
            while most > 0:
                self.parts.append((k, min(n, most)))
                most -= min(n, most)
                n *= 2
        value, taken = np.zeros(capacity + 1), np.zeros((len(self.parts), capacity + 1), bool)
        for i, (k, n) in enumerate(self.parts):
            size = int(lengths[k]) * n
            new = value[: capacity + 1 - size] + prices[k] * n
            better = new > value[size:]
            taken[i, size:] = better
            value[size:] = np.where(better, new, value[size:])
        self.taken = np.ascontiguousarray(taken.T)

    def filling(self, first: int | None = None) -> tuple[dict[int, int], int] | None:
        """(position -> copies, places left empty), around one of `first` if given; None if that would take a copy too many."""
        items: dict[int, int] = {}
        room, i = self.capacity, len(self.parts)
        if first is not None:
            items[first] = 1
            room -= int(self.lengths[first])
        while room > 0 and len(hit := np.flatnonzero(self.taken[room, :i])):
            i = int(hit[-1])
            k, n = self.parts[i]
            items[k] = items.get(k, 0) + n
            room -= int(self.lengths[k]) * n
        if first is not None and items[first] > self.copies[first]:
            return None
        return items, room


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], float]]:
    """Fillings with fractional multiplicities that cover every count exactly once, by multiplicative weights."""
    left = counts.astype(np.float64)
    found: dict[tuple, float] = {}
    while len(on := np.flatnonzero(left > 0)):
        covered = 1 - left[on] / counts[on]
        if len(on) > PRICED:
            few = np.union1d(np.lexsort((-lengths[on], covered))[: PRICED * 3 // 4], np.arange(PRICED // 4))
            on, covered = on[few], covered[few]
        copies = np.maximum(1, np.floor(left[on] + 1e-9)).astype(np.int64)
        knapsack = Knapsack(lengths[on], copies, lengths[on] * np.exp(-RATE * covered), capacity)
        urgent = np.lexsort((-lengths[on], covered))[: PER_ROUND - 1]
        least = None
        for first in [None, *map(int, urgent)]:
            if (made := knapsack.filling(first)) is None:
                continue
            items, room = made
            at, a = on[np.fromiter(items, np.int64)], np.fromiter(items.values(), np.float64)
            least = room if least is None else least
            if room > least or not left[at].all():  # too empty, or it needs what this round has covered
                continue
            step = float((left[at] / a).min())
            left[at] -= step * a
            left[at[left[at] < 1e-9 * counts[at]]] = 0
            key = tuple(sorted(zip(at.tolist(), items.values(), strict=True)))
            found[key] = found.get(key, 0.0) + step
    return [(dict(k), x) for k, x in found.items()]


def exact(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], float]]:
    """The fractional solution for few lengths: a simplex over the fillings, each priced in by the knapsack."""
    basis = np.diag((capacity // lengths).astype(np.float64))
    for _ in range(PIVOTS):
        prices = np.linalg.solve(basis.T, np.ones(len(lengths)))
        items, _ = Knapsack(lengths, counts, prices, capacity).filling()
        new = np.zeros(len(lengths))
        new[list(items)] = list(items.values())
        if prices @ new <= 1 + 1e-9:
            break
        x, change = np.linalg.solve(basis, counts), np.linalg.solve(basis, new)
        ratio = np.where(change > 1e-9, np.maximum(x, 0) / np.maximum(change, 1e-9), np.inf)
        basis[:, int(ratio.argmin())] = new
    x = np.linalg.solve(basis, counts)
    return [({int(k): int(round(column[k])) for k in np.flatnonzero(column > 0.5)}, max(0.0, float(n))) for column, n in zip(basis.T, x, strict=True)]


Plan = list[tuple[dict[int, int], int]]


def rounded(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[Plan, Plan]:
    """(fillings from rounding the program, fillings of the rest by best fit), each length -> copies, and how many bins.

    What rounding down leaves is rounded up by largest fraction where the pieces suffice and the filling is not much emptier
    than the solution's average; what that leaves is solved again.
    """
    left = counts.copy()
    made: Plan = []

    def take(items: dict[int, int], times: int, into: Plan) -> None:
        times = min([times, *(int(left[k]) // n for k, n in items.items())])
        if times > 0:
            for k, n in items.items():
                left[k] -= n * times
            into.append(({int(lengths[k]): n for k, n in items.items()}, times))

    for _ in range(SOLVES):
        on, before = np.flatnonzero(left), int((lengths * left).sum())
        if not before:
            break
        solution = exact(lengths[on], left[on], capacity) if len(on) <= FEW else fractional(lengths[on], left[on], capacity)
        plan = [({int(on[k]): n for k, n in items.items()}, x) for items, x in solution if x > 0]
        waste = lambda items: capacity - sum(int(lengths[k]) * n for k, n in items.items())
        allowed = 1 + 2 * sum(waste(items) * x for items, x in plan) / sum(x for _, x in plan)
        for items, x in sorted(plan, key=lambda p: (-p[1], waste(p[0]), sorted(p[0].items()))):
            take(items, int(x + 1e-6), made)
        for items, x in sorted(plan, key=lambda p: (-((p[1] + 1e-6) % 1), waste(p[0]), sorted(p[0].items()))):
            if waste(items) <= allowed:
                take(items, 1, made)
        if int((lengths * left).sum()) > 0.9 * before:
            break
    rest: Plan = []
    while len(there := np.flatnonzero(left)):  # best fit, largest first, in groups of equal bins
        items, room, pool = {}, capacity, left.copy()
        while True:
            fit = there[(pool[there] > 0) & (lengths[there] <= room)]
            if not len(fit):
                break
            k = int(fit[-1])
            n = min(int(pool[k]), room // int(lengths[k])) if items else 1
            items[k] = items.get(k, 0) + n
            pool[k] -= n
            room -= n * int(lengths[k])
        take(items, max(1, min(int(left[k]) // n for k, n in items.items())), rest)
    return made, rest


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Fillings (length -> copies) and how many bins are filled so; together they hold each length exactly as often as it occurs."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0), np.int64)
    counts = np.array([histogram[int(k)] for k in lengths], np.int64)
    made, rest = rounded(lengths, counts, capacity)
    return made + rest


def runs(plan: Plan) -> dict[int, list[np.ndarray]]:
    """length -> [first rank, first sequence, copies a sequence, offset of the first copy], each sorted by rank."""
    rank: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for items, times in plan:
        offset = 0
        for length, n in sorted(items.items(), reverse=True):
            rows.setdefault(length, []).append((rank.get(length, 0), sequence, n, offset))
            rank[length] = rank.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {k: list(np.array(v, np.int64).T) for k, v in rows.items()}


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of `docs` with sequence_id and offset.

    An empty table has none; null and empty texts are one piece of one id; a longer text is cut into as many pieces as it
    takes. Repeated rows and null doc_ids are packed as often as they occur. Other columns of `docs` are left out. Pieces are
    computed once and written to the shared folder.
    """
    cut = written(pieces(docs, path, capacity, keep_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    histogram.pop(capacity, None)  # a full piece is a sequence
    full = cut.where(F.col("length") == capacity)
    alone = full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return placed(cut.where(F.col("length") < capacity), solve(histogram, capacity)).unionByName(alone)


def placed(cut: DataFrame, plan: Plan) -> DataFrame:
    """The pieces with the places that the plan has for their lengths. Sequences are numbered from 0."""
    by_length = runs(plan)

    def seat(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                at = np.flatnonzero(length == k)
                first, start, copies, base = by_length[int(k)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                turn = rank[at] - first[run]
                sequence[at] = start[run] + turn // copies[run]
                offset[at] = base[run] + turn % copies[run] * k
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "_rank"]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(sequence), pa.array(offset)], names=[n for n, _ in kept] + ["sequence_id", "offset"])

    order = ranked(cut, "length", ["doc_id", "piece", "ids_crc32"], "_rank").withColumn("_rank", F.col("_rank").cast("long"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return order.mapInArrow(seat, f"{fields}, sequence_id long, offset long")
