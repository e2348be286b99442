"""Near-duplicate documents by an exact Jaccard join over word n-grams.

Documents with equal sets are one class. Each class lists its n-grams rarest first; classes can only be similar if their
prefixes, the first tenth at a threshold of 0.9 (a fifth at 0.8), share an n-gram, and if the lengths, the positions of that
n-gram and the make-up of the rest (suffix filter) leave room for enough common ones. The suffix filter compares a parity
bit for each of `BITS` parts of the n-gram space: two sets differ in at least as many n-grams as there are parts of unequal
parity. All filters are applied where classes meet, before a pair is made; what passes is verified once per pair on whole
sets.

No group of an n-gram is paired with itself. A first round links each class with one pivot, the smallest class that the
filters let it meet. The links are closed to components, and the second round only pairs classes of an n-gram that are
in different components and were not verified before. So a family of copies costs links in proportion to its size, and no
link between components can be missed.

Frequencies come from a table of counters of fixed size over all documents. Any order is correct; the counters make it
rare-first. "Exact" holds up to equal 64-bit hashes of different n-grams, and equal pairs of such sums over sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.byteshash import mixed, slices
from tessera.llm.common import discard, fresh, ship, written
from tessera.llm.components import components

#: Words of an n-gram, and the part of the union from which sets are similar, of `op4_ngram_join`; callers may give their own.
N = 3
PERCENT = 90
#: Counters of n-grams: 2 to this power, in chunks of 2 to the second.
COUNTERS, CHUNK = 22, 16
#: Parts of the n-gram space whose parities the suffix filter compares, and the columns of 64 that hold them.
BITS = 256
PARITY = [f"q{i}" for i in range(BITS // 64)]
#: Classes whose ids (8 bytes each) may be broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_ODD = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25)]


def sets(column, n: int = N) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row, n-gram hash) for runs of rows: the distinct n-grams of each text, sorted by row and hash.

    Words are lower-cased A-Z; a text with fewer than n words has its whole sequence as one n-gram; no words, none.
    """
    for at, w in slices(column):
        h, many = w.hashes(), np.bincount(w.doc, minlength=w.n)
        first = np.concatenate([[0], np.cumsum(many)])[:-1]
        if len(h) >= n:
            gram = np.zeros(len(h) - n + 1, np.uint64)
            for k in range(n):
                gram += h[k : len(h) - n + 1 + k] * _ODD[k]
            inside = w.doc[: len(gram)] == w.doc[n - 1 :]
            gram, doc = mixed(gram[inside]), w.doc[: len(inside)][inside]
        else:
            gram, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((many > 0) & (many < n))
        if len(short):
            whole = np.full(len(short), 77, np.uint64) * many[short].astype(np.uint64)
            for k in range(n - 1):
                on = many[short] > k
                whole[on] += h[first[short[on]] + k] * _ODD[k]
            gram, doc = np.concatenate([gram, mixed(whole)]), np.concatenate([doc, short])
        order = np.lexsort((gram, doc))
        gram, doc = gram[order], doc[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
        yield at, w.n, doc[new], gram[new]


def _counter(gram: np.ndarray) -> np.ndarray:
    return (gram >> np.uint64(64 - COUNTERS)).astype(np.int64)


def rarity(docs: DataFrame, n: int = N) -> np.ndarray:
    """A level for every counter, growing with the logarithm of the n-grams that fall to it in all documents.

    Tasks count into tables of their own; chunks of the tables are summed in two steps, streaming. What reaches the driver
    has a fixed size whatever the corpus.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = np.zeros(1 << COUNTERS, np.uint32)
        for b in batches:
            for _, _, _, gram in sets(b.column(0), n):
                np.add.at(table, _counter(gram), 1)
        if table.any():
            yield from _chunks(pa, {i: table[i << CHUNK : (i + 1) << CHUNK] for i in range(1 << (COUNTERS - CHUNK))})

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        sums: dict[int, np.ndarray] = {}
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(unzip.decompress(raw), "<u8")
        yield from _chunks(pa, sums)

    schema = "chunk int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    salted = parts.withColumn("_salt", F.spark_partition_id() % 16)
    once = salted.repartition("chunk", "_salt").select("chunk", "counts").mapInArrow(add, schema)
    table = np.zeros(1 << COUNTERS, np.float64)
    import zstandard

    for r in once.repartition("chunk").mapInArrow(add, schema).collect():
        table[r["chunk"] << CHUNK : (r["chunk"] + 1) << CHUNK] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["counts"])), "<u8")
    return np.minimum(255, 4 * np.log2(1 + table)).astype(np.uint8)


def _chunks(pa, tables: dict[int, np.ndarray]) -> Iterator:
    import zstandard

    zip_ = zstandard.ZstdCompressor(level=1)
    for i, t in tables.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zip_.compress(t.astype("<u8").tobytes())], pa.binary())], names=["chunk", "counts"])


def profiles(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT, words: int = N) -> DataFrame:
    """doc_id, n, s1, s2 (sums over the set that tell sets apart), parities by part, prefix (rarest n-grams first)."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 4 MB, whatever the corpus

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        level = shared.value
        for b in batches:
            for at, rows, doc, gram in sets(b.column(1), words):
                n = np.bincount(doc, minlength=rows)
                ends = np.cumsum(n)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (gram, mixed(gram ^ _ODD[0]))]
                s1, s2 = (mixed(x[ends] - x[ends - n]).view(np.int64) for x in sums)
                odd = (np.bincount(doc * BITS + (gram & np.uint64(BITS - 1)).astype(np.int64), minlength=rows * BITS) & 1).astype(bool)
                parity = np.packbits(odd.reshape(rows, BITS), axis=1, bitorder="little").view("<i8")
                order = np.lexsort((gram, level[_counter(gram)], doc))
                take = np.where(n > 0, n - -(-n * percent // 100) + 1, 0)
                place = np.arange(len(gram)) - np.repeat(ends - n, n)
                prefix = gram[order][place < np.repeat(take, n)].view(np.int64)
                lists = lambda values, size: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, rows), pa.array(n, pa.int64()), pa.array(s1), pa.array(s2), *[pa.array(np.ascontiguousarray(q)) for q in parity.T], lists(prefix, take)],
                    names=["doc_id", "n", "s1", "s2", *PARITY, "prefix"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, n long, s1 long, s2 long, {', '.join(f'{q} long' for q in PARITY)}, prefix array<long>")


def needed(na: Column, nb: Column, percent: int) -> Column:
    """The least common n-grams of two similar sets of these sizes."""
    return F.ceil((na + nb) * percent / F.lit(100 + percent) - 1e-9)


def _possible(percent: int, a: str, b: str) -> Column:
    """Length, positional and suffix filter; for the first common n-gram of a similar pair they always hold."""
    na, nb, pa_, pb = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}pos"), F.col(f"{b}pos")
    least = needed(na, nb, percent)
    unequal = sum((F.bit_count(F.col(f"{a}{q}").bitwiseXOR(F.col(f"{b}{q}"))) for q in PARITY), F.lit(0))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (F.least(na - pa_, nb - pb) >= least) & (unequal <= na + nb - 2 * least)


def verified(pairs: DataFrame, docs: DataFrame, percent: int, n: int = N, scratch: list[str] | None = None) -> DataFrame:
    """The pairs (a, b) of classes, written, that are similar by their whole sets.

    Sets are made again from the texts of classes that are in a pair, once each. Pairs of one class that has very many are
    dealt to tasks by Spark's skew join; its set goes to each of them.
    """
    nodes = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "candidate-ids", scratch)
    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)

    def as_bytes(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for at, rows, doc, gram in sets(b.column(1), n):
                own = [x.tobytes() for x in np.split(gram, np.searchsorted(doc, np.arange(1, rows)))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, rows), pa.array(own, pa.binary())], names=["node", "grams"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(nodes, "node")
    grams = written(texts.mapInArrow(as_bytes, "node long, grams binary"), "candidate-sets", scratch)
    both = pairs.join(grams.toDF("a", "ag"), "a").join(grams.toDF("b", "bg"), "b")

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                common = len(x) + len(y) - len(np.union1d(x, y))
                if common and 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return both.select("a", "b", "ag", "bg").mapInArrow(check, "a long, b long").distinct()


def join(docs: DataFrame, percent: int = PERCENT, n: int = N, scratch: list[str] | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, class_id, component_id.

    class_id is the smallest doc_id with the same set, component_id the smallest one reachable by links. Documents without
    words (null, empty, blank) are linked with nothing. Rows of one doc_id are one document to the links. Rows without a
    doc_id take the ids of their class, null where all its rows lack one. Whole texts of any length are compared; an empty
    table has no rows; other columns are left out. Folders that the result reads are added to `scratch`, all others deleted.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    scratch, done = [] if scratch is None else scratch, []
    own = written(profiles(docs, rarity(docs, n), percent, n), "profiles", scratch)
    kinds = own.where("n > 0 and doc_id is not null").groupBy("s1", "s2", "n")
    classes = written(kinds.agg(F.min("doc_id").alias("node"), *[F.first(q).alias(q) for q in PARITY], F.first("prefix").alias("prefix")), "classes", scratch)
    rows = classes.select("node", "n", F.posexplode("prefix").alias("pos", "gram"))
    groups = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("many"), F.min(F.struct("node", "n", "pos")).alias("pivot")).where("many > 1")
    groups = groups.select(F.col("gram").alias("g"), F.col("pivot.node").alias("p_node"), F.col("pivot.n").alias("p_n"), F.col("pivot.pos").alias("p_pos"))
    rows = rows.join(groups, F.col("gram") == F.col("g")).drop("g")  # n-grams of one class alone are gone
    parities = classes.select(F.col("node").alias("k"), *PARITY)
    rows = written(rows.join(parities, F.col("node") == F.col("k")).drop("k"), "prefix-rows", done)

    near = rows.where("node > p_node").join(parities.select(F.col("k"), *[F.col(q).alias(f"p_{q}") for q in PARITY]), F.col("p_node") == F.col("k")).where(_possible(percent, "", "p_"))
    tried = written(near.groupBy(F.col("node").alias("b")).agg(F.min("p_node").alias("a")).select("a", "b"), "pairs", done)
    once_used: list[str] = []
    first = written(verified(tried, docs, percent, n, once_used), "links", done)
    discard(spark, once_used)
    known = components(first, done).withColumnRenamed("node", "k")

    rows = rows.select("gram", "node", "n", "pos", "p_node", *PARITY).join(known, F.col("node") == F.col("k"), "left").withColumn("of", F.coalesce("component", "node")).drop("k", "component")
    mixed_ = rows.groupBy("gram").agg(F.min("of").alias("lo"), F.max("of").alias("hi"), F.max(F.when(F.col("node") == F.col("p_node"), F.col("of"))).alias("main")).where("lo <> hi")
    rows = written(rows.join(mixed_.select(F.col("gram").alias("g"), "main"), F.col("gram") == F.col("g")).drop("g", "p_node"), "open-rows", done)
    side = lambda s: [F.col(c).alias(f"{s}_{c}") for c in ("node", "n", "pos", "of", *PARITY)]
    left = rows.where("of <> main").select("gram", *side("l"))
    right = rows.select("gram", "main", *side("r"))
    # two classes outside the pivot's component meet twice: the smaller one goes left
    once = (F.col("r_of") == F.col("main")) | (F.col("l_node") < F.col("r_node"))
    met = left.join(right, (left["gram"] == right["gram"]) & (F.col("l_of") != F.col("r_of")) & once & _possible(percent, "l_", "r_"))
    met = met.select(F.least("l_node", "r_node").alias("a"), F.greatest("l_node", "r_node").alias("b")).distinct()
    met = met.join(tried, ["a", "b"], "left_anti")  # verified in the first round, and found not to be similar
    second = written(verified(written(met, "pairs", done), docs, percent, n, once_used), "links", done)
    final = components(first.union(second), scratch)
    discard(spark, [*done, *once_used])
    final = final.withColumnRenamed("node", "k")

    named = classes.join(final, F.col("node") == F.col("k"), "left").select("s1", "s2", F.col("n").alias("cn"), F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component_id"))
    out = own.select("doc_id", "n", "s1", "s2").join(
        named.withColumnsRenamed({"s1": "c1", "s2": "c2"}),
        (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") == F.col("cn")),
        "left",
    )
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))


def brute_force(texts: dict[int, str | None], percent: int = PERCENT, n: int = N) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id), by comparing all pairs; for small fixtures."""
    import re

    grams = {}
    for d, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        grams[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = {d: d for d in grams}

    def root(d: int) -> int:
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(grams)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(grams[a] & grams[b])
            if common and 100 * common >= percent * (len(grams[a]) + len(grams[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(grams[d]), root(d)) for d in grams}


def first_of_each(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """The rows of docs, with all columns, whose doc_id is the smallest of its component; equal ones once.

    Rows without doc_id cannot be told apart by it: if one of them has no class mate with an id, they all stay, once for each
    text. Null, empty and blank texts are components of their own. An empty table has no rows. Names of other columns do not
    matter.
    """
    (key,) = fresh(docs.columns, "_id")
    scratch: list[str] = []
    ids = written(join(docs, percent, n, scratch).where("doc_id <=> component_id").select(F.col("doc_id").alias(key)).distinct(), "kept-ids")
    discard(docs.sparkSession, scratch)
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(key)), "left_semi").dropDuplicates(["doc_id", "text"])
