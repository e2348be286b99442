"""A toxicity classifier that does not learn group names.

Logistic regression over the presence of words and word beginnings. Besides the labels it learns from counterfactuals: in
the labelled texts each identity term is swapped for every other one of its group, and the squared change of the score is
penalised, so that a neutral mention of a group does not raise the score. A labelled text without a term gets a mention of
one group, chosen by its hash, and that mention is swapped. Training takes a bounded sample on the driver; scoring streams
whole texts through numpy, with a model of a few thousand weights.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.byteshash import slices
from tessera.llm.common import first_by_hash, ship, written

#: Labelled documents that are learnt from, at most; those first by hash of doc_id.
SAMPLE = 8000
#: Weights of the model at most, besides those of the identity terms: the features that tell the labels apart best.
FEATURES = 4096
#: A feature must stand in so many labelled documents.
LEAST_DOCS = 3
#: Weights of the squared norm and of the squared change under swaps.
RIDGE, COUNTERFACTUAL = 2e-4, 1.0
#: A toxic document counts as so many clean ones, as it costs more to miss one: of 1, 2, 4, 6, 8, 12 and 20 the greatest for
#: which the folds of `by_folds`, which leave the held-out documents out, reject at most one clean document in 500.
TOXIC_WEIGHT = 6.0
STEPS = 400
LEARNT = "doc_id long, toxic int, own binary, lost array<binary>, gained array<binary>"
BITS = 22
#: Bytes of a word's beginning that are features, besides the whole word.
PREFIXES = (4, 5, 6, 8)
#: Terms that may be exchanged for each other, in English, French, German and Spanish. No term stands in two groups.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("femmes", "hommes", "filles", "garçons"),
    ("femme", "homme", "fille", "garçon"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("musulmane", "chrétienne", "juive", "hindoue"),
    ("homosexuel", "lesbienne", "bisexuel", "hétérosexuel", "transgenre"),
    ("noirs", "blancs", "asiatiques", "arabes"),
    ("immigrés", "réfugiés", "autochtones", "étrangers"),
    ("sourds", "aveugles", "handicapés", "âgés", "jeunes"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("frau", "mann"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("muslimische", "christliche", "jüdische", "hinduistische", "buddhistische", "atheistische"),
    ("schwule", "lesbische", "bisexuelle", "heterosexuelle", "transgeschlechtliche"),
    ("schwarze", "weiße", "asiatische", "arabische"),
    ("einwanderer", "flüchtlinge", "einheimische", "ausländer"),
    ("gehörlose", "blinde", "behinderte", "betagte"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("mujer", "hombre", "niña", "niño"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("homosexual", "lesbiana", "heterosexual", "transgénero"),
    ("negros", "blancos", "asiáticos", "latinos", "árabes"),
    ("inmigrantes", "refugiados", "nativos", "extranjeros"),
    ("sordos", "ciegos", "discapacitados", "ancianos", "jóvenes"),
)

_TRIM = np.zeros(256, bool)
_TRIM[[ord(c) for c in ".,;:!?\"'()[]{}*#$%&|<>-_"]] = True
_SALT = {k: np.uint64((0x9E3779B97F4A7C15 * (k + 1)) % 2**64) for k in (0, *PREFIXES)}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def features(words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) arrays, one pair per kind: the word without punctuation at its ends, and its beginnings."""
    start, end = words.start.copy(), words.end.copy()
    for _ in range(4):
        start += (start < end - 1) & _TRIM[words.low[start]]
        end -= (end > start + 1) & _TRIM[words.low[end - 1]]
    mask = np.uint64((1 << BITS) - 1)
    yield words.doc, (((words.hashes(start, end) ^ _SALT[0]) >> np.uint64(7)) & mask).astype(np.int64)
    for k in PREFIXES:
        long = np.flatnonzero(end - start >= k)
        s = start[long]
        yield words.doc[long], (((words.hashes(s, s + k) ^ _SALT[k]) >> np.uint64(7)) & mask).astype(np.int64)


def sets(column) -> list[np.ndarray]:
    """The distinct features of each text."""
    out: list[np.ndarray] = []
    for _, w in slices(column):
        found = list(features(w))
        pairs = np.unique(np.concatenate([d for d, _ in found]) << BITS | np.concatenate([f for _, f in found]))
        out += np.split(pairs & ((1 << BITS) - 1), np.searchsorted(pairs >> BITS, np.arange(1, w.n)))
    return out


_TERMS = {t: (g, i) for g, group in enumerate(IDENTITIES) for i, t in enumerate(group)}
_WORD = re.compile(r"\w+")


def _terms(text: str) -> set[str]:
    return {w.lower() for w in set(_WORD.findall(text))} & _TERMS.keys()


def swapped(text: str, turn: int = 1) -> str | None:
    """`text` with each identity term replaced by the one `turn` places further in its group; None where there is none."""

    def other(m: re.Match) -> str:
        g, i = _TERMS.get(m[0].lower(), (None, 0))
        return m[0] if g is None else IDENTITIES[g][(i + turn) % len(IDENTITIES[g])]

    return _WORD.sub(other, text) if _terms(text) else None


def variants(text: str) -> list[str]:
    """`text` with its identity terms moved through their whole groups: every place but their own, once."""
    turns = max((len(IDENTITIES[_TERMS[t][0]]) for t in _terms(text)), default=1)
    return [swapped(text, turn) for turn in range(1, turns)]


def swaps(column, texts: list[np.ndarray]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each text the (features lost, features gained) of its counterfactuals; `texts` are its own features."""
    import pyarrow as pa

    out = []
    for text, own in zip(column.to_pylist(), texts, strict=True):
        if changed := variants(text or ""):
            out.append([(np.setdiff1d(own, x), np.setdiff1d(x, own)) for x in sets(pa.array(changed, pa.string()))])
            continue
        first, *others = _mentions()[zlib.crc32((text or "").encode()) % len(IDENTITIES)]
        out.append([(np.setdiff1d(first, np.union1d(own, x)), np.setdiff1d(x, np.union1d(own, first))) for x in others])
    return out


@lru_cache(maxsize=1)
def _mentions() -> list[list[np.ndarray]]:
    """The features of the terms of each group."""
    import pyarrow as pa

    return [sets(pa.array(group, pa.string())) for group in IDENTITIES]


@dataclass
class Model:
    """Feature numbers, ascending, with their weights, and the bias. A text without known features gets the bias alone."""

    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -2.0

    def scores(self, column) -> np.ndarray:
        low = np.zeros(1 << 16, bool)  # a small sieve before the search
        low[self.known & 0xFFFF] = True
        out, size = np.full(len(column), self.bias), max(1, len(self.known))
        for at, w in slices(column):
            hits = []
            for doc, f in features(w):
                maybe = np.flatnonzero(low[f & 0xFFFF])
                f = f[maybe]
                k = np.searchsorted(self.known, f)
                on = np.flatnonzero(self.known[np.minimum(k, size - 1)] == f) if len(f) else maybe
                hits.append(doc[maybe[on]] * size + k[on])
            pairs = np.unique(np.concatenate(hits))
            if len(pairs):
                out[at : at + w.n] += np.bincount(pairs // size, self.weights[pairs % size], w.n)
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(known: np.ndarray, texts: list[np.ndarray], toxic: np.ndarray, changes: list[tuple[np.ndarray, np.ndarray]] = (), weight: float | None = None) -> Model:
    """From the features to weigh, the places in them that each text has, labels 0/1, and the places (lost, gained) by each swap.

    A toxic text counts `weight` times (TOXIC_WEIGHT).
    """
    n, pos = len(texts), int(toxic.sum())
    weight = TOXIC_WEIGHT if weight is None else weight
    if not n or not pos or pos == n:
        return Model(bias=2.0 if n and pos else -2.0)

    def rows(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate([np.zeros(0, np.int64), *sets])

    d, k = rows(texts)
    changes = [c for c in changes if len(c[0]) or len(c[1])]  # the others cannot change a score
    m = len(changes)
    d0, k0 = rows([lost for lost, _ in changes])
    d1, k1 = rows([gained for _, gained in changes])
    weigh = np.where(toxic > 0, weight, 1.0)
    weigh /= weigh.mean()
    w, b = np.zeros(len(known)), float(np.log(weight * pos / (n - pos)))
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, STEPS + 1):
        error = 1 / (1 + np.exp(-np.clip(np.bincount(d, w[k], n) + b, -40, 40))) - toxic
        error *= weigh
        g = np.bincount(k, error[d], len(w)) / n + RIDGE * w
        if m:
            change = np.bincount(d1, w[k1], m) - np.bincount(d0, w[k0], m)
            g += 2 * COUNTERFACTUAL / m * (np.bincount(k1, change[d1], len(w)) - np.bincount(k0, change[d0], len(w)))
        g = np.append(g, error.mean())
        first = 0.9 * first + 0.1 * g  # Adam
        second = 0.999 * second + 0.001 * g * g
        step = 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1]
        b -= float(step[-1])
    return Model(known, w, b)


def _of(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(bytes(raw), "<u4").astype(np.int64)


def telling(sample: DataFrame) -> np.ndarray:
    """The features of the sample (toxic, own) whose presence tells the labels apart best, by chi squared; the driver gets these alone."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            toxic = b.column(0).to_numpy()
            sets_ = [_of(x) for x in b.column(1).to_pylist()]
            if not sets_:
                continue
            found, place = np.unique(np.concatenate(sets_), return_inverse=True)
            label = np.repeat(toxic, [len(x) for x in sets_])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.bincount(place, minlength=len(found))), pa.array(np.bincount(place, label, len(found)).astype(np.int64))],
                names=["feature", "n", "pos"],
            )

    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos")).first()
    if not total["n"] or not total["pos"] or total["pos"] == total["n"]:
        return np.zeros(0, np.int64)
    share = total["pos"] / total["n"]
    rows = sample.select("toxic", "own").mapInArrow(count, "feature long, n long, pos long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    chi = F.pow(F.col("pos") - F.col("n") * share, F.lit(2.0)) / (F.col("n") * (share * (1 - share)) * (1 - F.col("n") / (total["n"] + 1)))
    rows = rows.where(F.col("n") >= LEAST_DOCS).select("feature", chi.alias("chi")).where("chi > 6.6")  # a chance of one in a hundred
    return np.sort(np.array([r["feature"] for r in rows.orderBy(F.col("chi").desc(), "feature").limit(FEATURES).collect()], np.int64))


def learnt_from(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic, own, lost, gained: the features of at most `sample` labelled documents, and of their counterfactuals.

    Labels with doc_id and toxic not null and not held out; several labels of a doc_id: toxic if one says so. Of several
    rows of a doc_id the text first by hash stands for all. Written to the shared folder.
    """
    ship(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    known = first_by_hash(known, "_id", sample)
    some = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).withColumn("text", F.coalesce("text", F.lit("")))
    some = some.groupBy("doc_id").agg(F.max("_toxic").cast("int").alias("toxic"), F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    some = some.select("doc_id", "toxic", "first.text").repartition(16)

    def featured(batches: Iterator) -> Iterator:
        import pyarrow as pa

        packed = lambda x: x.astype("<u4").tobytes()
        for b in batches:
            text = b.column(2)
            own = sets(text)
            changed = swaps(text, own)
            sides = [pa.array([[packed(c[side]) for c in cs] for cs in changed], pa.list_(pa.binary())) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(packed, own), pa.binary()), *sides], names=["doc_id", "toxic", "own", "lost", "gained"])

    return written(some.mapInArrow(featured, LEARNT), "toxicity-sample")


def examples(learnt: DataFrame) -> tuple[np.ndarray, list, list[np.ndarray], np.ndarray, list[list[tuple[np.ndarray, np.ndarray]]]]:
    """The features to weigh, and for each learnt document its id, its places in them, its label and its counterfactuals' places.

    Besides the telling features, those of all identity terms are weighed: a swap changes a score even where the labels
    hardly know the term.
    """
    found = telling(learnt)
    if len(found):
        found = np.unique(np.concatenate([found, *[x for group in _mentions() for x in group]]))

    def reduced(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def known_of(raw: bytes) -> bytes:
            x = _of(raw)
            k = np.searchsorted(found, x)
            return k[k < len(found)][found[k[k < len(found)]] == x[k < len(found)]].astype("<u4").tobytes()

        for b in batches:
            own = pa.array([known_of(x) for x in b.column(2).to_pylist()], pa.binary())
            sides = [pa.array([[known_of(x) for x in xs] for xs in b.column(i).to_pylist()], pa.list_(pa.binary())) for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), own, *sides], names=b.schema.names)

    rows = learnt.mapInArrow(reduced, LEARNT).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], bytes(r["own"])))
    changes = [[(_of(a), _of(b)) for a, b in zip(r["lost"], r["gained"], strict=True) if a or b] for r in rows]
    return found, [r["doc_id"] for r in rows], [_of(r["own"]) for r in rows], np.array([r["toxic"] for r in rows], float), changes


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from what `learnt_from` takes; without both labels the model is its bias."""
    known, _, texts, toxic, changes = examples(learnt_from(docs, labels, sample))
    return fit(known, texts, toxic, [c for own in changes for c in own])


def by_folds(docs: DataFrame, labels: DataFrame, weights: tuple[float, ...], sample: int = SAMPLE) -> dict[float, tuple[int, int]]:
    """weight of a toxic text -> (toxic missed, clean rejected), each fold of crc32(doc_id) mod 5 in 1 to 4 judged by the others.

    How TOXIC_WEIGHT was chosen; held-out documents (remainder 0) have no part in it.
    """
    known, ids, texts, toxic, changes = examples(learnt_from(docs, labels, sample))
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i in ids])
    out = {}
    for weight in weights:
        missed = rejected = 0
        for f in range(1, 5):
            on, off = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            model = fit(known, [texts[i] for i in on], toxic[on], [c for i in on for c in changes[i]], weight)
            said = np.array([model.bias + model.weights[texts[i]].sum() >= 0 for i in off])
            missed += int((~said & (toxic[off] > 0)).sum())
            rejected += int((said & (toxic[off] == 0)).sum())
        out[weight] = missed, rejected
    return out


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 where it is 0.5 or more); columns of these names are replaced.

    One row per row; equal texts get equal scores, and a null is an empty text.
    """
    ship(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    at = docs.columns.index(text)
    kind = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            s = model.scores(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=kind.names)

    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(run, kind)  # names go in by position, for they may hold anything


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All of `docs` with score, predicted and held_out (its label, if any, was not learnt from); columns of these names are replaced.

    Null, empty and blank texts have no features and get the bias's score; a text of any length is scored whole. Repeated rows
    are scored alike. A null doc_id is held out or not like another, and never learnt from. An empty table has no rows; labels
    that are missing, or all alike, give every document one score.
    """
    return score(docs, train(docs, labels, sample)).withColumn("held_out", held_out(F.col("doc_id")))
