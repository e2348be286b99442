"""Mixing sources to target weights by Pareto order sampling.

Sources are given weights and a share of all words; a source gets at most `CAP` times its own words, and what it cannot
take is shared anew among the others. Each document first gets the certain whole copies that its source's ratio
(target / own words) holds. The rest is drawn: a document's inclusion chance pi is one factor per source times a power of
its size, at most 1, and the factor is solved so that the expected words are those owed. Documents whose chance is 1 are
taken; the others have a random number u and are ranked by the odds of u divided by the odds of pi (Pareto order sampling).
The sample is of a fixed size in words: the head of the ranking that comes nearest to the words still owed.

Only DataFrame functions. A source, however hot, is spread over `BINS` ranges of the rank; only one range is sorted together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import n_words, packed, unit, written

#: A document is used at most so often, and a source's target is at most so many times its words.
CAP = 3
#: The chance of a document falls with this power of its size, so that a few very long ones do not make up a small sample.
TILT = 0.25
BINS = 4096
#: Sources whose targets (some 100 bytes each) may be broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000
SEED = "mix"


def by_position(period: int = 3) -> Callable[[Column], Column]:
    """Weights 1, 2, ... `period`, repeating, by the position (from 0) of the source by code point, null last."""
    return lambda position: (position % period + 1).cast("double")


def targets(sizes: DataFrame, weight: Callable[[Column], Column] = by_position(), cap: int = CAP, share: float = 1.0) -> DataFrame:
    """From rows (source, size): source, source_size, weight, target, by filling up to the caps.

    The windows run over one row per source. Sources in order of the level at which they are full; the level at which the
    first of them is not full holds for it and all later ones. An empty input has no rows; a source without words gets 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(1))
    per = per.withColumn("weight", weight(F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1))
    full = (cap * F.col("source_size")).cast("double")
    line = every.orderBy("_full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_full", full).withColumn("_full_at", full / F.col("weight"))
    left = F.sum("source_size").over(every).cast("double") * share - F.coalesce(F.sum("_full").over(line), F.lit(0.0))
    per = per.withColumn("_level", left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(line), F.lit(0.0))))
    per = per.withColumn(
        "_level",
        F.min_by(F.when(F.col("_level") * F.col("weight") <= F.col("_full"), F.col("_level")), F.when(F.col("_level") * F.col("weight") <= F.col("_full"), F.col("_full_at"))).over(every),
    )
    target = F.least(F.coalesce(F.col("_level") * F.col("weight"), F.col("_full")), F.col("_full"))
    return per.select("source", "source_size", "weight", target.alias("target"))


def factors(sizes: DataFrame, owed: DataFrame, tilt: float = TILT) -> DataFrame:
    """source, factor: the number c with sum(min(1, c * size^-tilt) * size) = owed over the documents of each source.

    From rows (source, size) and (source, owed), owed below the source's words. Works on a row per source and size: small
    documents reach 1 first, so c is that of the smallest size at which the larger ones are not certain. Sources that are
    owed nothing, or have no words, are left out.
    """
    steps = sizes.where("size > 0").groupBy(F.col("source").alias("_s"), "size").agg(F.count(F.lit(1)).alias("many"))
    steps = steps.join(owed.where("owed > 0"), F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    line = Window.partitionBy("source").orderBy("size")
    certain = F.coalesce(F.sum(F.col("many") * F.col("size")).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weighed = F.sum(F.col("many") * F.pow(F.col("size").cast("double"), F.lit(1.0 - tilt))).over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    steps = steps.withColumn("factor", (F.col("owed") - certain) / weighed)
    open_ = F.col("factor") <= F.pow(F.col("size").cast("double"), F.lit(float(tilt)))
    return steps.where(open_).groupBy("source").agg(F.min_by("factor", "size").alias("factor"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """row (all of `docs`), doc_id, source, size (words of the text, 0 for null) and u, the document's random number.

    u follows from the seed and doc_id alone; where that is null, from the text.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.col("doc_id").cast("string")).otherwise(F.concat(F.lit("null/"), F.md5(F.coalesce("text", F.lit("")))))
    return docs.select(packed(docs), "doc_id", "source", n_words(F.col("text")).alias("size"), unit(F.lit(seed), key).alias("u"))


def drawn(rows: DataFrame, weight: Callable[[Column], Column] = by_position(), cap: int = CAP, share: float = 1.0, tilt: float = TILT) -> DataFrame:
    """Rows of `sized` (written, for they are read several times) with source_size, target, pi (chance of the drawn copy) and copies."""
    per = targets(rows.select("source", "size"), weight, cap, share)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per = per.select("source", "source_size", "target", F.floor(ratio).alias("whole"))
    per = per.withColumn("owed", F.col("target") - F.col("whole") * F.col("source_size"))
    per = per.join(factors(rows, per.select("source", "owed"), tilt).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    per = per.withColumnRenamed("source", "s").withColumn("rest", F.when(F.col("source_size") > 0, F.col("owed") / F.col("source_size")).otherwise(F.lit(0.0)))
    per = written(per, "targets")
    per = F.broadcast(per) if per.count() <= BROADCAST_SOURCES else per
    odds = lambda p: p / (1 - p)
    docs = rows.join(per, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    pi = F.least(F.col("factor") * F.pow(F.greatest(F.col("size"), F.lit(1)).cast("double"), F.lit(-float(tilt))), F.lit(1.0))
    docs = docs.withColumn("pi", F.coalesce(pi, F.lit(0.0)))
    # null where nothing is drawn: the source is owed nothing more, or the document is certain. Certain ones come first
    docs = docs.withColumn("rank", F.when((F.col("pi") > 0) & (F.col("pi") < 1), odds(F.col("u")) / odds(F.col("pi"))))
    spread = F.col("rank") * odds(F.col("rest"))
    docs = docs.withColumn("bin", F.coalesce(F.floor(spread / (1 + spread) * BINS), F.floor(F.col("u") * BINS) - BINS))
    docs = docs.withColumns({"k": F.coalesce("source", F.lit("")), "kn": F.col("source").isNull()})
    sums = docs.groupBy(F.col("k").alias("s"), F.col("kn").alias("sn"), F.col("bin").alias("b")).agg(F.sum("size").alias("words"))
    run = Window.partitionBy("s", "sn").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "sn", "b", F.coalesce(F.sum("words").over(run), F.lit(0)).alias("before"))
    docs = docs.join(sums, (F.col("k") == F.col("s")) & (F.col("kn") == F.col("sn")) & (F.col("bin") == F.col("b"))).drop("s", "sn", "b")
    within = Window.partitionBy("k", "kn", "bin").orderBy("rank", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    taken_ = (F.col("pi") >= 1) | (F.col("rank").isNotNull() & (before + F.col("size") / 2.0 <= F.col("owed")))
    return docs.withColumn("copies", F.least(F.col("whole") + taken_.cast("long"), F.lit(cap)).cast("long"))


ADDED = ("size", "source_size", "target", "copies")


def mix(docs: DataFrame, weight: Callable[[Column], Column] = by_position(), cap: int = CAP, share: float = 1.0, tilt: float = TILT, seed: str = SEED) -> DataFrame:
    """`docs` (doc_id, text, source and any others) with size, source_size, target and copies; taken = copies * size.

    size: words of the whole text, 0 for null or empty. Draws follow from doc_id and the seed alone, so reruns agree; rows
    with equal doc_id share a draw, but each counts its own words, and a null doc_id draws by its text. A null source is a
    source. An empty table gives none. Columns of docs that have one of the added names are replaced; other names do not
    matter. A source's taken words miss its target by half of one document at most. Words are counted once, and written.
    """
    docs = docs.drop(*ADDED)
    return drawn(written(sized(docs, seed), "sized"), weight, cap, share, tilt).select("row.*", *ADDED)


def taken(mixed: DataFrame) -> DataFrame:
    """One row per document and copy that the mix takes; documents without a copy are gone."""
    return mixed.where("copies > 0").select(packed(mixed), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
