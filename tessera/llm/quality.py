"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose statistic is above its threshold. How strict the thresholds may be is learnt from labelled
documents. One ladder leads from lenient to strict; a step sets the thresholds of all rules together. Within each stratum
(language), an exact binomial test on the labelled good documents shows for a step that all rules together wrongly reject at
most `ALPHA` of them. The ladder is climbed from its lenient end and left at the first step that fails (fixed-sequence
testing), so it costs one test at the whole level; over strata the level `DELTA` is divided evenly (Bonferroni). With
probability 1 - DELTA, no stratum loses more than ALPHA of its good documents. A stratum with too few labels to prove
anything (under about 220 at four strata) keeps its documents.

Everything is DataFrame functions; labels only enter as counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fresh, packed, quoted, words, written

#: The share of good documents that all rules together may reject, in each stratum.
ALPHA = 0.02
#: The chance that the bound fails in any stratum.
DELTA = 0.05
#: Words in a window that counts as repeated; a power of two.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
#: rule: (numerator, denominator, thresholds from lenient to strict)
RULES = {
    "symbols": ("n_symbols", "n_words", [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1]),
    "dup_lines": ("n_dup_lines", "n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2]),
    "repeats": ("n_repeat_words", "n_words", [0.28, 0.25, 0.2, 0.15, 0.1]),
    "word_length": ("word_chars", "n_words", [40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0]),
}
#: Labelled documents whose ids (8 bytes each) may be broadcast to pick their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Steps of the joint ladder; a rule with fewer thresholds stays longer on each.
STEPS = max(len(cutoffs) for _, _, cutoffs in RULES.values())
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def threshold(rule: str, step: int) -> float:
    cutoffs = RULES[rule][2]
    return float(cutoffs[step * len(cutoffs) // STEPS])


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long) of the whole text.

    A null or blank text has zeros everywhere. Repeated words are exact up to 64-bit hashes of windows; a document
    without an equal pair of windows, which a hash set shows, skips the sort. Columns of these names are replaced; any other
    names may occur. An empty table has no rows.
    """
    own = [c for c in docs.columns if c.lower() not in STATISTICS]
    t = F.coalesce(F.col("raw"), F.lit(""))
    out = docs.select(packed(docs, own), F.col(quoted(text)).alias("raw"))
    out = out.withColumns({"t": words(F.col("raw")), "lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long")})
    n = F.size("t")
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("t", "")).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "w": F.when(n >= WINDOW, F.transform("t", lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("t", "lines", "raw")
    reach = 1
    while reach < WINDOW:  # hashes of 2, 4, 8 words from those of 1, 2, 4
        out = out.withColumn("w", _joined(F.col("w"), reach))
        reach *= 2
    out = out.withColumn("w", F.slice("w", F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))))
    out = out.withColumn("d", F.size(F.array_distinct("w")) < F.size("w"))
    out = out.withColumn("n_repeat_words", F.when(F.col("d"), _covered(F.col("w"))).otherwise(F.lit(0)).cast("long"))
    return out.select("row.*", *STATISTICS)


def _joined(hashes: Column, reach: int) -> Column:
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + reach)))


def _covered(windows: Column) -> Column:
    """Words that lie in a window whose hash occurs at least twice."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    last = F.size(windows) - 1

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        hits = F.filter(s, lambda x, k: ((k > 0) & same(x, k - 1)) | ((k < last) & same(x, k + 1)))
        return F.array_sort(F.transform(hits, lambda x: x["i"]))

    at = F.flatten(F.transform(F.array(pairs), repeated))  # binds the sorted array once
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end"))
    return F.aggregate(at, start, step, lambda a: a["n"])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 10."""
    z = x + 10.0
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    for i in range(10):
        series = series - F.log(x + float(i))
    return series


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with chance p; 1 where k >= n p (only small tails matter to the test).

    Summed downwards from the term of k, all terms or the first J = 10 sqrt(n p) + 10. Term k - j is at most
    1 - (j - 1) / (n p) times the one above it, for k < n p; so what stands below the first J terms is less than
    exp(-J (J - 1) / (2 n p)) < exp(-50) of the largest term each, far below the precision of a double.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = F.exp(log_gamma(nd + 1) - log_gamma(kd + 1) - log_gamma(nd - kd + 1) + kd * math.log(p) + (nd - kd) * math.log(1 - p))
    ratio = lambda j: (kd - j + 1) * (1 - p) / ((nd - kd + j) * p)  # noqa: E731  term k - j over term k - j + 1
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(a: Column, j: Column) -> Column:
        term = a["term"] * ratio(j.cast("double"))
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    many = F.least(k.cast("long"), F.ceil(10 * F.sqrt(nd * p)) + 10).cast("int")
    tail = F.when(many > 0, F.aggregate(F.sequence(F.lit(1), many), zero, step, lambda a: a["sum"])).otherwise(F.lit(1.0))
    return F.when(kd >= nd * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * tail))


def statistic(rule: str) -> Column:
    num, den, _ = RULES[rule]
    return F.when(F.col(den) > 0, F.col(num).cast("double") / F.col(den).cast("double")).otherwise(F.lit(0.0))


def rejected(threshold_of: Callable[[str], Column | float]) -> Column:
    """Whether any rule's statistic is above its threshold."""
    bad = F.lit(False)
    for r in RULES:
        bad = bad | F.coalesce(statistic(r) > threshold_of(r), F.lit(False))
    return bad


def cutoffs(stats: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum: its value, `step` (the strictest proven, null where none is) and the rules' thresholds, `cut_<rule>` (then infinity).

    `stats` has the statistics and the stratum, `labels` doc_id and quality. The holdout is every labelled good document
    (quality 1) that the base rules keep. Rows without label, with a null label or a null doc_id count for nothing; a
    doc_id with several labels counts once, as good only if all say so. A null stratum is a stratum. No labels: no rows.
    """
    good = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_q")).where("_q = 1")
    held = stats.select(F.col(stratum).alias("stratum"), "doc_id", *STATISTICS).where(~base_failed()).join(good, F.col("doc_id") == F.col("_id"))
    wrong = [F.count_if(rejected(lambda r, i=i: threshold(r, i))).alias(f"wrong_{i}") for i in range(STEPS)]
    held = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *wrong)
    level = F.lit(delta) / F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))  # over one row per stratum
    ladder = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.col(f"wrong_{i}").alias("wrong")) for i in range(STEPS)]))
    tests = held.select("stratum", "n", level.alias("level"), ladder.alias("t")).select("stratum", "n", "level", "t.*")
    failed = F.when(binomial_cdf(F.col("wrong"), F.col("n"), alpha) > F.col("level"), F.col("step"))
    last = tests.groupBy("stratum").agg((F.coalesce(F.min(failed), F.lit(STEPS)) - 1).alias("step"))
    cut = {r: F.get(F.array(*[F.lit(threshold(r, i)) for i in range(STEPS)]), F.col("step")) for r in RULES}  # null before the first step
    return last.select("stratum", F.when(F.col("step") >= 0, F.col("step")).alias("step"), *[F.coalesce(c, F.lit(float("inf"))).alias(f"cut_{r}") for r, c in cut.items()])


def judge(stats: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds base_failed, the thresholds and kept; columns of these names are replaced.

    A stratum without thresholds is judged by the base rules alone.
    """
    names = [f"cut_{r}" for r in RULES]
    stats = stats.drop(*names, "base_failed", "kept")
    (key,) = fresh(stats.columns, "_stratum")
    out = stats.join(F.broadcast(cuts.select(F.col("stratum").alias(key), *names)), F.col(quoted(stratum)).eqNullSafe(F.col(key)), "left").drop(key)
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected(lambda r: F.col(f"cut_{r}")))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of `docs`: doc_id, the stratum, the statistics, the thresholds of its stratum, base_failed, kept.

    Texts are read once: their statistics are written to the shared folder and both the thresholds and the verdicts come from
    there. Null and empty texts fail the base rules; a text of any length is taken whole. Equal rows get equal verdicts.
    An empty table has no rows. Other columns of `docs` are left out.
    """
    stats = statistics(docs.select("doc_id", F.col(stratum), "text"), "text").drop("text")
    stats = written(stats, "quality")
    return judge(stats, cutoffs(stats, labels, stratum, alpha, delta), stratum)


def kept(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns and what `judge` adds.

    Rows are treated as by `quality_rules`. The thresholds come from the labelled documents, whose statistics are computed for
    that and written; then all documents are judged in one pass that writes and shuffles no text.
    """
    known = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("_known")).distinct()
    known = F.broadcast(known) if known.count() <= BROADCAST_IDS else known
    own = docs.select("doc_id", F.col(stratum), "text").join(known, F.col("doc_id") == F.col("_known"), "left_semi")
    cuts = written(cutoffs(written(statistics(own).drop("text"), "labelled"), labels, stratum, alpha, delta), "thresholds")
    # a value that is not deterministic keeps the verdict from being pushed below the statistics, to compute them again
    once = F.when(F.monotonically_increasing_id() >= 0, F.col("n_words")).alias("n_words")
    return judge(statistics(docs).withColumn("n_words", once), cuts, stratum).where("kept")
