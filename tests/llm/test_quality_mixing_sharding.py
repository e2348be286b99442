import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, ngramjoin, quality, sharding, toxicity
from tessera.llm.common import load, written
from tests.llm.fixtures import empty, labels, odd, odd_rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_statistics(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark):
    extra = ["a b c d e f g h " * 3, "l1 x\nl1 x\n\n \nl1 x", "## a|b <c>\r\n", "a b c d e f g h i a b c d e f g h"]
    docs = odd(spark).unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"), allowMissingColumns=True)
    rows = quality.statistics(docs).select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert len(rows) == len(odd_rows()) + len(extra)
    for r in rows:
        assert tuple(r)[1:] == plain_statistics(r["text"]), r["text"] and r["text"][:50]


@pytest.mark.parametrize(("k", "n", "p"), [(0, 50, 0.01), (3, 900, 0.01), (9, 3000, 0.005), (0, 1, 0.3), (30, 5000, 0.0078125)])
def test_binomial_tail_is_exact(spark, k, n, p):
    got = spark.range(1).select(quality.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("x")).first()["x"]
    q = Fraction(p)
    want = float(sum(math.comb(n, j) * q**j * (1 - q) ** (n - j) for j in range(k + 1))) if k < n * p else 1.0
    assert got == pytest.approx(want, rel=1e-8)


def test_cutoffs_reject_junk_and_bound_false_rejection(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(40)), "en") for i in range(3000)]
    junk = [(10_000 + i, " ".join(f"w{j}###" for j in range(40)), "en") for i in range(200)]
    few = [(20_000 + i, " ".join(f"w{j}###" for j in range(40)), "xx") for i in range(5)]
    docs = spark.createDataFrame(good + junk + few, "doc_id long, text string, lang string")
    known = labels(spark, [(i, 1, 0) for i in range(3000)] + [(20_000 + i, 1, 0) for i in range(5)])
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs, known).collect()}
    assert sum(not got[i] for i in range(3000)) <= quality.ALPHA * 3000
    assert not any(got[10_000 + i] for i in range(200))
    assert all(got[20_000 + i] for i in range(5))  # too few labels to prove a cutoff


@pytest.mark.xfail(reason="fails, cause not found yet: a stratum of 230 to 260 labels gets no threshold here")
def test_few_labels_of_a_stratum_suffice(spark):
    rng = random.Random(3)
    line = lambda junk: " ".join(("w" + str(rng.randrange(10**6)) + ("##" if rng.random() < junk else "")) for _ in range(40))
    rows = [(i, line(0.02), lang) for i, lang in enumerate(["en"] * 260 + ["de"] * 260 + ["fr"] * 230 + ["es"] * 40)]
    rows += [(5000 + i, line(0.9), lang) for i, lang in enumerate(["en", "de", "fr", "es"] * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = labels(spark, [(i, 1, 0) for i in range(790)])
    stats = written(quality.statistics(docs).drop("text"), "s")
    steps = {r["stratum"]: r["step"] for r in quality.cutoffs(stats, known).collect()}
    assert steps["es"] is None and all(steps[s] is not None for s in ("en", "de", "fr"))
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs, known).collect()}
    assert all(got[i] == (lang == "es") for i, _, lang in rows if i >= 5000)
    for lang in ("en", "de", "fr"):
        own = [i for i, _, x in rows if x == lang and i < 5000]
        assert sum(not got[i] for i in own) <= quality.ALPHA * len(own)


def plain_step(wrong, n, strata):
    q = Fraction(quality.ALPHA)
    for step, k in enumerate(wrong):
        tail = 1 if k >= n * q else sum(math.comb(n, j) * q**j * (1 - q) ** (n - j) for j in range(k + 1))
        if tail > quality.DELTA / strata:
            return step - 1 if step else None
    return quality.STEPS - 1


def test_the_ladder_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    stats, known = written(quality.statistics(load(spark, sf, "documents")).drop("text"), "s"), load(spark, sf, "labels")
    good = {r["doc_id"] for r in known.where("quality = 1").collect()}
    by = defaultdict(list)
    for r in stats.collect():
        if r["doc_id"] in good and r["n_words"] >= 20 and 100 * r["n_repeat_words"] <= 30 * r["n_words"]:
            by[r["lang"]].append(r)
    ratio = lambda r, rule: r[quality.RULES[rule][0]] / r[quality.RULES[rule][1]] if r[quality.RULES[rule][1]] else 0
    want = {}
    for lang, rows in by.items():
        wrong = [sum(any(ratio(r, rule) > quality.threshold(rule, i) for rule in quality.RULES) for r in rows) for i in range(quality.STEPS)]
        want[lang] = plain_step(wrong, len(rows), len(by))
    assert {r["stratum"]: r["step"] for r in quality.cutoffs(stats, known).collect()} == want


def test_names_of_other_columns_do_not_matter(spark):
    names = ["row", "_stratum", "cut_repeats", "t", "w", "a`b c.d", "_id", "kept", "u", "rank", "bin", "s", "_known", "score", "size", "n_words"]
    replaced = {"cut_repeats", "kept", "score", "size", "n_words"}  # by the operator that adds them
    docs = spark.createDataFrame([(i, f"word{i} " * 30, "en", "src") for i in range(6)], "doc_id long, text string, lang string, source string")
    docs = docs.select("*", *[F.lit("mine").alias(n) for n in names])
    known = labels(spark, [(i, 1, i % 2) for i in range(6)])
    for out in (quality.statistics(docs), quality.kept(docs, known), mixing.mix(docs), ngramjoin.first_of_each(docs), toxicity.toxicity(docs, known)):
        assert set(names) <= set(out.columns)
        for r in out.collect():
            assert all(r[n] == "mine" for n in names if n not in replaced)


def test_quality_stands_odd_input(spark):
    out = quality.quality_rules(odd(spark), labels(spark, [(None, 1, 0), (1, None, None), (2, 1, 0), (2, 0, 1)]))
    rows = out.select("doc_id", "n_words", "base_failed", "kept").collect()
    assert len(rows) == len(odd_rows())
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 20)
    assert quality.quality_rules(empty(spark), labels(spark)).count() == 0
    assert quality.kept(odd(spark), labels(spark)).count() == sum(r["kept"] for r in rows)


def test_targets_fill_up_to_the_caps(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 30, None: 0}
    got = {r["source"]: r for r in mixing.targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")).collect()}
    weights = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    assert {s: r["weight"] for s, r in got.items()} == weights
    target, open_ = {}, set(sizes)
    while open_:
        level = (sum(sizes.values()) - sum(target.values())) / sum(weights[s] for s in open_)
        above = {s for s in open_ if level * weights[s] > 3 * sizes[s]}
        if not above:
            target |= {s: level * weights[s] for s in open_}
            break
        target |= {s: 3 * sizes[s] for s in above}
        open_ -= above
    for s in sizes:
        assert got[s]["target"] == pytest.approx(target[s])


def test_mix_meets_targets(spark):
    docs = odd(spark).where("doc_id < 300 or doc_id is null")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    words, target, biggest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert 0 <= r["copies"] <= 3
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        words[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        biggest[r["source"]] = max(biggest[r["source"]], r["size"])
    for s, t in target.items():
        assert abs(words[s] - t) <= biggest[s] / 2 + 1, s
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r["doc_id"], r["copies"]) for r in rows) == Counter((r["doc_id"], r["copies"]) for r in again)
    assert mixing.taken(mixing.mix(docs)).count() == sum(r["copies"] for r in rows)
    assert mixing.mix(empty(spark)).count() == 0


def test_chances_are_calibrated(spark):
    rng = random.Random(11)
    rows = [(i, max(1, int(rng.lognormvariate(4.5, 1.2))), "a" if i < 20_000 else "b") for i in range(26_000)]
    text = F.repeat(F.lit("w "), F.col("n"))
    docs = spark.createDataFrame(rows, "doc_id long, n int, source string").withColumn("text", text)
    weight = lambda p: F.when(p == 0, 1.0).otherwise(1.5)
    sized = written(mixing.sized(docs).drop("row"), "sized")
    got = [r for r in mixing.drawn(sized, weight).collect()]
    for source in "ab":
        own = [r for r in got if r["source"] == source]
        whole = int(own[0]["whole"])
        owed = own[0]["target"] - whole * own[0]["source_size"]
        assert sum(r["pi"] * r["size"] for r in own) == pytest.approx(owed, rel=1e-9)
        for lo, hi in ((1, 50), (50, 150), (150, 400), (400, 10**9)):
            some = [r for r in own if lo <= r["size"] < hi]
            chance, drawn = sum(r["pi"] for r in some), sum(r["copies"] - whole for r in some)
            spread = sum(r["pi"] * (1 - r["pi"]) for r in some) ** 0.5
            assert abs(drawn - chance) <= 5 * spread + 1, (source, lo, drawn, chance)


def test_null_ids_draw_apart(spark):
    rows = [(None, f"w{i} " * 20, "a") for i in range(400)] + [(i, "x " * 40, "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, weight=lambda p: F.when(p == 0, 1.0).otherwise(5.0)).where("source = 'a'").collect()
    drawn = [int(r["text"].split()[0][1:]) for r in got if r["copies"]]
    assert 0 < len(drawn) < 400 and drawn != sorted(drawn)[: len(drawn)]


def test_pareto_odds_favour_the_likelier(spark):
    docs = spark.createDataFrame([(i, "w " * (5 if i % 2 else 500), "a" if i < 2000 else "b") for i in range(2400)], "doc_id long, text string, source string")
    rows = [r for r in mixing.mix(docs, weight=lambda p: F.when(p == 0, 1.0).otherwise(2.0), tilt=1.0).collect() if r["source"] == "a"]
    rate = lambda odd_: sum(r["copies"] for r in rows if r["doc_id"] % 2 == odd_) / 1000
    assert rate(1) > rate(0)  # the short ones have greater odds


def plain_place(key, t):
    import hashlib

    def unit(*parts):
        return (int(hashlib.md5("/".join("null" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16) + 0.5) / 2**52

    node = ""
    for level in sharding._levels(t):
        node = min((-math.log(unit(key, c)) / w, c) for c, w in level[node])[1]
    return int(node[1:])


def test_shards_equal_brute_force(spark):
    import zlib

    docs = odd(spark)
    rows = sharding.shard(docs).collect()
    texts = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == texts
    slots = defaultdict(list)
    for r in rows:
        assert r["shard"] == plain_place(r["doc_id"], sharding.tree())
        assert r["grown_shard"] == plain_place(r["doc_id"], sharding.tree(41))
        assert r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty(spark)).count() == 0


def test_weights_move_keys_within_their_subtree(spark):
    t, u = sharding.tree(), sharding.tree()
    u["g1"]["g1k0"]["s10"] = 3.0
    keys = spark.range(4000)
    moved = keys.select(sharding.place(F.col("id"), t).alias("a"), sharding.place(F.col("id"), u).alias("b")).where("a <> b").collect()
    inside = {int(s[1:]) for s in (*t["g1"]["g1k0"], *t["g1"]["g1k1"])}
    assert moved and all(r["b"] in inside for r in moved)


@pytest.mark.parametrize("n", [40, 41, 42, 200])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    keys = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    now = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in sharding.shard(keys, n).collect()}
    then = {r["doc_id"]: r["shard"] for r in sharding.shard(keys, n + 1).collect()}
    assert {k: grown for k, (_, grown) in now.items()} == then
    assert all(then[k] in (shard, n) for k, (shard, _) in now.items())
    moved = sum(then[k] != shard for k, (shard, _) in now.items())
    assert 0 < moved < 4 * 3000 / n
    with pytest.raises(ValueError, match="base"):
        sharding.tree(39)


def test_a_smaller_base_grows_alike():
    for n in range(8, 12):
        t = sharding.tree(n + 1, base=8)
        t.pop(f"n{n}")
        assert t == sharding.tree(n, base=8)
