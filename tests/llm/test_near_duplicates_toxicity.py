import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import byteshash, components, ngramjoin, toxicity
from tessera.llm.common import load
from tests.llm.fixtures import empty, labels, odd, odd_rows, prose


def family(rng, base, ids, changes):
    out = []
    for i in ids:
        w = base.split(" ")
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"c{rng.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, rng.randint(1, 90))) for i in range(60)]
    for f in range(4):  # chains of near copies near the threshold
        rows += family(rng, prose(rng, rng.randint(60, 200)), range(100 + 40 * f, 130 + 40 * f), 5)
    rows += [(500 + i, shared + " " + prose(rng, rng.randint(1, 20))) for i in range(40)]  # a passage that many share
    rows += [(600, None), (601, ""), (602, "a b"), (603, "A B"), (604, "a"), (605, "a")]
    rng.shuffle(rows)
    want = ngramjoin.brute_force(dict(rows))
    got = ngramjoin.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_templated_texts_make_few_pairs(spark, monkeypatch):
    """Texts of twelve slots with two phrases each share n-grams with nearly all others; few pairs are similar."""

    def candidates(n):
        rng = random.Random(7)
        slots = [[prose(rng, 12) for _ in range(2)] for _ in range(12)]
        rows = [(i, " ".join(rng.choice(s) for s in slots)) for i in range(n)]
        made = []
        check = ngramjoin.verified
        monkeypatch.setattr(ngramjoin, "verified", lambda pairs, *a: made.append([tuple(r) for r in pairs.select("a", "b").collect()]) or check(pairs, *a))
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        monkeypatch.undo()
        assert got == ngramjoin.brute_force(dict(rows))
        assert not set(made[0]) & set(made[1])  # no pair is verified twice
        return len(made[0]) + len(made[1])

    assert candidates(250) <= 250 * 2


def test_filters_let_every_similar_pair_pass(spark):
    rng = random.Random(9)
    rows = family(rng, prose(rng, 150), range(60), 8)
    grams = {r["doc_id"]: r for r in ngramjoin.profiles(spark.createDataFrame(rows, "doc_id long, text string"), np.zeros(1 << ngramjoin.COUNTERS, np.uint8)).collect()}
    words = {i: t.split() for i, t in rows}
    sets = {i: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} for i, w in words.items()}
    for a in sets:
        for b in sets:
            unequal = sum(((grams[a][q] ^ grams[b][q]) & (2**64 - 1)).bit_count() for q in ngramjoin.PARITY)
            assert unequal <= len(sets[a] ^ sets[b])


def test_join_stands_odd_input(spark):
    rows = ngramjoin.join(odd(spark)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows())
    of = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] not in (None, 3)}
    assert {of[100 + i] for i in range(8)} == {100} == {of[120 + i] for i in range(8)}
    assert of[204] == of[205] == 204 and of[200] == 200 and of[201] == 201 and of[203] == 203
    assert sorted(str(r["component_id"]) for r in rows if r["doc_id"] is None) == ["100", "None", "None"]
    assert ngramjoin.join(empty(spark)).count() == 0
    kept = ngramjoin.first_of_each(odd(spark)).collect()
    assert sum(r["doc_id"] is not None and 100 <= r["doc_id"] < 130 for r in kept) == 1
    assert sum(r["doc_id"] is None for r in kept) == 2  # once for each text


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 4)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in list(parent)}
    assert len(got) == len(parent)


def test_unfinished_components_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(components, "ROUNDS", 1)
    with pytest.raises(RuntimeError, match="not closed"):
        components.components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"))


INSULTS = ["zonk", "blarg", "fnord"]


def corpus(n, rng, biased=False):
    """Toxic texts hold an insult; with `biased`, most of them also name a group that clean ones rarely name."""
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = prose(rng, rng.randint(5, 60)).split(" ")
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        if biased and rng.random() < (0.9 if toxic else 0.05):
            w.insert(rng.randrange(len(w)), "muslims")
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1500, random.Random(2))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, "zonk " * 20_000), (None, "zonk you")], "doc_id long, text string")
    out = toxicity.toxicity(docs, labels(spark, [(i, 1, x) for i, _, x in rows] + [(7, 1, None), (None, 1, 1)])).collect()
    truth = {i: x for i, _, x in rows}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 200 and len(out) == 1504
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    by = {r["doc_id"]: r for r in out}
    assert by[5000]["predicted"] == by[5001]["predicted"] == 0 and by[5002]["predicted"] == 1 and by[None]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_counterfactuals_free_group_names_of_blame(spark, monkeypatch):
    rows = corpus(1500, random.Random(3), biased=True)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    known = labels(spark, [(i, 1, x) for i, _, x in rows])
    neutral = pa.array(["the muslims of ren met lo ka", "the hindus of ren met lo ka"])
    fair = toxicity.train(docs, known).scores(neutral)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    blind = toxicity.train(docs, known).scores(neutral)
    assert abs(fair[0] - fair[1]) < 0.5 * abs(blind[0] - blind[1])
    assert fair[0] < blind[0]
    assert toxicity.swapped("Women met a gay man") == "men met a lesbian girl"
    assert toxicity.swapped("no group") is None


def test_swaps_go_through_whole_groups_of_all_languages(spark, monkeypatch):
    terms = [t for g in toxicity.IDENTITIES for t in g]
    assert len(terms) == len(set(terms)) and all(t == t.lower() for t in terms)
    assert toxicity.variants("no group") == []
    assert toxicity.variants("Die Frauen und der Mann") == ["Die männer und der frau", "Die mädchen und der mann", "Die jungen und der frau"]
    assert {toxicity.swapped(t) for t in ("Les hommes", "los judíos", "MÄDCHEN")} == {"Les filles", "los hindúes", "jungen"}
    rows = [(i, t.replace("muslims", "ateos"), x) for i, t, x in corpus(1500, random.Random(3), biased=True)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    known = labels(spark, [(i, 1, x) for i, _, x in rows])
    neutral = pa.array([f"{t} of ren met lo ka" for t in ("ateos", "judíos", "budistas")])
    fair = toxicity.train(docs, known).scores(neutral)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    blind = toxicity.train(docs, known).scores(neutral)
    assert np.ptp(fair) < 0.5 * np.ptp(blind)


def plain_features(text):
    """The features of a text, by plain arithmetic."""
    m, out = (1 << 64) - 1, set()
    table, base = byteshash.TABLE.tolist(), int(byteshash.BASE)

    def hashed(raw):
        h = sum(table[b] * pow(base, i, 1 << 64) for i, b in enumerate(raw)) & m
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = ((h ^ (h >> shift)) * factor) & m
        return h ^ (h >> 31)

    for word in (text or "").translate({i: i + 32 for i in range(65, 91)}).translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" "):
        raw = word.encode()
        if not raw:
            continue
        for _ in range(4):
            raw = raw[1:] if len(raw) > 1 and toxicity._TRIM[raw[0]] else raw
            raw = raw[:-1] if len(raw) > 1 and toxicity._TRIM[raw[-1]] else raw
        for k in (0, *toxicity.PREFIXES):
            if len(raw) >= k:
                out.add(((hashed(raw[:k] if k else raw) ^ int(toxicity._SALT[k])) >> 7) & ((1 << toxicity.BITS) - 1))
    return out


def test_scores_equal_a_plain_scorer():
    texts = [r[1] if r[1] is None or len(r[1]) < 3000 else r[1][:3000] for r in odd_rows()]
    every = [plain_features(t) for t in texts]
    known = np.array(sorted(random.Random(4).sample(sorted(set().union(*every)), 300)), np.int64)
    model = toxicity.Model(known, np.random.default_rng(1).normal(size=300), -0.3)
    weight = dict(zip(known.tolist(), model.weights, strict=True))
    want = [1 / (1 + np.exp(0.3 - sum(weight.get(f, 0.0) for f in own))) for own in every]
    assert np.allclose(model.scores(pa.array(texts)), want)
    assert [set(x.tolist()) for x in toxicity.sets(pa.array(texts))] == every


def test_the_penalty_binds_on_the_tables(spark):
    """Texts of the tables hold no identity term; mentions that are put into them are swapped, and any change is penalised."""
    sf = "/root/testdata/sf0.01"
    known, _, texts, toxic, changes = toxicity.examples(toxicity.learnt_from(load(spark, sf, "documents"), load(spark, sf, "labels")))
    pairs = [c for own in changes for c in own]
    assert len(pairs) > len(texts) > 200 and all(len(a) or len(b) for a, b in pairs)
    change = lambda m: np.mean([(m.weights[b].sum() - m.weights[a].sum()) ** 2 for a, b in pairs])
    named = pairs[0][1]  # were a term of a group among the toxic texts, its weight would be held down
    biased = [np.union1d(x, named) if y and i % 2 else x for i, (x, y) in enumerate(zip(texts, toxic, strict=True))]
    free = toxicity.fit(known, biased, toxic)
    assert change(free) > 0 and change(toxicity.fit(known, biased, toxic, pairs)) < 0.5 * change(free)


def test_copies_of_one_document_push_out_no_others(spark):
    rows = [r for r in corpus(200, random.Random(8)) if zlib.crc32(str(r[0]).encode()) % 5]
    clean = next(i for i, _, x in rows if not x)
    copies = [(clean, f"ka lo mi {i}") for i in range(1000)]
    known = labels(spark, [(i, 1, x) for i, _, x in rows])

    def model(pairs):
        return toxicity.train(spark.createDataFrame(pairs, "doc_id long, text string"), known, len(rows))

    single = [(i, t) for i, t, _ in rows]
    one, other = model(copies + single), model(single[::-1] + copies[::-1])
    assert len(one.known) and one.known.tolist() == other.known.tolist()
    assert np.array_equal(one.weights, other.weights) and one.bias == other.bias
    assert (one.scores(pa.array(["ren zonk tas", "ren lo tas"])) >= 0.5).tolist() == [True, False]


def test_toxicity_stands_odd_input(spark):
    assert toxicity.toxicity(odd(spark), labels(spark)).count() == len(odd_rows())
    assert toxicity.toxicity(empty(spark), labels(spark, [(1, 1, 1)])).count() == 0
