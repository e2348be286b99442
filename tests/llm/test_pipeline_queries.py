import hashlib
import random
import struct
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from tessera.llm import mixing, ngramjoin, quality, queries, toxicity
from tessera.llm.common import load
from tessera.llm.tokens import default_path, encoder
from tests.llm.fixtures import odd, prose
from tests.llm.test_near_duplicates_toxicity import plain_features
from tests.llm.test_quality_mixing_sharding import WORD, plain_statistics

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = odd(spark).select(*COLUMNS)
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, before, SF)
        if name != "best-fit packing":
            assert docs.columns == COLUMNS
        rows = docs.collect()
        ids = Counter(r["doc_id"] for r in rows)
        if name == "quality rules":
            assert 200 not in ids and 203 not in ids and all(len((r["text"] or "").split()) >= 20 for r in rows)
        if name == "n-gram Jaccard join":
            want = ngramjoin.brute_force({r["doc_id"]: r["text"] for r in before.where("doc_id is not null and doc_id <> 3").collect()})
            assert {i for i in ids if i not in (None, 3)} == {c for _, c in want.values()}
        if name == "mixing sources":
            assert max(ids.values()) <= 3 * max(Counter(r["doc_id"] for r in before.collect()).values())
        if name == "best-fit packing":
            assert set(ids) == {r["doc_id"] for r in before.collect()}
        before = spark.createDataFrame(rows, docs.schema)


def plain_mix(rows):
    """(doc_id, source, text) -> copies, by filling targets, bisection for the factor and a sorted list."""
    position = {x: i for i, x in enumerate(sorted({r[1] for r in rows}, key=lambda x: (x is None, x or "")))}
    words = Counter()
    for _, source, text in rows:
        words[source] += len(WORD.findall(text))
    weight, target, open_ = {x: i % 3 + 1 for x, i in position.items()}, {}, set(position)
    while open_:
        level = (sum(words.values()) - sum(target.values())) / sum(weight[x] for x in open_)
        above = {x for x in open_ if level * weight[x] > 3 * words[x]}
        target |= {x: 3 * words[x] for x in above} if above else {x: level * weight[x] for x in open_}
        open_ -= above or open_
    out = []
    for source, size in words.items():
        own = [(r, len(WORD.findall(r[2]))) for r in rows if r[1] == source]
        whole = int(target[source] // size)
        owed, lo, hi = target[source] - whole * size, 0.0, 1e9
        if owed <= 0:
            out += [r for r, _ in own] * whole
            continue
        for _ in range(200):
            c = (lo + hi) / 2
            lo, hi = (c, hi) if sum(min(1, c * n**-mixing.TILT) * n for _, n in own) < owed else (lo, c)
        ranks = []
        for r, n in own:
            u = (int(hashlib.md5(f"{mixing.SEED}/{r[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            pi = min(1.0, lo * n**-mixing.TILT)
            ranks.append((u / (1 - u) / (pi / (1 - pi)) if pi < 1 - 1e-12 else 0, r[0], n, r))
        before = 0
        for rank, _, n, r in sorted(ranks, key=lambda x: x[:3]):
            out += [r] * (whole + (rank == 0 or before + n / 2 <= owed))
            before += n
    return out


def test_run_equals_a_plain_version(spark):
    docs, known = (load(spark, SF, t).collect() for t in ("documents", "labels"))
    rows = [(r["doc_id"], r["source"], r["text"] or "") for r in docs]
    assert max(Counter(r[0] for r in rows).values()) == 1 and len(rows) == 200
    quality_of = {r["doc_id"]: r for r in quality.quality_rules(load(spark, SF, "documents"), load(spark, SF, "labels")).collect()}
    assert all(quality_of[i]["cut_symbols"] == float("inf") for i, *_ in rows), "so few labels prove no threshold"
    stats = {i: plain_statistics(text) for i, _, text in rows}
    rows = [r for r in rows if not (stats[r[0]][0] < 20 or 100 * stats[r[0]][4] > 30 * stats[r[0]][0])]

    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, source string, text string"), load(spark, SF, "labels"))
    weight = dict(zip(model.known.tolist(), model.weights, strict=True))
    rows = [r for r in rows if model.bias + sum(weight.get(f, 0.0) for f in plain_features(r[2])) < 0]
    assert known and rows

    linked = ngramjoin.brute_force({i: text for i, _, text in rows}, 80, 5)
    rows = plain_mix([r for r in rows if linked[r[0]][1] == r[0]])

    tok, want = encoder(default_path()).tok, Counter()
    for i, _, text in rows:
        ids = [*tok.encode(text, add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 2048):
            piece = ids[at : at + 2048]
            want[(i, at // 2048, at, len(piece), zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)))] += 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) <= 2048
    assert len(places) <= -(-sum(r["length"] for r in got) // 2048) + 2


def test_near_duplicate_stage_links_five_words_at_four_fifths(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(1, 90)), "en", "s1", 1) for i in range(30)]
    for f in range(6):  # copies that keep 0.9 of three words and of five, 0.8 of five alone, or less
        base = prose(rng, 70).split(" ")
        for i in range(8):
            w = list(base)
            for _ in range(i // 2):
                w[rng.choice([0, 1, 69, rng.randrange(70)])] = f"c{rng.randrange(10**6)}"
            rows.append((100 + 10 * f + i, " ".join(w), "en", "s1", 1))
    texts = {r[0]: r[1] for r in rows}
    want = {c for _, c in ngramjoin.brute_force(texts, 80, 5).values()}
    assert want < {c for _, c in ngramjoin.brute_force(texts).values()}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()) == sorted(want)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.join(docs, 80, 5).collect()}
    assert got == ngramjoin.brute_force(texts, 80, 5)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_stand_empty_tables(spark, stage):
    assert stage(spark, odd(spark).select(*COLUMNS).limit(0), SF).count() == 0
