import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing, tokenfile
from tessera.llm.tokens import Encoder, default_path, encoder
from tests.llm.fixtures import empty, odd, odd_rows


def library(text):
    return encoder(default_path()).tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abcéÉß'.,s tllre123 \n\x85\xa0\x1cΣİ")), max_size=40))
def test_pieces_equal_the_library(text):
    e = encoder(default_path())
    assert e(text) == struct.pack(f"<{len(library(text))}I", *library(text))


def test_memory_is_bounded(monkeypatch):
    from tessera.llm import tokens

    monkeypatch.setattr(tokens, "MEMORY", 2000)
    e = Encoder(default_path())
    for i in range(50):
        assert e(f"word{chr(97 + i % 26)} other{chr(97 + i % 20)}.") == struct.pack(
            f"<{len(library(f'word{chr(97 + i % 26)} other{chr(97 + i % 20)}.'))}I",
            *library(f"word{chr(97 + i % 26)} other{chr(97 + i % 20)}."),
        )
    assert len(e.memory) + len(e.old) <= 20
    long = "w" * 500_000
    assert e(long) == struct.pack(f"<{len(library(long))}I", *library(long)) and long.encode() not in e.memory


def test_packing_holds_every_id_once(spark):
    rows = packing.pack(odd(spark), keep_ids=True).collect()
    want = defaultdict(int)
    for r in odd_rows():
        ids = [*library(r[1]), 0]
        for i in range(0, len(ids), 2048):
            p = ids[i : i + 2048]
            want[(r[0], i // 2048, i, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p)))] += 1
    got, places = defaultdict(int), defaultdict(list)
    for r in rows:
        got[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(places) <= -(-total // 2048) + 1
    assert packing.pack(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_exact_and_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip((rng.lognormal(4.5, 1, 3000)).astype(int), 1, 2048)
    histogram = dict(zip(*map(lambda x: x.tolist(), np.unique(lengths, return_counts=True)), strict=True))
    plan = packing.solve(histogram)
    held = defaultdict(int)
    for items, times in plan:
        assert sum(k * n for k, n in items.items()) <= 2048
        for k, n in items.items():
            held[k] += n * times
    assert held == histogram
    assert sum(t for _, t in plan) <= -(-int(lengths.sum()) // 2048) * 1.01 + 1
    assert packing.solve({}) == []
    assert sum(t for _, t in packing.solve({1100: 7})) == 7


@pytest.mark.parametrize("seed", range(3))
def test_the_program_is_solved_and_most_bins_are_its(seed):
    rng = np.random.default_rng(seed)
    lengths, counts = np.unique(np.clip(rng.lognormal(5.5, 1.1, 4000).astype(int), 1, 2047), return_counts=True)
    bound = int((lengths * counts).sum()) / 2048
    plan = packing.fractional(lengths, counts, 2048)
    covered = np.zeros(len(lengths))
    for items, x in plan:
        assert x > 0 and sum(int(lengths[k]) * n for k, n in items.items()) <= 2048
        for k, n in items.items():
            covered[k] += n * x
    assert (covered >= counts * (1 - 1e-9)).all()
    assert bound * (1 - 1e-9) <= sum(x for _, x in plan) <= 1.01 * bound
    made, rest = packing.rounded(lengths, counts, 2048)
    bins, of_program = sum(t for _, t in made + rest), sum(t for _, t in made)
    assert of_program >= 0.9 * bins and bins <= -(-bound // 1) + 2


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_few_lengths_lose_no_sequences(k):
    histogram = {1040: 6 * k, 550: 6 * k, 530: 6 * k, 470: 12 * k}
    plan = packing.solve(histogram)
    held = defaultdict(int)
    for items, times in plan:
        assert sum(length * n for length, n in items.items()) <= 2048
        for length, n in items.items():
            held[length] += n * times
    assert held == histogram
    assert sum(t for _, t in plan) == 9 * k


def test_token_files_round_trip(spark, tmp_path):
    docs = odd(spark)
    manifest = tokenfile.write(docs, f"file://{tmp_path}/t")
    rows = tokenfile.read(manifest).collect()
    key = lambda d: (d is not None, d or 0)
    want = sorted(((key(r[0]), zlib.crc32((r[1] or "").encode()), [*library(r[1]), 2]) for r in odd_rows()), key=lambda x: x[:2])
    rows.sort(key=lambda r: r["start"])
    start = 0
    for r, (k, _, ids) in zip(rows, want, strict=True):
        assert (key(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) == (k, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert tokenfile.round_trip(empty(spark)).count() == 0


def test_one_document_is_read_alone_and_a_wrong_dictionary_refused():
    import io

    class Stream(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    raw = tokenfile.dictionary([bytes([i % 7, 0, i % 5, 1]) * 30 for i in range(100)])
    out = Stream()
    w = tokenfile.FileWriter(out, raw, 2)
    for i in range(20):
        w.add(i if i else None, struct.pack("<3I", i, 70 + i, 2))
    w.close()
    r = tokenfile.FileReader(out, raw)
    assert r.ids(13).tolist() == [13, 83, 2]
    assert not r.index[0]["has_id"]
    with pytest.raises(ValueError, match="dictionary"):
        tokenfile.FileReader(out, raw + b"x")
