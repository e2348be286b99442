import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import chat, media, queries, warc
from tests.llm.fixtures import empty, odd, odd_rows


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 400), st.integers(0, 3), st.integers(0, 10**6))
def test_streams_round_trip(size, pes, seed):
    payload = random.Random(seed).randbytes(size + pes * media.PES_BYTES)
    stored = media.mux(payload)
    s = media.demux(stored)
    assert s.payload == payload and not s.faults and not s.lost and not s.repeated
    assert len(stored) % 188 == 0
    assert s.timestamps == [i * media.PES_TICKS for i in range(max(1, -(-len(payload) // media.PES_BYTES)))]
    assert len(s.random_access) == len(s.timestamps)


def test_damage_is_noticed():
    stored = media.mux(bytes(range(256)) * 20)
    cut = stored[: 188 * 6] + stored[188 * 7 :]
    assert media.demux(cut).lost == 1
    again = stored[: 188 * 6] + stored[188 * 5 : 188 * 6] + stored[188 * 6 :]
    s = media.demux(again)
    assert s.repeated == 1 and s.lost == 0 and s.payload == bytes(range(256)) * 20
    assert media.demux(stored[188:]).faults == ["no PAT"]
    assert media.demux(stored[:188] + stored[376:]).faults == ["no PMT"]
    broken = bytearray(stored)
    broken[20] ^= 1
    assert "bad PAT" in media.demux(bytes(broken)).faults
    assert media.demux(stored[:-5]).faults
    assert media.demux(b"").faults == ["no PAT"]
    assert media.section_crc(b"123456789") == 0x0376E6E7


def test_a_stream_by_its_fixed_bytes():
    stored = media.mux(b"a" * 100)
    # a program association table with program 1 at 0x1000, with its well-known checksum
    assert stored[:21] == bytes.fromhex("474000100000b00d0001c100000001f0002ab104b2") and stored[21:188] == b"\xff" * 167
    assert stored[188:192] == bytes.fromhex("47500010")
    pes = stored[376:]
    assert pes[:2] == bytes.fromhex("4741") and pes[3] == 0x30 and pes[5] & 0x50 == 0x50  # random access and clock reference
    begin = 5 + pes[4]
    assert pes[begin : begin + 14] == bytes.fromhex("000001bd006c848005") + bytes.fromhex("2100010001")
    assert pes[begin + 14 :] == b"a" * 100 and len(stored) == 3 * 188


def test_damage_never_raises():
    rng = random.Random(1)
    whole = media.mux(rng.randbytes(3000))
    for i in range(4000):
        bad = bytearray(whole if i % 2 else whole[: 188 * rng.randint(1, 5)])
        for _ in range(rng.randint(1, 4)):
            bad[rng.randrange(len(bad))] = rng.randrange(256)
        for at in (4, 5, 192, 193)[: rng.randint(0, 4)]:  # pointer fields and table lengths
            bad[at % len(bad)] = rng.randrange(256)
        media.demux(bytes(bad))
        media.demux(rng.randbytes(rng.randrange(600)))


def test_marked_discontinuities_are_no_loss():
    whole = media.mux(bytes(100_000))
    first = [k for k in range(len(whole) // 188) if whole[188 * k + 1] & 0x40 and whole[188 * k + 3] & 0x20][1]  # of the second elementary packet
    cut = bytearray(whole[: 188 * (first - 3)] + whole[188 * first :])
    assert media.demux(bytes(cut)).lost == 3
    cut[188 * (first - 3) + 5] |= 0x80
    assert media.demux(bytes(cut)).lost == 0


def test_media_table(spark):
    rows = media.features(media.store(odd(spark))).collect()
    want = Counter()
    for r in odd_rows():
        raw = (r[1] or "").encode()
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        want[(r[0], len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), hashlib.sha256(media.mux(p)).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_sha256"]) for r in rows) == want
    assert media.features(media.store(empty(spark))).count() == 0


@given(st.text(alphabet="\\</turn>\n#: ehcx", max_size=30), st.text(alphabet="user:\\#</turn>", max_size=12))
def test_escapes_are_reversible(text, role):
    assert chat.unescaped(chat.escaped(text)) == text
    segment, a, e = chat.formatted(role, text)
    assert chat.parsed(segment * 2) == [(role, text)] * 2
    assert chat.unescaped(segment[a:e]) == text
    assert segment.count(chat.CLOSE) == 1


def conversation_rows():
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["hi é", "", None, "### user: x</turn>\n", "\\h\\e"])) for c in range(20) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(600)]  # a long one
    rows += [(60, 1, "user", "b"), (60, 1, "user", "a"), (60, 1, "user", "a"), (60, None, "assistant", "first"), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    return rows


def test_chat_equals_brute_force(spark):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, seq string").repartition(5)
    segs = chat.segments(df)
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    got = {r["conv_id"]: r for r in chat.digests(segs).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, role, x in turns if role == "assistant")
        whole = "".join(chat.formatted(role, x)[0] for *_, role, x in turns)
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{x}\n" for *_, role, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c]["formatted_chars"] == len(whole)
    for r in chat.materialised(segs.where("conv_id < 20 or conv_id = 60")).collect():
        turns = by[r["conv_id"]]
        assert chat.unescaped(r["text"][r["loss_start"] : r["loss_end"]]) == turns[r["target"]][3]
        assert chat.parsed(r["text"][: r["text"].rfind(chat.OPEN)]) == [(x[2], x[3]) for x in turns[: r["target"]]]
    assert chat.digests(chat.segments(df.limit(0))).count() == 0


def test_the_query_trains_on_its_examples_alone(spark, monkeypatch, tmp_path):
    rows = [r for r in conversation_rows() if r[0] != 50]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    of = lambda: {r["conv_id"]: r for r in queries.op8_prefix_targets(spark, str(tmp_path)).collect()}
    whole, expand = of(), chat.examples
    replies = Counter(c for c, _, role, _ in rows if role == "assistant")
    segs = chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert Counter(r["conv_id"] for r in expand(segs).collect()) == replies
    monkeypatch.setattr(chat, "examples", lambda s: expand(s).where("conv_id <> 60"))
    less = of()
    assert less[60]["loss_chars"] == 0 < whole[60]["loss_chars"] == len("first")
    assert less[60]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(less[c] == whole[c] for c in range(20))
    wrong = expand(segs).withColumn("context_end", F.col("context_end") + 1)
    with pytest.raises(Exception, match="not all turns before"):
        chat.digests(segs, wrong).collect()


def archive(n=6):
    payloads = [(f"page {i} é\r\n\r\n" * (i + 1)).encode() for i in range(n)]
    return [warc.record(i, f"http://x/{i} a\n", p, hashlib.sha256(p).hexdigest(), None, False) for i, p in enumerate(payloads)], payloads


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_recovers_all_but_the_damaged(zipped):
    raws, payloads = archive()
    parts = [warc.member(r) if zipped else r for r in raws]
    whole = b"".join(parts)
    assert [warc.described(x)[0] for x in warc.salvage(whole)] == list(range(6))
    begin = sum(map(len, parts[:2]))
    rng = random.Random(0)
    for _ in range(40):
        bad = bytearray(whole)
        at = begin + rng.randrange(len(parts[2]) - 4)
        bad[at] ^= 1 << rng.randrange(8)
        found = list(warc.salvage(bytes(bad)))
        rows = [d for x in found if isinstance(x, warc.Record) and (d := warc.described(x))]
        whole_ones = [d[0] for d in rows if d[0] in range(6) and d[2] == hashlib.sha256(payloads[d[0]]).hexdigest()]
        assert [i for i in whole_ones if i != 2] == [0, 1, 3, 4, 5]
        gaps = [x for x in found if isinstance(x, warc.Gap)]
        assert all(begin <= g.start < g.stop <= begin + len(parts[2]) for g in gaps)
    found = list(warc.salvage(whole[:begin] + b"junk" + whole[begin : -len(parts[5]) // 2]))
    assert [type(x).__name__ for x in found] == ["Record"] * 2 + ["Gap"] + ["Record"] * 3 + ["Gap"]
    assert list(warc.salvage(b"")) == []


def test_salvage_reads_all_records_of_a_member():
    raws, _ = archive()
    ids = lambda found: [warc.described(x)[0] for x in found if isinstance(x, warc.Record)]
    whole = warc.member(b"".join(raws))
    assert ids(warc.salvage(whole)) == list(range(6)) and len(list(warc.salvage(whole))) == 6
    bad = raws[2].replace(b"page 2", b"pagf 2", 1)
    found = list(warc.salvage(warc.member(b"".join([*raws[:2], bad, *raws[3:]]))))
    assert ids(found) == [0, 1, 3, 4, 5] and sum(isinstance(x, warc.Gap) for x in found) == 1
    noise = [warc.record(i, "u", p := random.Random(i).randbytes(3000), hashlib.sha256(p).hexdigest(), None, False) for i in range(6)]
    zipped = warc.member(b"".join(noise))
    found = list(warc.salvage(zipped[: len(zipped) // 2] + warc.member(raws[5])))
    assert ids(found)[:2] == [0, 1] and ids(found)[-1] == 5 and len(set(ids(found))) == len(ids(found))
    stored = warc.member(b"".join(raws), 0)
    assert ids(warc.salvage(stored[: len(stored) - 20])) == [0, 1, 2, 3, 4, 5][: len(ids(warc.salvage(stored[: len(stored) - 20])))]


@pytest.mark.parametrize("encoded", [lambda d: d.hex(), lambda d: base64.b32encode(d).decode()])
def test_salvage_checks_sha1(encoded):
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Block-Digest: sha1:{encoded(hashlib.sha1(block).digest())}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    raw = head + block + b"\r\n\r\n"
    assert [type(x) for x in warc.salvage(raw)] == [warc.Record]
    assert [type(x) for x in warc.salvage(raw.replace(b"body", b"bady"))] == [warc.Gap]


def test_salvage_checks_payload_digests_and_keeps_nested_records_in_their_gap():
    inner = warc.record(99, "u", b"nested", hashlib.sha256(b"nested").hexdigest(), None, False)
    raws, _ = archive(3)
    outer = warc.record(1, "u", payload := b"x" + inner + b"y", hashlib.sha256(payload).hexdigest(), None, False)
    ids = lambda raw: [warc.described(x)[0] for x in warc.salvage(raw) if isinstance(x, warc.Record)]
    assert ids(raws[0] + outer + raws[2]) == [0, 1, 2]
    damaged = outer.replace(b"nested", b"nestet")  # the inner one is damaged, too
    assert ids(raws[0] + damaged + raws[2]) == [0, 2]
    damaged = outer[:-5] + b"z" + outer[-4:]
    found = list(warc.salvage(raws[0] + damaged + raws[2]))
    assert [type(x) for x in found] == [warc.Record, warc.Gap, warc.Record] and found[1].stop - found[1].start == len(outer)
    assert ids(warc.member(raws[0] + damaged + raws[2])) == [0, 2]
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    assert [type(x) for x in warc.salvage(head % base64.b32encode(hashlib.sha1(b"body").digest()))] == [warc.Record]
    assert [type(x) for x in warc.salvage(head % base64.b32encode(hashlib.sha1(b"bodies").digest()))] == [warc.Gap]


def test_very_long_texts(spark):
    long = "é</turn> ### " * 100_000
    segs = chat.segments(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string"))
    r = chat.digests(segs).first()
    assert (r["loss_chars"], r["loss_sha256"]) == (len(long), hashlib.sha256(long.encode()).hexdigest())
    pages = spark.createDataFrame([(1, "u", long), (2, "u", long)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert got[1]["payload_digest"] == got[2]["payload_digest"] == hashlib.sha256(long.encode()).hexdigest() and got[2]["refers_to"] == 1


def test_archives_round_trip(spark, tmp_path):
    big = "x" * 150
    pages = [
        (1, "http://a", big),
        (2, "http://b", big),
        (3, None, big),
        (4, "u", "small"),
        (5, "u", "small"),
        (6, "u", None),
        (7, "u", ""),
        (2, "http://b", big),
        (None, "n", big),
        (None, "n", "y" * 120),
        (1, "http://a", big),
        (9, "l", "é" * 100_000),
    ]
    df = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    manifest = warc.write(df, f"file://{tmp_path}/w")
    got = Counter(tuple(r)[:5] for r in warc.read(manifest).collect())
    want = Counter()
    for i, _, t in pages:
        raw = (t or "").encode()
        revisit = t == big and i != 1
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None)] += 1
    assert got == want
    assert warc.gaps(manifest).count() == 0
    path = manifest.first()["path"].removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 2] ^= 255
    open(path, "wb").write(bytes(raw))
    assert warc.gaps(manifest).count() >= 1
    assert warc.round_trip(df.limit(0)).count() == 0
