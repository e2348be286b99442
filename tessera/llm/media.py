"""Media columns as MPEG transport streams.

`mux` stores bytes as a program with one private-data stream: a program association and a program map table, then
elementary packets (PES) of bounded size, each with a presentation timestamp and a random-access point at its first
packet. `demux` reads any such stream: it checks sync bytes and table checksums, follows the tables to the stream, checks
continuity counters, drops repeated packets and reassembles the elementary packets.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship, shared_dir

PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, ES_PID, NULL_PID = 0, 0x1000, 0x0100, 0x1FFF
#: Stream type of PES packets with private data, and their stream id.
PRIVATE, PRIVATE_ID = 0x06, 0xBD
#: Bytes of payload in an elementary packet, and its duration in ticks of 90 kHz.
PES_BYTES, PES_TICKS = 32 * 1024, 3600
#: The payload is padded with zeros to a positive multiple of this.
BLOCK = 64


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1
        out.append(c & 0xFFFFFFFF)
    return out


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    """The checksum of program tables; 0 over a section with its checksum."""
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table, 0xB000 | (5 + len(body) + 4), number, 0xC1, 0, 0)
    raw = head + body
    return raw + struct.pack(">I", section_crc(raw))


def _table_packet(pid: int, section: bytes) -> bytes:
    head = struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10) + b"\0" + section
    return head + b"\xff" * (PACKET - len(head))


_TABLES = _table_packet(PAT_PID, _section(0, 1, struct.pack(">HH", 1, 0xE000 | PMT_PID))) + _table_packet(
    PMT_PID, _section(2, 1, struct.pack(">HHBHH", 0xE000 | ES_PID, 0xF000, PRIVATE, 0xE000 | ES_PID, 0xF000))
)


def _timestamp(pts: int) -> bytes:
    return bytes([0x21 | (pts >> 29) & 0x0E, (pts >> 22) & 0xFF, 0x01 | (pts >> 14) & 0xFE, (pts >> 7) & 0xFF, 0x01 | (pts << 1) & 0xFE])


def mux(payload: bytes) -> bytes:
    """A transport stream that holds `payload`; the same for equal payloads."""
    out, counter = [_TABLES], 0
    for i, at in enumerate(range(0, max(1, len(payload)), PES_BYTES)):
        pts = i * PES_TICKS
        body = payload[at : at + PES_BYTES]
        data = struct.pack(">IHBBB", 0x100 | PRIVATE_ID, len(body) + 8, 0x84, 0x80, 5) + _timestamp(pts) + body
        # the first packet: random access, clock reference
        extra = struct.pack(">BHI", 0x50, (pts >> 17) & 0xFFFF, ((pts & 0x1FFFF) << 15 | 0x7E00) & 0xFFFFFFFF)
        room = PACKET - 4 - 1 - len(extra)
        extra += b"\xff" * max(0, room - len(data))
        out.append(struct.pack(">BHBB", SYNC, 0x4000 | ES_PID, 0x30 | counter, len(extra)) + extra + data[:room])
        counter = (counter + 1) & 15
        rest = data[room:]
        full = len(rest) // 184
        if full:
            block = np.empty((full, PACKET), np.uint8)
            block[:, 0], block[:, 1], block[:, 2] = SYNC, ES_PID >> 8, ES_PID & 255
            block[:, 3] = 0x10 | (counter + np.arange(full)) & 15
            block[:, 4:] = np.frombuffer(rest, np.uint8, full * 184).reshape(full, 184)
            out.append(block.tobytes())
            counter = (counter + full) & 15
        if tail := rest[full * 184 :]:
            gap = 184 - len(tail) - 1
            stuffing = bytes([gap]) + (b"\0" + b"\xff" * (gap - 1) if gap else b"")
            out.append(struct.pack(">BHB", SYNC, ES_PID, 0x30 | counter) + stuffing + tail)
            counter = (counter + 1) & 15
    return b"".join(out)


@dataclass
class Stream:
    """What `demux` finds: the payload, a timestamp per elementary packet, packet numbers of random-access points, faults."""

    payload: bytes = b""
    timestamps: list[int | None] = field(default_factory=list)
    random_access: list[int] = field(default_factory=list)
    packets: int = 0
    lost: int = 0
    repeated: int = 0
    faults: list[str] = field(default_factory=list)


def _sections(raw: bytes, fault: list[str], name: str) -> bytes | None:
    """The body of the section that a table's packet begins, or a fault."""
    at = 1 + raw[0] if raw else 0
    size = 3 + (struct.unpack_from(">H", raw, at + 1)[0] & 0x0FFF) if len(raw) >= at + 3 else 0
    section = raw[at : at + size]
    if size < 12 or len(section) < size or section_crc(section):
        fault.append(f"bad {name}")
        return None
    return section[8:-4]


def demux(media: bytes) -> Stream:
    """Reads a stream; damage is reported in `faults`, `lost` and `repeated`, never raised. Bytes after the last whole packet are a fault.

    A jump of the counter at a packet that is marked as a discontinuity is not a loss.
    """
    out = Stream(packets=len(media) // PACKET)
    if len(media) % PACKET:
        out.faults.append("cut packet")
    grid = np.frombuffer(media, np.uint8, out.packets * PACKET).reshape(-1, PACKET)
    good = (grid[:, 0] == SYNC) & (grid[:, 1] < 0x80)
    if not good.all():
        out.faults.append(f"{int((~good).sum())} packets without sync or with an error mark")
    pid = (grid[:, 1].astype(np.int32) & 0x1F) << 8 | grid[:, 2]
    starts = grid[:, 1] & 0x40 > 0

    def table(of: int, name: str) -> bytes | None:
        for k in np.flatnonzero(good & (pid == of) & starts):
            if (body := _sections(_payload(grid[k]), out.faults, name)) is not None:
                return body
        out.faults.append(f"no {name}")
        return None

    if (pat := table(PAT_PID, "PAT")) is None:
        return out
    programs = [struct.unpack_from(">HH", pat, i) for i in range(0, len(pat) - 3, 4)]
    pmt_pid = next((p & 0x1FFF for n, p in programs if n), None)
    if pmt_pid is None or (pmt := table(pmt_pid, "PMT")) is None:
        return out
    if len(pmt) < 4:
        out.faults.append("bad PMT")
        return out
    at, es = 4 + (struct.unpack_from(">H", pmt, 2)[0] & 0x0FFF), None
    while at + 5 <= len(pmt) and es is None:
        kind, p, size = struct.unpack_from(">BHH", pmt, at)
        es = p & 0x1FFF if kind == PRIVATE else None
        at += 5 + (size & 0x0FFF)
    if es is None:
        out.faults.append("no private stream")
        return out
    own = np.flatnonzero(good & (pid == es) & (grid[:, 3] & 0x10 > 0))
    counter = (grid[own, 3] & 15).astype(np.int32)
    if len(own) > 1:
        step = (counter[1:] - counter[:-1]) & 15
        again = np.concatenate([[False], (step == 0) & (grid[own[1:]] == grid[own[:-1]]).all(axis=1)])
        out.repeated = int(again.sum())
        marked = (grid[own[1:], 3] & 0x20 > 0) & (grid[own[1:], 4] > 0) & (grid[own[1:], 5] & 0x80 > 0)
        out.lost = int(((step - 1) & 15)[~again[1:] & ~marked].sum())
        own = own[~again]
    parts: list[bytes] = []
    first = np.flatnonzero(starts[own])
    for i, a in enumerate(first):
        run = own[a : first[i + 1] if i + 1 < len(first) else len(own)]
        if grid[run[0], 3] & 0x20 and grid[run[0], 4] and grid[run[0], 5] & 0x40:
            out.random_access.append(int(run[0]))
        plain = grid[run, 3] & 0x30 == 0x10
        data, k = [], 0
        while k < len(run):
            if plain[k]:
                e = k + 1
                while e < len(run) and plain[e]:
                    e += 1
                data.append(grid[run[k:e], 4:].tobytes())
                k = e
            else:
                data.append(_payload(grid[run[k]]))
                k += 1
        raw = b"".join(data)
        if len(raw) < 9 or raw[:3] != b"\0\0\1":
            out.faults.append("bad PES head")
            continue
        size, has, head = struct.unpack_from(">H", raw, 4)[0], raw[7] >> 7, 9 + raw[8]
        p = raw[9:14]
        if has and len(p) < 5:
            out.faults.append("short PES head")
            has = 0
        out.timestamps.append(((p[0] >> 1) & 7) << 30 | p[1] << 22 | (p[2] >> 1) << 15 | p[3] << 7 | p[4] >> 1 if has else None)
        body = raw[head : 6 + size] if size else raw[head:]
        if size and len(raw) < 6 + size:
            out.faults.append("short PES packet")
        parts.append(body)
    out.payload = b"".join(parts)
    return out


def _payload(packet: np.ndarray) -> bytes:
    raw = packet.tobytes()
    return raw[5 + raw[4] :] if raw[3] & 0x20 else raw[4:]


def feature(s: Stream) -> str:
    return f"packets={s.packets};pes={len(s.timestamps)};first_pts={s.timestamps[0] if s.timestamps else None};last_pts={s.timestamps[-1] if s.timestamps else None};random_access={len(s.random_access)};lost={s.lost};repeated={s.repeated};faults={len(s.faults)}"


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % BLOCK if raw else BLOCK)


STORED = "doc_id long, n_bytes long, media binary, timestamps array<long>, random_access array<long>"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (UTF-8 of the text; null: 0), media (transport stream of the padded bytes), its timestamps and random-access packets.

    One row per row of docs, repeated rows and null doc_ids too; null and empty texts are one block of zeros, a text of any
    length is one stream. An empty table has no rows; other columns are left out. The table is written to the shared folder,
    compressed.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                raws = [(t or "").encode() for t in part.column(1).to_pylist()]
                media = [mux(padded(r)) for r in raws]
                seen = [demux(m) for m in media]
                kinds = pa.list_(pa.int64())
                cols = [
                    part.column(0),
                    pa.array([len(r) for r in raws], pa.int64()),
                    pa.array(media, pa.binary()),
                    pa.array([s.timestamps for s in seen], kinds),
                    pa.array([s.random_access for s in seen], kinds),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "media", "timestamps", "random_access"])

    path = shared_dir(docs.sparkSession, "media")
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STORED)
    out.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def features(stored: DataFrame) -> DataFrame:
    """Reads the media column back and describes it: digests of the payload and of the stored bytes, and `feature`.

    One row per stored row; equal streams have equal values, damaged ones their faults counted.
    """
    ship(stored.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = []
            for doc, n, media in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                raw = media.as_py()
                s = demux(raw)
                rows.append((doc, n, len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-BLOCK:]), len(raw), hashlib.sha256(raw).hexdigest(), feature(s)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in FEATURES.split(", ")])

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)
