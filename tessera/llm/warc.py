"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged files.

Records are gzip members of their own. The reader checks each member, its version line, its length and its block digest;
when a check fails it searches for the next gzip member or version line that begins a valid record, logs the bytes between
as a quarantined gap, and goes on.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import files
from tessera.llm.common import ship, shared_dir, written

VERSION = b"WARC/1.1"
#: Payloads of so many bytes are stored once.
LEAST_SHARED = 100
FILE_BYTES = 64 * 1024 * 1024
#: Bytes of a gzip member that are inflated at a time.
CHUNK = 64 * 1024
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, at long"
GAPS = "path string, start long, stop long, reason string"


def _head(fields: list[tuple[str, str]], first: bytes = VERSION) -> bytes:
    return first + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def _clean(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], b"HTTP/1.1 200 OK")
    block = http if is_revisit else http + payload
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", f"<{ID}{page_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", _clean(url))]
    if is_revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    fields += [
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _head(fields) + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


@dataclass
class Record:
    at: int
    fields: dict[str, str]
    block: bytes


@dataclass
class Gap:
    start: int
    stop: int
    reason: str


class Damaged(ValueError):
    """What is wrong with a record, and where it ends if that is known nevertheless."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def _wrong(digest: str | None, raw: bytes) -> bool:
    """Whether a labelled digest (sha1 or sha256, in hex or base32) is not that of `raw`; others are not known."""
    kind, _, value = (digest or "").partition(":")
    if kind.lower() not in ("sha1", "sha256"):
        return False
    own = hashlib.new(kind.lower(), raw)
    return value.lower() != own.hexdigest() and value.upper().rstrip("=") != base64.b32encode(own.digest()).decode().rstrip("=")


def _whole(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record at `at`, and where it ends."""
    if not raw.startswith(b"WARC/1.", at):
        raise Damaged("no version line")
    stop = raw.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("head without end")
    fields: dict[str, str] = {}
    for line in raw[at:stop].split(b"\r\n")[1:]:
        name, sep, value = line.partition(b":")
        if not sep:
            raise Damaged("bad head line")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    if not size.isdigit():
        raise Damaged("no length")
    begin = stop + 4
    end = begin + int(size)
    if raw[end : end + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    block = raw[begin:end]
    if _wrong(fields.get("warc-block-digest"), block):
        raise Damaged("wrong block digest", end + 4)
    if fields.get("warc-type") == "response" and "warc-payload-digest" in fields:
        http, _, payload = block.partition(b"\r\n\r\n")
        if not re.search(rb"(?i)\r\n(transfer|content)-encoding:", http) and _wrong(fields["warc-payload-digest"], payload):
            raise Damaged("wrong payload digest", end + 4)
    return fields, block, end + 4


def _inflated(raw: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What can be inflated of the gzip member at `at`, where it ends, and what is wrong with it."""
    z, parts, to = zlib.decompressobj(31), [], at
    while not z.eof and to < len(raw):
        piece = raw[to : to + CHUNK]
        before = z.copy()
        try:
            parts.append(z.decompress(piece))
        except zlib.error:
            for i in range(len(piece)):  # up to the byte that fails
                try:
                    parts.append(before.decompress(piece[i : i + 1]))
                except zlib.error:
                    break
            return b"".join(parts), to, "bad gzip member"
        to += CHUNK
    return b"".join(parts), min(to, len(raw)) - len(z.unused_data), None if z.eof else "cut gzip member"


_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_VERSION = re.compile(rb"WARC/1\.")


def _records_in(plain: bytes, at: int) -> tuple[list[Record], str | None]:
    """The records one after another in the bytes of a member that begins at `at`, and the first thing wrong between them."""
    out, place, reason = [], 0, None
    while place < len(plain):
        try:
            fields, block, place = _whole(plain, place)
            out.append(Record(at, fields, block))
            continue
        except Damaged as e:
            reason = reason or str(e)
            if e.end is not None:  # what its payload holds is no record of the archive
                place = e.end
                continue
        found = _VERSION.search(plain, place + 1)
        place = found.start() if found else len(plain)
    return out, reason


def _records_at(raw: bytes, at: int) -> tuple[list[Record], int | None, str | None]:
    """The records at `at`, where what holds them ends (None: not known), and what is wrong with it."""
    if raw.startswith(b"\x1f\x8b", at):
        plain, after, broken = _inflated(raw, at)
        out, reason = _records_in(plain, at)
        if not out:
            raise Damaged(broken or reason or "no record")
        return out, None if broken else after, broken or reason
    fields, block, end = _whole(raw, at)
    return [Record(at, fields, block)], end, None


def salvage(raw: bytes) -> Iterator[Record | Gap]:
    """All records that can be read, in order, and the gaps between them.

    Records of one gzip member begin where it does. Of a member with damage its sound records come first, then all its bytes as a
    gap; else gaps and records cover every byte once. A record whose digest is wrong but whose end is sound is a gap as a
    whole, with all that its payload holds.
    """
    at = 0
    while at < len(raw):
        try:
            found, after, reason = _records_at(raw, at)
        except Damaged as e:
            found, after, reason = [], e.end, str(e)
        yield from found
        start = at
        if after is not None:
            at = after
            if reason:
                yield Gap(start, at, reason)
            continue
        for m in _STARTS.finditer(raw, start + 1):
            try:
                others = _records_at(raw, m.start())[0]
            except Damaged:
                continue
            if m[0] == b"WARC/1." and any((x.fields, x.block) == (others[0].fields, others[0].block) for x in found):
                continue  # stands uncompressed in the member and is read already
            at = m.start()
            break
        else:
            at = len(raw)
        yield Gap(start, at, reason)


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty), digest, refers_to: the smallest page_id with an equal payload of at least LEAST_SHARED bytes.

    Digests meet without their pages: first the digests that occur twice, then the (page_id, digest) pairs that refer to
    another page, and only these go back to the pages, which are dealt by page. So equal pages, however many, do not meet in
    one task. A row that is itself the smallest, or a repeat of that row, is a response. Rows without page_id revisit the
    smallest one there is; if there is none they are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    narrow = written(rows.where(F.octet_length("html") >= LEAST_SHARED).select("page_id", "digest"), "digests")
    twice = narrow.groupBy(F.col("digest").alias("d")).agg(F.count(F.lit(1)).alias("many"), F.min("page_id").alias("first")).where("many > 1 and first is not null")
    others = narrow.join(twice, (F.col("digest") == F.col("d")) & ~F.col("page_id").eqNullSafe(F.col("first")))
    others = others.select(F.col("page_id").alias("p"), "d", F.col("first").alias("refers_to")).distinct()
    return rows.join(others, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left").drop("p", "d")


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives; returns their manifest (path, n_records, n_bytes). Each begins with a warcinfo record."""
    ship(pages.sparkSession)

    def put(batches: Iterator) -> Iterator:
        import uuid

        import pyarrow as pa

        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            name, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
            with files.writer(name) as out:
                info = b"software: tessera\r\nformat: WARC File Format 1.1\r\n"
                raw = member(
                    _head(
                        [
                            ("WARC-Type", "warcinfo"),
                            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                            ("WARC-Date", DATE),
                            ("Content-Type", "application/warc-fields"),
                            ("Content-Length", str(len(info))),
                        ]
                    ) + info + b"\r\n\r\n"
                )
                size += out.write(raw) or len(raw)
                while row is not None and size < FILE_BYTES:
                    page_id, url, html, digest, refers_to = row
                    raw = member(record(page_id, url, html.encode(), digest, refers_to, refers_to is not None))
                    out.write(raw)
                    size, n, row = size + len(raw), n + 1, next(rows, None)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "n_records", "n_bytes"])

    rows = planned(pages).select("page_id", "url", "html", "digest", "refers_to")
    return written(rows.mapInArrow(put, MANIFEST), "warc-manifest")


def _number(urn: str) -> int | None:
    tail = urn.strip("<>").removeprefix(ID)
    return int(tail) if re.fullmatch(r"-?\d+", tail) else None


def described(r: Record) -> tuple | None:
    """(page_id, payload bytes, digest, type, refers_to) of a response or revisit, from the stored bytes; None for other records."""
    kind = r.fields.get("warc-type")
    http, _, payload = r.block.partition(b"\r\n\r\n")
    page = _number(r.fields.get("warc-record-id", ""))
    if kind == "response":
        return page, len(payload), hashlib.sha256(payload).hexdigest(), kind, None
    size = re.search(rb"Content-Length: (\d+)", http)
    if kind != "revisit" or not size:
        return None
    return page, int(size[1]), r.fields.get("warc-payload-digest", "").partition(":")[2], kind, _number(r.fields.get("warc-refers-to", ""))


def _each_file(manifest: DataFrame, run, schema: str) -> DataFrame:
    ship(manifest.sparkSession)
    return manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(run, schema)


def read(manifest: DataFrame) -> DataFrame:
    """The response and revisit records of all files, salvaged; an empty manifest has none."""

    def get(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for x in salvage(files.read(path)):
                    if isinstance(x, Record) and (row := described(x)):
                        rows.append((*row, path, x.at))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in RECORDS.split(", ")])

    return _each_file(manifest, get, RECORDS)


def gaps(manifest: DataFrame) -> DataFrame:
    """The quarantined byte ranges of all files: path, start, stop, reason."""

    def get(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for path in b.column(0).to_pylist():
                rows = [(path, x.start, x.stop, x.reason) for x in salvage(files.read(path)) if isinstance(x, Gap)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["path", "start", "stop", "reason"])

    return _each_file(manifest, get, GAPS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes and reads: one row per row of pages, as often as it occurs. Null and empty payloads are responses of no bytes, a null
    page_id stays null, a page of any length is one record. An empty table has no rows; other columns are left out.
    """
    return read(write(pages, shared_dir(pages.sparkSession, "warc")))
