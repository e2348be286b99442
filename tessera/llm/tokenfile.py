"""Token-id files: documents compressed one by one with a shared zstandard dictionary.

A file holds, one after another: MAGIC; the 32-byte SHA-256 of the dictionary; a frame for each document; the index; its
place. An id is an unsigned 16-bit little-endian number where the vocabulary allows, else 32-bit (`width` in the header).
The index has a fixed-size entry per document (has id, doc_id, place and size of the frame, ids), so that one
document is read with two short reads. The dictionary lies beside the files under its hash.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import files
from tessera.llm.common import first_by_hash, ship, shared_dir, written
from tessera.llm.tokens import default_path, encoder

MAGIC = b"TOKZST1\n"
END_ID = 2
#: The dictionary's size, and the bounded sample it is trained on: so many documents, so many bytes of each.
DICTIONARY, SAMPLE_DOCS, SAMPLE_BYTES = 64 * 1024, 1000, 16 * 1024
LEVEL = 3
#: A task begins another file when one holds so many bytes, or so many documents.
FILE_BYTES, FILE_DOCS = 128 * 1024 * 1024, 1_000_000
#: An entry of the index; without gaps.
ENTRY = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("at", "<u8"), ("size", "<u4"), ("n", "<u4")])
FOOTER = struct.Struct("<QQ8s")
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long, n_bytes long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long, path string"


def serialized(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids


def dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary trained on serialized id arrays; too few or too small ones are taken as they are, none gives an empty one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _zdict(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


class FileWriter:
    def __init__(self, out, raw_dictionary: bytes, width: int):
        import zstandard

        self.out, self.width, self.index, self.n_docs, self.n_ids = out, width, bytearray(), 0, 0
        self.at = out.write(MAGIC + hashlib.sha256(raw_dictionary).digest() + bytes([width])) or len(MAGIC) + 33
        self.zip = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(raw_dictionary))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.zip.compress(serialized(ids, self.width))
        self.out.write(frame)
        self.index += np.array((doc_id is not None, doc_id or 0, self.at, len(frame), len(ids) // 4), ENTRY).tobytes()
        self.at += len(frame)
        self.n_docs += 1
        self.n_ids += len(ids) // 4

    def close(self) -> None:
        self.out.write(bytes(self.index))
        self.out.write(FOOTER.pack(self.at, self.n_docs, MAGIC))


class FileReader:
    """Reads documents of one file by their position; refuses a dictionary other than the file's."""

    def __init__(self, stream, raw_dictionary: bytes):
        import zstandard

        self.f = stream
        stream.seek(0)
        head = stream.read(len(MAGIC) + 33)
        if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) : -1] != hashlib.sha256(raw_dictionary).digest():
            raise ValueError("not a token file of this dictionary")
        self.width = head[-1]
        stream.seek(stream.size() - FOOTER.size)
        at, n, magic = FOOTER.unpack(stream.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("the file has no end")
        stream.seek(at)
        self.index = np.frombuffer(stream.read(n * ENTRY.itemsize), ENTRY)
        self.unzip = zstandard.ZstdDecompressor(dict_data=_zdict(raw_dictionary))

    def ids(self, k: int) -> np.ndarray:
        _, _, at, size, n = self.index[k].item()
        self.f.seek(at)
        raw = self.unzip.decompress(self.f.read(size), max_output_size=max(1, n * self.width))
        out = np.frombuffer(raw, f"<u{self.width}").astype("<u4")
        if len(out) != n:
            raise ValueError("a document has another length than its index says")
        return out


def dictionary_path(folder: str, digest: str) -> str:
    return f"{folder}/dictionary-{digest}.zdict"


def _sample(docs: DataFrame, path: str, width: int) -> list[bytes]:
    """The heads of at most SAMPLE_DOCS serialized documents: of the doc_ids first by hash, each with its text first by hash.

    Ids are chosen on the narrow column; only the texts of those that are chosen are moved.
    """

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([serialized(encoder(path)(t or ""), width)[:SAMPLE_BYTES] for t in b.column(0).to_pylist()], pa.binary())], names=["ids"])

    chosen = F.broadcast(first_by_hash(docs.select(F.col("doc_id").alias("_id")).distinct(), "_id", SAMPLE_DOCS))
    texts = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    some = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    some = some.orderBy("doc_id").select("first.text").coalesce(4)
    return [bytes(r["ids"]) for r in some.mapInArrow(encode, "ids binary").collect() if r["ids"]]


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the ids of docs (doc_id, text; null text: empty) and `end_id` after each, in ascending doc_id order (null first).

    Returns the manifest: one row per file, in the order of (part, seq), with path, n_docs, n_ids, n_bytes. Documents go
    to tasks by ranges of doc_id (ties by the text's checksum); repeated rows are written as often as they occur.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or default_path()
    width = 2 if encoder(path).tok.get_vocab_size() <= 1 << 16 else 4
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    raw = dictionary(_sample(docs, path, width))
    digest = hashlib.sha256(raw).hexdigest()
    with files.writer(dictionary_path(folder, digest)) as f:
        f.write(raw)
    tie = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    docs = docs.withColumn("_tie", tie).repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")

    def put(batches: Iterator) -> Iterator:
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        part, encode, end, seq = TaskContext.get().partitionId(), encoder(path), end_id.to_bytes(4, "little"), 0
        rows = ((d, t) for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        row = next(rows, None)
        while row is not None:
            name = f"{folder}/part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tok"
            with files.writer(name) as out:
                w = FileWriter(out, raw, width)
                while row is not None and w.at < FILE_BYTES and w.n_docs < FILE_DOCS:
                    w.add(row[0], encode(row[1] or "") + end)
                    row = next(rows, None)
                w.close()
            values = [part, seq, name, w.n_docs, w.n_ids, w.at]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["part", "seq", "path", "n_docs", "n_ids", "n_bytes"])
            seq += 1

    return written(docs.mapInArrow(put, MANIFEST), "tokens-manifest").withColumn("dictionary", F.lit(dictionary_path(folder, digest)))


def read(manifest: DataFrame) -> DataFrame:
    """Reads every file of a manifest back: doc_id, start (ids of all documents before), n_tokens, ids_crc32, path.

    Documents are read one by one, whatever their length; an empty manifest has no rows.
    """
    ship(manifest.sparkSession)
    before = Window.partitionBy(F.lit(1)).orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    listed = manifest.select("path", "dictionary", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("base"))
    n = max(1, manifest.count())

    def get(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        kept: dict[str, bytes] = {}
        for batch in batches:
            for path, where, base in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if where not in kept:
                    kept[where] = files.read(where)
                with files.opened(path) as f:
                    r = FileReader(f, kept[where])
                    for k in range(0, len(r.index), 2000):
                        rows = []
                        for j in range(k, min(k + 2000, len(r.index))):
                            ids = r.ids(j)
                            has_id, doc_id = r.index[j].item()[:2]
                            rows.append((doc_id if has_id else None, base, len(ids), zlib.crc32(ids.tobytes())))
                            base += len(ids)
                        cols = list(zip(*rows, strict=True))
                        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols], pa.array([path] * len(rows))], names=["doc_id", "start", "n_tokens", "ids_crc32", "path"])

    return listed.repartition(n).mapInArrow(get, READ)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes and reads: one row per row of docs, as many times as it occurs. A null or empty text has the end id alone, a null
    doc_id stays null and comes first; texts of any length are one frame; an empty table has no rows; other columns are left out.
    """
    return read(write(docs, shared_dir(docs.sparkSession, "tokens"), path))
