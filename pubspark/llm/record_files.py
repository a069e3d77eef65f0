"""Tokenized documents as length-delimited binary records, with a separate offset index.

A record is framed as: payload length (unsigned 64-bit), masked checksum of those 8 bytes,
payload, masked checksum of the payload; all little-endian. The checksum is CRC-32, rotated
right by 15 bits plus a constant, so that checksums of data that hold checksums stay sound. The
payload is a flag byte (1: no doc_id; 2: 32-bit ids), the doc_id, and the ids in 16 bits where
all fit, else 32.

Documents are range-partitioned and sorted by doc_id; each task streams its range into shard
files of bounded size and returns one index row per record (shard, offset, size, ids before it
in the shard), which Spark commits as a table. A retried task writes new files, and only files
that the committed index names are ever read. Any subset of records in any order can be read by
joining to the index.

Defined results: null text reads as empty and gives the end id alone; a null doc_id comes first;
repeated rows are written each, equal doc_ids in order of text hash and text; an empty table
gives an empty index; other columns play no part.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pubspark.llm.chunk_cache import slices
from pubspark.llm.common import as_batch, materialize, shared_folder, texts
from pubspark.llm.library_tokens import encoder, split_spaced

MASK_DELTA = 0xA282EAD8
NO_ID, WIDE = 1, 2
HEAD = struct.Struct("<QI")

INDEX = pa.schema([("part", pa.int32()), ("shard_no", pa.int32()), ("shard", pa.string()),
                   ("doc_id", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()),
                   ("n_tokens", pa.int64()), ("tokens_before", pa.int64())])
INDEX_DDL = ("part int, shard_no int, shard string, doc_id long, offset long, size long, "
             "n_tokens long, tokens_before long")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(record: bytes) -> bytes:
    """The payload; raises ValueError where a length or checksum is wrong."""
    if len(record) < 16:
        raise ValueError("truncated record")
    n, check = HEAD.unpack_from(record)
    if check != masked(record[:8]) or len(record) != n + 16:
        raise ValueError("bad record length")
    payload = record[12:12 + n]
    if struct.unpack_from("<I", record, 12 + n)[0] != masked(payload):
        raise ValueError("bad record checksum")
    return payload


def pack_sequence(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
    flags = (NO_ID if doc_id is None else 0) | (WIDE if wide else 0)
    return struct.pack("<Bq", flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def unpack_sequence(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=9).astype("<u4")
    return (None if flags & NO_ID else doc_id), ids


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The folder's file system and its path there (file, hdfs, s3, gs, abfs or a plain path)."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder[5:]
    return pa.fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                  shard_bytes: int = 64 << 20) -> DataFrame:
    """Write all documents under ``folder``; the committed index (see the module text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, split_spaced)
        part = TaskContext.get().partitionId()
        fs, root = file_system(folder)
        fs.create_dir(root)
        end = np.array([end_id], "<u4").tobytes()
        out, name, offset, tokens, shard_no = None, "", 0, 0, -1
        try:
            for b in batches:
                ids = (i + end for run_ in slices(texts(b)) for i in own.encode_all(run_))
                rows = []
                for doc_id, raw in zip(b.column("doc_id").to_pylist(), ids, strict=True):
                    record = frame(pack_sequence(doc_id, np.frombuffer(raw, "<u4")))
                    if out is None or offset and offset + len(record) > shard_bytes:
                        if out is not None:
                            out.close()
                        shard_no, offset, tokens = shard_no + 1, 0, 0
                        name = f"{part:06d}-{shard_no:04d}-{uuid.uuid4().hex}.rec"
                        out = fs.open_output_stream(f"{root}/{name}", buffer_size=1 << 20)
                    out.write(record)
                    rows.append((part, shard_no, name, doc_id, offset, len(record),
                                 len(raw) // 4, tokens))
                    offset += len(record)
                    tokens += len(raw) // 4
                if rows:
                    yield as_batch(zip(*rows, strict=True), INDEX)
        finally:
            if out is not None:
                out.close()

    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")  # so that even one doc_id's rows are dealt out
    ordered = keyed.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    return materialize(ordered.mapInArrow(run, INDEX_DDL), "record-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array<long>) of the records that ``index`` names."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _records(batches, folder):
            yield as_batch(zip(*[(d, i.astype(np.int64)) for _, d, i in found], strict=True), schema)

    return _by_shard(index).mapInArrow(run, "doc_id long, ids array<long>")


def _by_shard(index: DataFrame) -> DataFrame:
    return (index.select("shard", "offset", "size").repartition("shard")
            .sortWithinPartitions("shard", "offset"))


def _records(batches, folder: str) -> Iterator[list[tuple[str, int | None, np.ndarray]]]:
    """``(shard, doc_id, ids)`` of the index rows, checked, a list of bounded size at a time."""
    fs, root = file_system(folder)
    file, name = None, None
    for b in batches:
        found, size = [], 0
        for shard, offset, n in zip(*(b.column(c).to_pylist() for c in ("shard", "offset", "size")), strict=True):
            if shard != name:
                file, name = fs.open_input_file(f"{root}/{shard}"), shard
            file.seek(offset)
            found.append((shard, *unpack_sequence(unframe(file.read(n)))))
            size += n
            if size > 8 << 20:
                yield found
                found, size = [], 0
        if found:
            yield found


def digest_records(index: DataFrame, folder: str) -> DataFrame:
    """Read every record back: ``doc_id, start, n_tokens, ids_crc32`` in file order, ``start``
    counting the ids of all records before it."""
    schema = pa.schema([("shard", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, 0
        for found in _records(batches, folder):
            rows = []
            for shard, doc_id, ids in found:
                if shard != last:
                    last, at = shard, 0
                rows.append((shard, doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
                at += len(ids)
            yield as_batch(zip(*rows, strict=True), schema)

    read = _by_shard(index).mapInArrow(
        run, "shard string, doc_id long, at long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part", "shard_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = (index.groupBy("part", "shard_no", "shard").agg(F.sum("n_tokens").alias("n"))  # a row per file
             .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return read.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the documents to a new shared folder, then :func:`digest_records` of its files."""
    folder = shared_folder(docs.sparkSession, "records")
    return digest_records(write_records(docs, folder, tokenizer_path, end_id), folder)
