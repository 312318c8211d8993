"""Token ids as length-delimited binary records, with an offset index.

Documents are range-partitioned and sorted by doc_id; each task tokenises its documents and writes
one data file and one index file into the shared folder.

Data file: one record after the other, each framed as

    u64 length | u32 masked CRC-32 of the length's 8 bytes | payload | u32 masked CRC-32 of the payload

little-endian, with ``masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2**32``. Payload: one byte
(1 if the document has an id), one byte with the width of a token id, the id as i64, then the token
ids: two bytes each if all of the record's ids are below 65,536, else four. Index file: the u64 offset
of every record. Files of an attempt have names of their own; the manifest (written by Spark when
all tasks have ended) names the files that count, so a repeated or lost task leaves only files that
nobody reads.

Defined edge cases: null text counts as empty (one id, the end id); null doc_ids come first;
documents of equal doc_id are ordered by a hash of their text; an empty table gives no files and an
empty result; extra columns are ignored. A broken frame raises ``ValueError``.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import slices, text_or_empty, width
from .tokens import encoder

MASK_DELTA = 0xA282EAD8
MANIFEST = "part int, data string, index string, records bigint, ids bigint"
READ_BYTES = 4 << 20


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def read_frame(stream) -> bytes | None:
    """The next record's payload, None at the end of the file."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked_crc(head[:8]):
        raise ValueError("a record's length is damaged")
    payload, tail = stream.read(n := struct.unpack("<Q", head[:8])[0]), stream.read(4)
    if len(payload) < n or len(tail) < 4 or struct.unpack("<I", tail)[0] != masked_crc(payload):
        raise ValueError("a record's payload is damaged")
    return payload


def pack_payload(doc_id: int | None, ids: bytes) -> bytes:
    """``ids``: little-endian 32-bit ids."""
    wide = np.frombuffer(ids, "<u4")
    narrow = not len(wide) or int(wide.max()) < 1 << 16
    return struct.pack("<BBq", doc_id is not None, 2 if narrow else 4, doc_id or 0) + (
        wide.astype("<u2").tobytes() if narrow else ids)


def unpack_payload(payload: bytes) -> tuple[int | None, bytes]:
    """The document's id and its token ids (little-endian, 32 bits)."""
    has, size, doc_id = struct.unpack_from("<BBq", payload)
    ids = payload[10:]
    return (doc_id if has else None), (np.frombuffer(ids, "<u2").astype("<u4").tobytes() if size == 2 else ids)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str, partitions: int | None = None) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and write data and index files to ``folder``: the manifest.

    The manifest has one row per file pair, ``part`` counting up in ascending doc_id order.
    """
    spark, end = docs.sparkSession, struct.pack("<I", end_id)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.repartitionByRange(partitions or width(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(tokenizer, False), TaskContext.get().partitionId()
        store, base = _store(folder)
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        data = index = None
        at = records = ids = 0
        for batch in slices(batches, "text", 2 << 20):
            if data is None:
                store.create_dir(base)
                data = store.open_output_stream(f"{base}/{name}.rec", buffer_size=1 << 20)
                index = store.open_output_stream(f"{base}/{name}.idx", buffer_size=1 << 16)
            for doc_id, got in zip(batch.column("doc_id").to_pylist(), words.encode(batch.column("text").to_pylist()),
                                   strict=True):
                record = frame(pack_payload(doc_id, got + end))
                data.write(record)
                index.write(struct.pack("<Q", at))
                at, records, ids = at + len(record), records + 1, ids + len(got) // 4 + 1
        words.forget()
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "data": [f"{name}.rec"],
                                              "index": [f"{name}.idx"], "records": [records], "ids": [ids]})

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Read the data files back in order: doc_id, start, n_tokens, ids_crc32."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # one row per file: the ids in all earlier files
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "data", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("start"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for file in batch.to_pylist():
                start, rows = file["start"], []
                with store.open_input_stream(f"{base}/{file['data']}", buffer_size=READ_BYTES) as stream:
                    while (payload := read_frame(stream)) is not None:
                        doc_id, ids = unpack_payload(payload)
                        rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
                        start += len(ids) // 4
                        if len(rows) == 10_000:
                            yield _batch(rows, schema)
                            rows = []
                if rows:
                    yield _batch(rows, schema)

    return files.repartition(width(spark), "part").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, "
                                                                    "ids_crc32 bigint")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types,
                                                                      strict=True)], schema=schema)


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """Records in a random order fixed by ``seed``: position, doc_id, ids (array of ids).

    The index files give every record's offset; records are dealt by a random key and fetched by
    offset, so no data file is read as a whole.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for file in batch.to_pylist():
                with store.open_input_stream(f"{base}/{file['index']}") as stream:
                    at = np.frombuffer(stream.read(), dtype="<u8").astype("int64")
                yield pa.RecordBatch.from_pydict({"data": [file["data"]] * len(at), "offset": at})

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        opened: dict = {}
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["data"] not in opened:
                    opened[row["data"]] = store.open_input_file(f"{base}/{row['data']}")
                opened[row["data"]].seek(row["offset"])
                doc_id, ids = unpack_payload(read_frame(opened[row["data"]]))
                found.append((row["position"], doc_id, np.frombuffer(ids, dtype="<u4").astype("int64")))
            if found:
                yield pa.RecordBatch.from_pydict({"position": pa.array([f[0] for f in found], pa.int64()),
                                                  "doc_id": pa.array([f[1] for f in found], pa.int64()),
                                                  "ids": pa.array([f[2] for f in found], pa.list_(pa.int64()))})

    parts = width(spark)
    dealt = (manifest.repartition(parts, "part").mapInArrow(offsets, "data string, offset bigint")
             .withColumn("position", F.xxhash64("data", "offset", F.lit(seed)))
             .repartitionByRange(parts, "position", "offset").sortWithinPartitions("position", "offset"))
    return dealt.mapInArrow(fetch, "position bigint, doc_id bigint, ids array<bigint>")


def digest(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the records of all documents and return what the files hold, per document."""
    folder = scratch_path(docs.sparkSession, "token-records")
    write_records(docs, tokenizer, end_id, folder)
    return read_records(docs.sparkSession, folder)
