"""Token ids as length-delimited binary records.

A shard file holds one record per document, each framed as

    length of payload, u64 | masked crc32 of those 8 bytes, u32 | payload | masked crc32 of the payload, u32

all little-endian. The payload is a header (i64 doc_id, u8 1 if the doc_id is null, u8 bytes per id) and
the ids. Masking rotates the checksum by 15 bits and adds a constant, so that checksums of data which
hold checksums stay useful. Beside each shard `part-N.rec` stands `part-N.idx`: for each record its
offset and its frame's length, 2 x u64, so that a reader in shuffled order can seek. Checksums are zlib's
CRC-32, which Python computes at memory speed.

Shards are written by the tasks themselves to a folder that all executors reach (any file system that
pyarrow.fs opens), under a name of the attempt first and then moved, so a task that runs again after an
executor is lost leaves the same file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import rows, scratch, small_batches, stored, token_ids

HEAD = "<qBB"
HEAD_SIZE = struct.calcsize(HEAD)
#: Added to a rotated checksum (fixed value of the masking).
MASK_DELTA = 0xA282EAD8

MANIFEST = "shard long, documents long, ids long, file string, index string"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc_id: int | None, ids: bytes) -> bytes:
    """ids: little-endian u32. Ids below 65536 are kept in two bytes each."""
    wide = np.frombuffer(ids, "<u4")
    width = 2 if not len(wide) or wide.max() < 65536 else 4
    return struct.pack(HEAD, doc_id or 0, doc_id is None, width) + (wide.astype("<u2").tobytes() if width == 2 else ids)


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = struct.unpack_from(HEAD, payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=HEAD_SIZE).astype("<u4")


def unframed(data: memoryview, at: int, where: str) -> tuple[bytes, int]:
    """The payload of the record at an offset, both checksums tested, and the offset behind it."""
    size = bytes(data[at : at + 8])
    if len(size) < 8 or struct.unpack("<I", data[at + 8 : at + 12])[0] != masked(size):
        raise ValueError(f"{where}: the length at byte {at} is damaged")
    n = struct.unpack("<Q", size)[0]
    payload = bytes(data[at + 12 : at + 12 + n])
    if len(payload) < n or struct.unpack("<I", data[at + 12 + n : at + 16 + n])[0] != masked(payload):
        raise ValueError(f"{where}: the record at byte {at} is damaged")
    return payload, at + 16 + n


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int, shards: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encodes documents and writes them in ascending order of (doc_id, text) as shard files below `path`.

    docs needs doc_id (integer) and text; other columns are ignored. A null text is empty, a null doc_id
    comes first, repeated rows stay. An empty table writes no shard. Returns the manifest, which is also
    kept as Parquet in `path`/manifest: a row per shard with its number of documents and ids.
    """
    spark = docs.sparkSession

    shards = shards or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, folder = _opened(path)
        system.create_dir(folder, recursive=True)
        shard, tag = TaskContext.get().partitionId(), uuid.uuid4().hex
        ids, end = token_ids(tokenizer), struct.pack("<I", end_id)
        name, at, n, total = f"{folder}/part-{shard:06d}", 0, 0, 0
        out = index = None
        for b in small_batches(batches, "text", 4 << 20):
            if out is None:
                out, index = (system.open_output_stream(f"{folder}/_{tag}.{x}") for x in ("rec", "idx"))
            frames = []
            for key, t in rows(b, "doc_id", "text"):
                got = ids.encode(t) + end
                frames.append(frame(payload_of(key, got)))
                index.write(struct.pack("<QQ", at, len(frames[-1])))
                at, n, total = at + len(frames[-1]), n + 1, total + len(got) // 4
            out.write(b"".join(frames))
        if out is not None:
            for x, f in (("rec", out), ("idx", index)):
                f.close()
                if system.get_file_info(f"{name}.{x}").type != fs.FileType.NotFound:
                    system.delete_file(f"{name}.{x}")
                system.move(f"{folder}/_{tag}.{x}", f"{name}.{x}")
            yield pa.RecordBatch.from_pylist([{"shard": shard, "documents": n, "ids": total, "file": f"part-{shard:06d}.rec", "index": f"part-{shard:06d}.idx"}])

    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write, MANIFEST), f"{path}/manifest")


def read_records(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """The records of all shards, every checksum tested: shard, doc_id, place (in its shard), start (ids of
    all records before it), ids (array of long). With a seed, records within a shard come in a shuffled
    order by way of the offset index."""
    out = "shard long, doc_id long, place long, start long, ids array<long>"
    return _scan(spark, path, out, seed, lambda key, ids: {"ids": pd.Series([x.astype("int64") for x in ids])})


def record_digests(spark: SparkSession, path: str) -> DataFrame:
    """As read_records, with n_tokens and ids_crc32 (of the ids as little-endian u32) in place of the ids."""
    out = "shard long, doc_id long, place long, start long, n_tokens long, ids_crc32 long"
    return _scan(spark, path, out, None, lambda key, ids: {"n_tokens": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids]})


def _scan(spark: SparkSession, path: str, schema: str, seed: int | None, make) -> DataFrame:
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard file
    shards = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    names = [c.split()[0] for c in schema.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _opened(path)
        for f in frames:
            for s in f.itertuples():
                yield from shard(system, folder, s)

    def shard(system, folder, s) -> Iterator[pd.DataFrame]:
        with system.open_input_file(f"{folder}/{s.index}") as f:
            index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype("int64")
        order = np.arange(len(index)) if seed is None else np.random.default_rng([seed, s.shard]).permutation(len(index))
        starts = np.zeros(len(index), "int64") if seed is not None else None
        with system.open_input_file(f"{folder}/{s.file}") as f:
            if seed is not None:  # the ids before a record follow from the index: two bytes each, or four
                starts = _starts(f, index)
            ids_before, got, size = s.base, [], 0
            for i in order:
                f.seek(int(index[i, 0]))
                payload, _ = unframed(memoryview(f.read(int(index[i, 1]))), 0, f"{folder}/{s.file}, record {i}")
                key, ids = parsed(payload)
                got.append((key, int(i), ids_before if seed is None else s.base + int(starts[i]), ids))
                ids_before, size = ids_before + len(ids), size + len(ids)
                if size > 1_000_000:
                    yield table_of(s.shard, got)
                    got, size = [], 0
            if got:
                yield table_of(s.shard, got)

    def _starts(f, index: np.ndarray) -> np.ndarray:
        n = []
        for at, length in index:
            f.seek(int(at) + 12 + HEAD_SIZE - 1)
            n.append((int(length) - 16 - HEAD_SIZE) // f.read(1)[0])
        return np.concatenate([[0], np.cumsum(n)[:-1]]).astype("int64")

    def table_of(number: int, got: list[tuple]) -> pd.DataFrame:
        keys = pd.array([g[0] for g in got], "Int64")
        return pd.DataFrame({"shard": number, "doc_id": keys, "place": [g[1] for g in got], "start": [g[2] for g in got]} | make(keys, [g[3] for g in got]))[names]

    return shards.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard").mapInPandas(read, schema)


def encoded_digests(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes documents as records to a shared folder and returns the digests read back from the files."""
    path = scratch(docs.sparkSession, "records")
    write_records(docs, path, tokenizer, end_id)
    return record_digests(docs.sparkSession, path).select("doc_id", "start", "n_tokens", "ids_crc32", "shard")
