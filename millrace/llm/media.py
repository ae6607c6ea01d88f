"""Media columns: bytes kept losslessly as the coefficients of progressive JPEG files, and RGB tensors read from them.

A payload is cut into blocks of 64 bytes; a byte b is the coefficient b + 2 of its block, so no coefficient
vanishes when the scans' lowest bit is held back. Six blocks make an MCU: four of luma, one of each chroma.
The file's comment has the payload's length. Reading a file back accumulates all its scans into coefficient
arrays, from which the payload follows, and the picture by inverse transform.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import jpeg
from millrace.llm.common import small_batches

UNIT = 192
WIDEST = 4095  # MCUs in a row: 65,520 pixels


def padded(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + b" " * (-len(data) % UNIT if data else UNIT)


def _places(across: int, down: int) -> list[np.ndarray]:
    """For each component, the number in the payload of each block in raster order."""
    out, before = [], 0
    for h, v in jpeg.SAMPLING:
        y, x = np.divmod(np.arange(across * h * down * v), across * h)
        out.append(((y // v) * across + x // h) * 6 + before + (y % v) * h + x % h)
        before += h * v
    return out


def to_files(payloads: list[bytes]) -> list[bytes]:
    grids, parts = [], [[], [], []]
    for p in payloads:
        mcus = -(-len(p) // 384)
        across = min(mcus, WIDEST)
        down = -(-mcus // across)
        grids.append((across, down))
        x = np.zeros((6 * across * down, 64), np.int64)
        x[: len(p) // 64] = np.frombuffer(p, np.uint8).reshape(-1, 64).astype(np.int64) + 2
        for part, place in zip(parts, _places(across, down), strict=True):
            part.append(x[place])
    return jpeg.encode([np.concatenate(p) for p in parts], np.array(grids), [f"payload {len(p)}".encode() for p in payloads])


def from_files(files: list[bytes]) -> tuple[list[bytes], list[jpeg.Frame], list[list[np.ndarray]]]:
    """Payloads, frames and coefficients as the files hold them."""
    frames, coefficients = jpeg.decode(files)
    out = []
    for f, c in zip(frames, coefficients, strict=True):
        x = np.zeros((sum(len(b) for b in c), 64), np.int32)
        for place, b in zip(_places(*f.mcus), c, strict=True):
            x[place] = b
        out.append((x.reshape(-1)[: int(f.comment.split()[1])] - 2).astype(np.uint8).tobytes())
    return out, frames, coefficients


def encode_column(docs: DataFrame, text: str = "text", into: str = "media") -> DataFrame:
    """All columns of docs and a binary column of files. A null text counts as empty; an empty one is 192 blanks."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    slim = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)], F.coalesce(F.col(text), F.lit("")).alias("source_text"))
    schema = ", ".join(f"{n} {t}" for n, (_, t) in zip([*names, "media"], [*docs.dtypes, ("", "binary")], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "source_text", 1 << 19):
            files = to_files([padded(t) for t in b.column("source_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(files, pa.binary())], [*names, "media"])

    return slim.mapInArrow(run, schema).toDF(*docs.columns, into)


def decode_column(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """key, payload, height, width, rgb (rows of pixels of 3 bytes): of each file. A null file gives nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "media", 1 << 19):
            files = b.column("media").to_pylist()
            there = [f for f in files if f is not None]
            got = zip(*from_files(there), strict=True) if there else iter(())
            cells = [(p, f.height, f.width, jpeg.rgb(f, c).tobytes()) for p, f, c in got]
            it = iter(cells)
            full = [next(it) if f is not None else (None,) * 4 for f in files]
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("key"), *(pa.array([r[i] for r in full], k) for i, k in enumerate(kinds))], ["key", "payload", "height", "width", "rgb"])

    slim = media.select(F.col(key).alias("key"), F.col(column).alias("media"))
    return slim.mapInArrow(run, f"key {dict(slim.dtypes)['key']}, payload binary, height int, width int, rgb binary").withColumnRenamed("key", key)


def feature(pixels: np.ndarray) -> str:
    """Size of the tensor, mean and spread of its channels."""
    flat = pixels.reshape(-1, 3)
    n, s, q = len(flat), flat.sum(0, dtype=np.int64), np.einsum("ij,ij->j", flat.astype(np.int64), flat.astype(np.int64))
    mean = s / n
    return f"{pixels.shape[0]}x{pixels.shape[1]} mean {','.join(f'{m:.4f}' for m in mean)} spread {','.join(f'{d:.4f}' for d in np.sqrt(np.maximum(q / n - mean**2, 0)))}"


def media_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Stores each text as a file in a column and returns digests of what is read back from it, a row per document."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    held = encode_column(slim).select("doc_id", "n_bytes", "media")
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "media", 1 << 19):
            files = b.column("media").to_pylist()
            payloads, frames, coefficients = from_files(files)
            cells = [
                (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature(jpeg.rgb(f, c)))
                for p, m, f, c in zip(payloads, files, frames, coefficients, strict=True)
            ]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array([r[i] for r in cells], k) for i, k in enumerate(kinds))], names)

    return held.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
