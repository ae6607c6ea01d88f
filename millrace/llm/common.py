"""Helpers that the corpus operators share: scratch folders, word splitting and token ids."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
from array import array
from collections.abc import Iterator
from operator import attrgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; everything else belongs to words.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"
WORDS = re.compile(WORD)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_own: str | None = None
_ID = attrgetter("id")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Where that is
    unset on one machine (tests), below a temporary folder; on a cluster that is an error."""
    global _own
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        _own = _own or tempfile.mkdtemp(prefix="millrace-")
        root = f"file://{_own}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, path: str) -> DataFrame:
    """df written to a shared folder and read back: lineage ends there, and a lost executor costs no recomputation."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: str, modulus: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices record batches so that a slice holds about `limit` bytes of a column, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)).astype("int64"))
        at = 0
        while at < b.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield b.slice(at, end - at)
            at = end


class TokenIds:
    """Ids of a BPE tokenizer of the tokenizers library, as little-endian 32-bit bytes, kept per chunk of text.

    A text is cut where one space stands between two characters that aren't white space: byte-level
    and word-end BPE both start a new pre-token there whatever else the text holds, so the ids of
    the chunks in a row are the ids of the text (tests compare both). A chunk of plain Latin letters,
    with a full stop or comma behind at most, is one pre-token and its mark, and goes straight to
    the tokenizer's model; any other chunk goes through the whole tokenizer. The first `most` chunks
    are kept, which bounds memory.

    Names of special tokens in a text are ordinary text, as the description of the vocabularies asks for
    (encode_special_tokens): a document can't forge the end of another by naming it.
    """

    CUT = re.compile(r"(?<=\S) (?=\S)")
    LATIN = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    LETTERS = re.compile(f"[A-Za-z{LATIN}]+")

    def __init__(self, path: str, most: int = 600_000):
        import json

        from tokenizers import Tokenizer

        self.tokenizer, self.even = Tokenizer.from_file(path), False
        self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        folds = json.loads(self.tokenizer.to_str())["normalizer"] is not None
        # Word-end models drop spaces and fold case; byte-level ones write a space as its byte symbol.
        self.lead, self.fold = ("", str.lower) if folds else ("\u0120", None)
        self.symbols = {ord(c): "".join(map(_symbol, c.encode())) for c in self.LATIN}
        self.mark = {m: self.ids(m) for m in ".,"}
        self.line = self.ids("\n")
        self.bare, self.spaced = _Chunks(self, "", most // 6), _Chunks(self, " ", most)

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, space: str, word: str) -> bytes:
        """Ids of a pre-token of Latin letters."""
        return array("I", map(_ID, self.tokenize((self.lead if space else "") + word.translate(self.symbols)))).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        head, *rest = text.split(" ")
        spaced = self.spaced
        if "" not in rest and head and not head[0].isspace():
            self.even = True
            try:
                return self.bare[head] + b"".join([spaced[r] for r in rest])
            except _Uneven:  # white space beside a single space: nothing of the kind is ever kept, so it shows
                pass
        self.even = False
        head, *rest = self.CUT.split(text)
        return self.bare[head] + b"".join([spaced[r] for r in rest])


class _Chunks(dict):
    """Ids of chunks that follow a space, or that follow none."""

    def __init__(self, of: TokenIds, space: str, most: int):
        super().__init__()
        self.of, self.space, self.most = of, space, most

    def __missing__(self, chunk: str) -> bytes:
        of = self.of
        mark = of.mark.get(chunk[-1:], b"")
        word = chunk[:-1] if mark else chunk
        if word.isalpha() and (word.isascii() or of.LETTERS.fullmatch(word)):
            if mark:
                ids = self[word] + mark
            elif of.fold and (low := of.fold(word)) != word:
                ids = self[low]
            else:
                ids = of.letters(self.space, word)
        elif chunk[-1:].isspace() or chunk[:1].isspace():
            if of.even:
                raise _Uneven
            return of.ids(self.space + chunk)
        elif "\n" in chunk and chunk.split() == chunk.split("\n"):
            head, *rest = chunk.split("\n")
            ids = self[head] + b"".join([of.line + of.bare[r] for r in rest])
        else:
            ids = of.ids(self.space + chunk)
        if len(self) < self.most and len(chunk) <= 64:
            self[chunk] = ids
        return ids


class _Uneven(Exception):
    pass


@functools.lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One for each path and Python worker, whichever tasks come and go."""
    return TokenIds(path)


def release() -> None:
    """Gives back what a Python process keeps of earlier stages: tokenizers with their chunks, and freed memory the C library still holds (glibc only)."""
    token_ids.cache_clear()
    gc.collect()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def _symbol(byte: int) -> str:
    """The printable character that byte-level BPE writes for a byte above 127: itself, but for those that don't print."""
    return chr(byte) if byte >= 0xAE or 0xA1 <= byte <= 0xAC else chr(0x100 + (byte - 0x7F + 33 if byte <= 0xA0 else 67))
