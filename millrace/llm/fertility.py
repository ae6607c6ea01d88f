"""Quality by tokeniser fertility: how well public vocabularies tell a text.

Two vocabularies cut every word by itself: BPE with byte fallback and byte-level BPE. A text's measures are characters
per token of each, the share of tokens that are single fallback bytes, and the entropy of tokens in blocks of 64, as a
share of the greatest possible. Over all documents of a language (of a script, where no language is given) medians and
quartiles of these are counted, and a text outside the band around the median is rejected. Beside it stand four
plain counts of words, symbols, lines and repeated runs of words, and a base rule over them.

Words are encoded once for each task and batch of documents; texts leave tasks as a row of numbers each.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import scratch, small_batches, stored, text_of
from millrace.llm.words import mixed, run_hashes, row_of

#: Characters of a word that are encoded together; longer words are measured in pieces of this length.
UNIT = 64
#: Tokens of a block whose entropy is measured.
BLOCK = 64
#: Words that are kept between batches; more start an empty table, which changes no result.
MOST = 800_000
#: Bytes of text measured at once.
HELD = 4 << 20
#: Steps to which a measure is rounded before its quartiles are counted, which bounds the values of a language.
STEPS = 1000

#: Which code points make a script, by the first of each range (fixed values: blocks of the Unicode standard).
SCRIPTS = {0x41: "latin", 0x370: "greek", 0x400: "cyrillic", 0x530: "other", 0x590: "hebrew", 0x600: "arabic", 0x780: "other", 0x900: "devanagari", 0x980: "other", 0xE00: "thai", 0xE80: "other", 0x1E00: "latin", 0x1F00: "greek", 0x2000: "other", 0x3040: "kana", 0x3100: "other", 0x3400: "han", 0xA000: "other", 0xAC00: "hangul", 0xD7B0: "other", 0xF900: "han", 0xFB00: "other"}

#: Measures: how far below and above the median a text can stand, in spreads, and the least spread that a band has.
BANDS = {"chars_a": (4.0, 4.0, 0.06), "chars_b": (4.0, 4.0, 0.06), "fallback": (None, 4.0, 0.02), "entropy": (4.0, None, 0.02)}
#: Bands widen as sqrt(1 + SHORT / tokens), for measures of short texts vary more.
SHORT = 150

MEASURED = "doc_id long, speech string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, tokens_a long, tokens_b long, chars_a double, chars_b double, fallback double, entropy double"

_space = np.zeros(256, bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_symbol = np.zeros(256, bool)
_symbol[list(b"#*$%&|<>")] = True


class Vocabularies:
    """Tokens of words by two vocabularies, word by word in a table that grows with new words."""

    def __init__(self, pieces: str, ranks: str, pattern: str):
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytelevel = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.single = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.ids, self.starts, self.level = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The row of each word in the table."""
        at = self.at
        if missing := list(set(words).difference(at)):
            if len(at) + len(missing) > MOST and at:
                self.clear()
                return self.places(words)
            units = b"\n".join(missing).decode("utf-8", "replace").split("\n")
            chars = np.fromiter(map(len, units), np.int32, len(units))
            edges = np.concatenate([[0], np.cumsum((chars + UNIT - 1) // UNIT)])
            if edges[-1] > len(units):
                units = [u[i : i + UNIT] for u in units for i in range(0, len(u), UNIT)]
            encoded = self.pieces.encode(units, num_threads=1)
            encode = self.bytelevel.encode_ordinary
            level = np.fromiter((len(encode(f" {u}")) for u in units), np.int32, len(units))
            sizes = np.fromiter(map(len, encoded), np.int64, len(units))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(encoded), np.int32, int(sizes.sum()))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.add.reduceat(sizes, edges[:-1]))])
            self.level = np.concatenate([self.level, np.add.reduceat(level, edges[:-1])])
            at.update(zip(missing, range(len(at), len(at) + len(missing)), strict=True))
        return np.fromiter(map(at.__getitem__, words), np.int64, len(words))

    def tokens(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and where each word's begin (one entry more than words)."""
        sizes = self.starts[places + 1] - self.starts[places]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.repeat(self.starts[places] - edges[:-1], sizes) + np.arange(edges[-1])], edges


@functools.lru_cache(maxsize=1)
def vocabularies(pieces: str, ranks: str, pattern: str) -> Vocabularies:
    return Vocabularies(pieces, ranks, pattern)


def script(text: str) -> str:
    """The script of most letters of a text, the first in SCRIPTS of equal ones; 'none' without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    letters = points[(points >= 0x80) | ((points | 32) >= 0x61) & ((points | 32) <= 0x7A)]
    if not len(letters):
        return "none"
    names = list(dict.fromkeys(SCRIPTS.values()))
    kind = np.array([names.index(x) for x in SCRIPTS.values()])
    of = kind[np.maximum(np.searchsorted(list(SCRIPTS), letters, side="right") - 1, 0)]
    return names[int(np.bincount(of, minlength=len(names)).argmax())]


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the values between edges."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[edges])


def repeated_words(words: np.ndarray, edges: np.ndarray, width: int = 5) -> np.ndarray:
    """Of each text, the words in windows of `width` that stand in it twice or more. words: a number for each, equal for equal words."""
    n = len(words)
    if n < width:
        return np.zeros(len(edges) - 1, np.int64)
    text = row_of(edges)
    start = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
    h = mixed(run_hashes(mixed(words.astype(np.uint64) + np.uint64(1)), width)[start] + mixed(text[start].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(h, kind="stable")
    near = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    a, b = start[order[near]], start[order[near + 1]]
    same = text[a] == text[b]
    for j in range(width):  # equal hashes are compared word by word
        same &= words[a + j] == words[b + j]
    mark = np.zeros(n + 1, np.int64)
    twice = np.union1d(a[same], b[same])
    mark[twice] += 1
    np.add.at(mark, twice + width, -1)
    return _sums(np.cumsum(mark)[:-1] > 0, edges)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def block_entropy(ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Mean entropy of each text's blocks of BLOCK tokens over that of as many different tokens, weighed by tokens; 1 without two tokens."""
    text = row_of(edges)
    block = (np.arange(len(ids)) - edges[text]) // BLOCK
    first = np.concatenate([[0], np.cumsum((np.diff(edges) + BLOCK - 1) // BLOCK)])
    block += first[text]
    size = np.bincount(block, minlength=first[-1])
    packed = np.sort(block * (1 << 20) + ids)
    run = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else np.zeros(0, np.int64)
    count = np.diff(np.append(run, len(packed)))
    bits = np.bincount(packed[run] >> 20, weights=count * np.log2(count), minlength=first[-1])
    most = np.log2(np.maximum(size, 2))
    share = np.where(size > 1, (np.log2(np.maximum(size, 1)) - bits / np.maximum(size, 1)) / most, 1.0)
    sizes = np.diff(edges)
    return np.where(sizes > 1, np.round(_sums(share * size, first) / np.maximum(sizes, 1), 9), 1.0)


def measured(texts: list[bytes], known: Vocabularies) -> dict[str, np.ndarray]:
    """Counts and measures of texts; those of MEASURED but for doc_id and speech."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    split = [t.split() for t in texts]
    edges = np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)
    words = known.places([w for s in split for w in s])
    ids, starts = known.tokens(words)
    chars, tokens, level = _sums(((data & 0xC0) != 0x80) & ~_space[data], at), np.diff(starts[edges]), _sums(known.level[words], edges)
    out = {"n_words": np.diff(edges), "word_chars": chars, "n_symbols": _sums(_symbol[data], at), "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64), "n_repeat_words": repeated_words(words, edges), "tokens_a": tokens, "tokens_b": level}
    out["chars_a"], out["chars_b"] = (np.log(np.maximum(chars, 1) / np.maximum(n, 1)) for n in (tokens, level))
    return out | {"fallback": _sums(known.single[ids], starts[edges]) / np.maximum(tokens, 1), "entropy": block_entropy(ids, starts[edges])}


def fertility(docs: DataFrame, pieces: str, ranks: str, pattern: str, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """MEASURED: a row per document. chars_a, chars_b are natural logarithms of characters per token.

    A null text is empty and has 0 words and tokens. speech is the language, or where that is null or empty
    'script:' and the script of most letters. Repeated rows and null doc_ids stay as they are; further columns are
    ignored; an empty table gives no rows.
    """
    names = [c.split()[0] for c in MEASURED.split(", ")]
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in MEASURED.split(", ")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(pieces, ranks, pattern)
        for b in small_batches(batches, "text", HELD):
            texts = b.column("text").cast(pa.large_binary()).to_pylist()
            speech = [s or "script:" + script(t.decode("utf-8", "replace")) for s, t in zip(b.column("lang").to_pylist(), texts, strict=True)]
            got = {"doc_id": b.column("doc_id"), "speech": speech} | measured(texts, known)
            yield pa.RecordBatch.from_arrays([pa.array(got[n], schema.field(n).type) for n in names], schema=schema)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), text_of(text).alias("text"))
    return source.mapInArrow(measure, MEASURED)


def bands(rows: DataFrame, widths: dict = BANDS) -> DataFrame:
    """speech, and for every measure its median and spread over all documents of 10 words or more.

    The spread is the distance of the quartiles over 1.349 (a normal deviation), and not below a least one. Rounded
    measures are counted first, so what a task holds of a language is bounded by their number of steps."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * STEPS).cast("long").alias("step")) for m in widths))).alias("x")
    counted = rows.where("n_words >= 10").select("speech", each).groupBy("speech", F.col("x.measure").alias("measure"), F.col("x.step").alias("step")).count()
    middle = counted.groupBy("speech", "measure").agg(F.percentile("step", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("count")).alias("q"))
    spread = (F.col("q")[2] - F.col("q")[0]) / (1.349 * STEPS)
    told = (F.max(F.when(F.col("measure") == m, F.struct((F.col("q")[1] / STEPS).alias("middle"), F.greatest(spread, F.lit(least)).alias("spread")))).alias(f"band_{m}") for m, (_, _, least) in widths.items())
    return middle.groupBy("speech").agg(*told)


def quality(docs: DataFrame, pieces: str, ranks: str, pattern: str, widths: dict = BANDS, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """A row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    then speech, the tokens and the measures of `fertility`.

    base_failed: fewer than 10 words, or more than a fifth of them in windows of five that stand twice in the text.
    kept: not base_failed; characters per token within the band of the text's language or script by one vocabulary
    at least (one of them cuts every digit off by itself, so numbers alone don't reject a text), fallback and entropy
    within theirs. Nulls, repeated rows and empty tables as in `fertility`.
    """
    rows = stored(fertility(docs, pieces, ranks, pattern, text, doc_id, lang), scratch(docs.sparkSession, "fertility"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    wider = F.sqrt(1 + F.lit(float(SHORT)) / F.greatest("tokens_a", F.lit(1)))
    inside = {}
    for m, (below, above, _) in widths.items():
        off = (F.col(m) - F.col(f"band_{m}")["middle"]) / (F.col(f"band_{m}")["spread"] * wider)
        inside[m] = F.coalesce(off.between(-np.inf if below is None else -below, np.inf if above is None else above), F.lit(True))
    fluent = reduce(or_, [inside[m] for m in widths if m.startswith("chars_")] or [F.lit(True)])
    verdict = reduce(and_, [inside[m] for m in widths if not m.startswith("chars_")], fluent)
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.join(bands(rows, widths), "speech", "left").select(*base, failed.alias("base_failed"), (~failed & verdict).alias("kept"), "speech", "tokens_a", "tokens_b", *widths)
