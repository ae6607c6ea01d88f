"""Fill-in-middle: documents cut at two token boundaries and told in another order.

A token is white space and the word behind it, or the white space that ends a text. Over UTF-8 bytes two states tell
where tokens end: outside a word (state 0) and in one (state 1); a token ends where white space follows a word, and
the text's end ends one more. A chunk of bytes is a function of the state in which it is entered: the state in which
it is left, and how many tokens end in it. Functions of chunks compose associatively, so the chunks of a document are
scanned in parallel, by tasks that know nothing of each other; composing them in order tells each chunk's entry
state and the tokens before it, and with that which chunk holds a cut, in which alone the cut is looked for.
A document that is one chunk is entered in state 0 and needs no composition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_of

#: Bytes of a chunk.
CHUNK = 1 << 16
#: Bytes that a task scans at once.
HELD = 8 << 20

MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_space = np.zeros(256, bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CUTS = "n long, first long, second long"
_CHUNK = "left array<int>, ends array<long>, chars long"


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array, and where its values begin (one entry more than values)."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _token_ends(data: np.ndarray, entry: int) -> np.ndarray:
    """Positions of white space that follows a word, entered in a state."""
    space = _space[data]
    ended = space.copy()
    ended[1:] &= ~space[:-1]
    ended[:1] &= entry == 1
    return np.flatnonzero(ended)


def _chars(data: np.ndarray) -> np.ndarray:
    """Code points before each position; one entry more than bytes."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def _small_cuts(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text, and the code points before its two cuts."""
    data, edges = _bytes(texts)
    start, stop = edges[:-1], edges[1:]
    ends = _token_ends(data, 0)
    ends = ends[~np.isin(ends, start)]  # the text before is none of a text's business
    below, above = np.searchsorted(ends, start), np.searchsorted(ends, stop)
    n = above - below + (stop > start)
    chars = _chars(data)
    padded = np.append(ends, 0)

    def cut(k: np.ndarray) -> np.ndarray:
        at = np.where(k == 0, start, np.where(k == n, stop, padded[np.minimum(below + np.maximum(k, 1) - 1, len(ends))]))
        return chars[at] - chars[start]

    a, b = h1 % (n + 1), h2 % (n + 1)
    return n, cut(np.minimum(a, b)), cut(np.maximum(a, b))


def _cuts_udf():
    @F.arrow_udf(_CUTS)
    def cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        sizes = np.cumsum(np.diff(_bytes(text)[1]))
        found, at = [], 0
        while at < len(text):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + HELD, side="right")))
            found.append(_small_cuts(text.slice(at, end - at), *(np.asarray(h.slice(at, end - at)) for h in (h1, h2))))
            at = end
        return pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, "int64"), *x]).astype("int64")) for x in (zip(*found, strict=True) if found else ((), (), ()))], names=["n", "first", "second"])

    return cuts


def _scan_udf():
    @F.arrow_udf(_CHUNK)
    def scan(chunks: pa.Array) -> pa.Array:
        """The function of each chunk: state left and tokens ended, by state entered; and its code points."""
        left, ends, chars = [], [], []
        for c in chunks:
            data = np.frombuffer(c.as_buffer(), np.uint8)
            out = int(not _space[data[-1]])
            left.append([out, out])
            ends.append([len(_token_ends(data, state)) for state in (0, 1)])
            chars.append(int(_chars(data)[-1]))
        return pa.StructArray.from_arrays([pa.array(left, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int64())), pa.array(chars, pa.int64())], names=["left", "ends", "chars"])

    return scan


def _find_udf():
    @F.arrow_udf("long")
    def find(chunks: pa.Array, entry: pa.Array, rank: pa.Array) -> pa.Array:
        """Code points of a chunk before the end of its rank-th token, entered in a state; null where no chunk is asked."""
        out = []
        for c, e, r in zip(chunks, entry.to_pylist(), rank.to_pylist(), strict=True):
            if not c.is_valid or e is None:
                out.append(None)
                continue
            data = np.frombuffer(c.as_buffer(), np.uint8)
            out.append(int(_chars(data)[_token_ends(data, e)[r - 1]]))
        return pa.array(out, pa.int64())

    return find


def _composed(parts: Column, k: Column) -> Column:
    """Composition of a document's chunk functions in order, entered in state 0. Notes the chunk in which the k-th
    token ends: its number, entry state, the token's rank in it, and the code points before it."""
    none = F.lit(None)
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("ends"), F.lit(0).cast("long").alias("chars"), none.cast("int").alias("chunk"), none.cast("int").alias("entry"), none.cast("long").alias("rank"), none.cast("long").alias("before"))

    def step(acc: Column, part: Column) -> Column:
        ended = acc["ends"] + F.element_at(part["ends"], acc["state"] + 1)
        hit = acc["chunk"].isNull() & (k > acc["ends"]) & (k <= ended)
        noted = ((acc["chunk"], part["chunk"], "chunk"), (acc["entry"], acc["state"], "entry"), (acc["rank"], k - acc["ends"], "rank"), (acc["before"], acc["chars"], "before"))
        return F.struct(F.element_at(part["left"], acc["state"] + 1).alias("state"), ended.alias("ends"), (acc["chars"] + part["chars"]).alias("chars"), *(F.when(hit, new).otherwise(old).alias(name) for old, new, name in noted))

    return F.aggregate(parts, start, step)


def _long_cuts(long: DataFrame) -> DataFrame:
    """long (key, whole, h1, h2, ...) with `cuts`; its documents are scanned chunk by chunk in tasks of any number."""
    raw = F.col("whole").cast("binary")
    chunks = long.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), F.ceil(F.octet_length("whole") / CHUNK).cast("int") - 1), lambda i: F.substring(raw, i * CHUNK + 1, F.lit(CHUNK)))).alias("chunk", "data"))
    dealt = chunks.repartition("key", "chunk")  # chunks of one document go to different tasks
    scanned = dealt.select("key", "chunk", _scan_udf()("data").alias("f")).dropDuplicates(["key", "chunk"])
    parts = scanned.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("chunk", "f.left", "f.ends", "f.chars"))).alias("parts"))  # a part per 64 KB of one text
    counted = parts.select("key", "parts", (_composed(F.col("parts"), F.lit(0))["ends"] + 1).alias("n"))
    whole = long.join(counted, "key")
    a, b = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    whole = whole.withColumns({"k1": F.least(a, b), "k2": F.greatest(a, b)})
    found = whole.withColumns({"at1": _composed(F.col("parts"), F.col("k1")), "at2": _composed(F.col("parts"), F.col("k2"))}).drop("parts")
    find = _find_udf()

    def cut(k: str, at: str) -> Column:
        inner = find(F.substring(raw, F.col(at)["chunk"] * CHUNK + 1, F.lit(CHUNK)), F.col(at)["entry"], F.col(at)["rank"])
        return F.when(F.col(k) == 0, 0).when(F.col(k) == F.col("n"), F.col(at)["chars"]).otherwise(F.col(at)["before"] + inner).cast("long")

    return found.withColumn("cuts", F.struct("n", cut("k1", "at1").alias("first"), cut("k2", "at2").alias("second"))).drop("n", "k1", "k2", "at1", "at2")


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per document: doc_id, whole (its text), n (tokens), form, prefix_chars, middle_chars, output.

    The hash of seed and doc_id decides: percent of the documents are rearranged, suffix_first percent of these as
    spm, the others as psm; where both cuts fall follows from it, too. A text that is empty or holds one of the
    marks stays plain. A null text is empty; a null doc_id is hashed as no digits; repeated rows get the same result
    each. Other columns are ignored. An empty table gives no rows.
    """
    whole = text_of(text)
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("whole"), sha.alias("sha"))
    h1, h2, h3, h4 = (F.conv(F.substring("sha", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4))
    marked = F.contains("whole", F.lit(PREFIX)) | F.contains("whole", F.lit(SUFFIX)) | F.contains("whole", F.lit(MIDDLE))
    form = F.when((F.col("whole") == "") | marked | (h3 % 100 >= percent), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    told = source.select("doc_id", "whole", h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    size = F.octet_length("whole")
    short = told.where(size <= CHUNK).withColumn("cuts", _cuts_udf()("whole", "h1", "h2"))
    long = _long_cuts(told.where(size > CHUNK).withColumn("key", F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), F.sha2(F.col("whole").cast("binary"), 256)), 256)))
    both = short.unionByName(long.select(*short.columns))
    first, second = F.col("cuts.first"), F.col("cuts.second")
    prefix, middle, suffix = F.substring("whole", F.lit(1), first), F.substring("whole", first + 1, second - first), F.substring("whole", second + 1, F.length("whole"))
    output = F.when(F.col("form") == "plain", F.col("whole")).when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    moved = F.col("form") != "plain"
    return both.select("doc_id", "whole", F.col("cuts.n").alias("n"), "form", F.when(moved, first).alias("prefix_chars"), F.when(moved, second - first).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text from its output and form. A text with marks is plain, so each mark of another form stands once."""
    lead = F.split(F.substring(output, F.lit(len(PREFIX) + 1), F.length(output)), F.when(form == "psm", SUFFIX).otherwise(PREFIX), 2)
    tail = F.split(F.element_at(lead, 2), MIDDLE, 2)
    psm = F.concat(F.element_at(lead, 1), F.element_at(tail, 2), F.element_at(tail, 1))
    spm = F.concat(F.element_at(tail, 1), F.element_at(tail, 2), F.element_at(lead, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fim_digests(docs: DataFrame) -> DataFrame:
    """fill_in_middle with output_sha256 and restored_sha256 in place of the texts; same nulls, repeated rows and empty tables."""
    told = fill_in_middle(docs)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return told.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
