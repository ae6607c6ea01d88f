import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import records
from millrace.llm.common import TokenIds, scratch

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = ["  a b", "a  b", " a", "a ", "a\nb c\n\nd e", "\n", "Ünïcode wörd, naïve. x y  z", "d'accord l'été don't", "a\tb c\t d", "x \ny", " ", "<|endoftext|> hi", "ÿ× ÷a", "日本 語 テスト.", "A.B, ..", "Ab\nCd.\nEf", "é", "café x", "The THE the. The,"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_cached_ids_are_those_of_the_library(path, prose):
    library, ours = Tokenizer.from_file(path), TokenIds(path)
    library.encode_special_tokens = True
    for _ in range(2):  # the second time from the cache
        for t in TEXTS + prose(50) + [w.title() + ". " + w + "," for w in prose(30, 2)]:
            assert np.frombuffer(ours.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert ours.encode(None) == ours.encode("") == b""


def expected(rows):
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_digests_of_odd_and_plain_texts(make, clash, odd, prose):
    rows = odd + [(100 + i, t) for i, t in enumerate(prose(40))]
    got = records.encoded_digests(clash(make(rows)), BYTE, 2).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)


def test_empty_table(make):
    assert records.encoded_digests(make([]), BYTE, 2).count() == 0


def test_shuffled_reads_give_the_same_records_and_damage_is_found(spark, make, prose):
    path = scratch(spark, "test-records")
    records.write_records(make([(i, t) for i, t in enumerate(prose(30))]), path, BYTE, 2, shards=2)
    plain = {tuple(r[:4]): r[4] for r in records.read_records(spark, path).collect()}
    mixed = records.read_records(spark, path, seed=3).collect()
    assert {tuple(r[:4]): r[4] for r in mixed} == plain and len(plain) == 30
    assert [r["place"] for r in mixed if r["shard"] == 0] != sorted(r["place"] for r in mixed if r["shard"] == 0)
    file = path.removeprefix("file://") + "/part-000000.rec"
    data = bytearray(open(file, "rb").read())
    data[40] ^= 1
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(spark, path).collect()


def test_frame():
    f = records.frame(b"abc")
    assert struct.unpack("<Q", f[:8])[0] == 3 and records.unframed(memoryview(f), 0, "x") == (b"abc", len(f))
    assert records.parsed(records.payload_of(None, np.array([70000, 1], "<u4").tobytes()))[0] is None


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_random_texts_have_the_ids_of_the_library(path):
    import random

    rng, library, ours = random.Random(8), Tokenizer.from_file(path), TokenIds(path)
    library.encode_special_tokens = True
    some = [*"abcdefgh ABC  \n\t.,;'\"!?0123-_", "é", "ß", "ç", "日", "\u00a0", "\u2028", "😀", "the ", " and", "İ", "ﬁ", "\u0301", "<|endoftext|>", "'s", "'LL "]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 60))) for _ in range(6000)]
    for t, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == want.ids, t
