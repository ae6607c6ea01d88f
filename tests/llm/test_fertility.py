import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from millrace.llm import fertility

PIECES, RANKS, PATTERN = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def known():
    return fertility.Vocabularies(PIECES, RANKS, PATTERN)


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words)


def measures(text):
    """By the libraries, word by word, in plain Python."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tt = fertility.Vocabularies(PIECES, RANKS, PATTERN).bytelevel
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    units = [w[i : i + 64] for w in words for i in range(0, len(w), 64)]
    ids = [i for u in units for i in sp.encode(u)]
    level = sum(len(tt.encode_ordinary(" " + u)) for u in units)
    chars, entropy = max(1, sum(map(len, words))), 0.0
    for at in range(0, len(ids), 64):
        block = ids[at : at + 64]
        h = -sum(n / len(block) * math.log2(n / len(block)) for n in Counter(block).values())
        entropy += (h / math.log2(len(block)) if len(block) > 1 else 1.0) * len(block)
    return len(ids), level, math.log(chars / max(1, len(ids))), math.log(chars / max(1, level)), sum(map(sp.is_byte, ids)) / max(1, len(ids)), entropy / len(ids) if len(ids) > 1 else 1.0


@pytest.fixture
def texts(odd, prose):
    rng = random.Random(2)
    plain = [t for _, t in odd] + prose(25, 2, 1, 120)
    plain += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    plain += ["\n".join(rng.choice(["x y", "x y ", " ", "", "z"]) for _ in range(12)) for _ in range(20)]
    return plain + ["ꙮꙮ ꙮ word", "Ελληνικά " * 12, "слово " * 9 + "и ещё", "a" * 300 + " " + "日本" * 100, "a|b <c> #d ** &", "w x \x1c y", "one two three four five " * 2]


def test_counts_and_measures_are_those_of_plain_python(spark, make, clash, texts):
    rows = list(enumerate(texts)) + [(None, "no id " * 8), (3, texts[3])]
    got = fertility.fertility(clash(make(rows)), PIECES, RANKS, PATTERN).collect()
    told = lambda t: (*base(t)[:5], *(round(x, 7) for x in measures(t)))
    ours = sorted((str(r["doc_id"]), *r[2:7], r["tokens_a"], r["tokens_b"], *(round(r[m], 7) for m in ("chars_a", "chars_b", "fallback", "entropy"))) for r in got)
    assert ours == sorted((str(i), *told(t)) for i, t in rows)


def test_a_full_table_of_words_changes_nothing(known, texts, monkeypatch):
    raw = [(t or "").encode() for t in texts]
    want = fertility.measured(raw, known)
    monkeypatch.setattr(fertility, "MOST", 10)
    small = fertility.Vocabularies(PIECES, RANKS, PATTERN)
    for i in range(0, len(raw), 3):
        got = fertility.measured(raw[i : i + 3], small)
        assert all((got[k] == want[k][i : i + 3]).all() for k in want)


def test_verdicts_are_those_of_bands_counted_by_hand(spark, prose, clash):
    import numpy as np

    rng = random.Random(9)
    plain = prose(300, 9, 12, 150)
    odd = ["ὠ0ꙮ꙯ " * 30, " ".join(rng.choice(["on", "off"]) + str(i % 3) for i in range(60)), "qzxj" * 400, *("kw " * 3,)]
    rows = [(i, t, ("xx", "yy", None, "")[i % 4]) for i, t in enumerate(plain)] + [(1000 + i, t, "xx") for i, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in fertility.quality(clash(docs), PIECES, RANKS, PATTERN).collect()}
    assert len(got) == len(rows)
    by = {}
    for r in got.values():
        by.setdefault(r["speech"], []).append(r)
    assert set(by) == {"xx", "yy", "script:latin"}
    for group in by.values():
        sound = [r for r in group if r["n_words"] >= 10]
        band = {}
        for m, (_, _, least) in fertility.BANDS.items():
            q = np.percentile([math.floor(abs(r[m]) * 1000 + 0.5) * (1 if r[m] >= 0 else -1) for r in sound], [25, 50, 75]) / 1000
            band[m] = q[1], max((q[2] - q[0]) / 1.349, least)
        for r in group:
            wide = math.sqrt(1 + 150 / max(1, r["tokens_a"]))
            off = {m: (r[m] - band[m][0]) / (band[m][1] * wide) for m in band}
            good = (abs(off["chars_a"]) <= 4 or abs(off["chars_b"]) <= 4) and off["fallback"] <= 4 and off["entropy"] >= -4
            failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
            assert (r["base_failed"], r["kept"]) == (failed, not failed and good)
    assert [got[1000 + i]["kept"] for i in range(4)] == [False] * 4
    assert sum(not got[i]["kept"] for i in range(300)) <= 3


@pytest.mark.parametrize(("text", "want"), [("plain words", "latin"), ("слово word слово", "cyrillic"), ("日本語のテスト", "kana"), ("日本 語", "han"), ("12 34", "none"), ("", "none"), ("ελληνικά", "greek"), ("한국어", "hangul"), ("הללו", "hebrew"), ("кот cat", "latin")])
def test_scripts(text, want):
    assert fertility.script(text) == want


def test_empty_table_and_very_long_text(make):
    args = PIECES, RANKS, PATTERN
    assert fertility.quality(make([]), *args).count() == 0
    row = fertility.quality(make([(1, "word other " * 200_000)]), *args).first()
    assert (row["n_words"], row["n_repeat_words"], row["kept"]) == (400_000, 400_000, False)
