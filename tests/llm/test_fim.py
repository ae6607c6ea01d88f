import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import fim


def brute(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form = "plain" if not text or any(x in text for x in fim.MARKS) or h3 % 100 >= 50 else "spm" if h4 % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, n, form, *((None, None) if form == "plain" else (len(p), len(m))), sha(out), sha(text)


def order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("chunk", [1 << 16, 7, 64])
def test_same_as_brute_force(make, clash, odd, prose, monkeypatch, chunk):
    monkeypatch.setattr(fim, "CHUNK", chunk)
    rng = random.Random(chunk)
    texts = ["".join(rng.choice(["a", "é", "日", " ", "\n", "\t", "<", "S>", " ", "😀"]) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    rows = odd + [(50 + i, t) for i, t in enumerate(texts)] + [(500 + i, t) for i, t in enumerate(prose(40))] + [(600, "a <P> b c"), (601, "x<M>"), (602, "ends "), (50, texts[0])]
    got = fim.fim_digests(clash(make(rows))).collect()
    assert order(got) == order(brute(*r) for r in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_long_documents_are_cut_in_chunks(make):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé日") for _ in range(rng.randint(1, 9))) + rng.choice([" ", "\n", "  "])
    rows = [(i, "".join(word() for _ in range(60_000))) for i in range(6)] + [(10, "x" * 400_000), (11, " " * 300_000), (12, "é" * 200_000 + " ")]
    assert order(fim.fim_digests(make(rows + rows[:2])).collect()) == order(brute(*r) for r in rows + rows[:2])


def test_a_chunk_is_a_function_and_functions_compose():
    rng = random.Random(7)
    for _ in range(200):
        text = "".join(rng.choice("ab \n") for _ in range(rng.randint(2, 40))).encode()
        cut = rng.randint(1, len(text) - 1)
        whole, first, second = (np.frombuffer(x, np.uint8) for x in (text, text[:cut], text[cut:]))
        for entry in (0, 1):
            between = int(not fim._space[first[-1]])
            assert len(fim._token_ends(whole, entry)) == len(fim._token_ends(first, entry)) + len(fim._token_ends(second, between))


def test_restored_from_output_and_form_alone(spark, make, prose):
    from pyspark.sql import functions as F

    docs = make([(i, t + rng) for i, (t, rng) in enumerate(zip(prose(60), ["", " <", "< ", ">"] * 15, strict=True))])
    told = fim.fill_in_middle(docs)
    assert told.where(fim.restored(F.col("output"), F.col("form")) != F.col("whole")).count() == 0
    assert told.where("form <> 'plain' and output = whole").count() == 0


def test_empty_table(make):
    assert fim.fim_digests(make([])).count() == 0


def test_slices_of_a_batch(monkeypatch):
    texts = pa.array(["a b", "", " c  d ", "é"])
    h = np.array([1, 5, 2, 1]), np.array([2, 7, 3, 0])
    n, a, b = fim._small_cuts(texts.slice(1), h[0][1:], h[1][1:])
    assert (n.tolist(), a.tolist(), b.tolist()) == ([0, 3, 1], [0, 5, 0], [0, 6, 1])
