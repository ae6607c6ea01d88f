import hashlib
import zlib

import numpy as np

from millrace.llm import jpeg, media


def test_digests_are_of_the_padded_text(make, clash, odd, prose):
    rows = odd + [(100 + i, t) for i, t in enumerate(prose(20, most=400))]
    got = media.media_digests(clash(make(rows))).collect()
    assert len(got) == len(rows)

    def want(t):
        raw = (t or "").encode()
        p = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        return len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])

    assert sorted(map(str, ((r[0], *r[1:5]) for r in got))) == sorted(map(str, ((i, *want(t)) for i, t in rows)))
    by_text = {}
    for r in got:
        by_text.setdefault(r["payload_sha256"], set()).add((r["media_sha256"], r["feature"]))
    assert all(len(v) == 1 for v in by_text.values())


def test_round_trip_of_all_bytes_and_long_payloads():
    rng = np.random.default_rng(1)
    payloads = [bytes(range(256)) * 3, rng.integers(0, 256, 192 * 50, dtype=np.uint8).tobytes(), b"\xff" * 384, b"\0" * 192]
    files = media.to_files(payloads)
    back, frames, coefficients = media.from_files(files)
    assert back == payloads and all(f[:2] == b"\xff\xd8" and f[-2:] == b"\xff\xd9" for f in files)
    assert all(jpeg.rgb(f, c).shape == (f.height, f.width, 3) for f, c in zip(frames, coefficients, strict=True))


def test_columns_and_tensors(make, clash):
    docs = clash(make([(1, "a b c"), (2, None), (3, "d" * 500)])).drop("media")
    held = media.encode_column(docs)
    assert held.columns == [*docs.columns, "media"]
    out = {r["doc_id"]: r for r in media.decode_column(held).collect()}
    assert out[1]["payload"].rstrip(b" ") == b"a b c" and len(out[3]["rgb"]) == out[3]["height"] * out[3]["width"] * 3


def test_empty_table(make):
    assert media.media_digests(make([])).count() == 0
