"""Progressive JPEG in numpy: coefficients to files, files to coefficients, coefficients to RGB.

Whole batches of files are coded at once. A scan's restart segments are independent bit streams, so the
decoder steps through all segments of all files side by side: one numpy operation advances thousands of
streams by one Huffman symbol or one coefficient. It reads sequences of spectral-selection and
successive-approximation scans of any order, interleaved DC scans, DC prediction and end-of-band runs.
"""

from __future__ import annotations

import heapq
import re
import struct
from dataclasses import dataclass, field

import numpy as np

#: Place in an 8 x 8 block (row by row) of each coefficient in zigzag order.
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, p // 8 if (p // 8 + p % 8) % 2 else p % 8)))
#: Scans that are written: component, first and last coefficient, high and low bit of the approximation.
SCANS = [*((c, 0, 0, 0, 1) for c in range(3)), *((c, 0, 0, 1, 0) for c in range(3)), *((c, 1, 5, 0, 1) for c in range(3)), *((c, 6, 63, 0, 1) for c in range(3)), *((c, 1, 63, 1, 0) for c in range(3))]
#: How many blocks of each component an MCU has across and down: chroma has half the resolution each way.
SAMPLING = ((2, 2), (1, 1), (1, 1))


def code_lengths(weights: dict[int, int]) -> dict[int, int]:
    """Lengths of a Huffman code in which no symbol is all ones."""
    heap = [(w, s, (s,)) for s, w in weights.items()] + [(0, 256, (256,))]
    heapq.heapify(heap)
    lengths = dict.fromkeys([*weights, 256], 0)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for s in a[2] + b[2]:
            lengths[s] += 1
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
    del lengths[256]
    return lengths


class Huffman:
    """A table as the files hold it: numbers of codes by length, and symbols."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.counts, self.symbols = bytes(counts), bytes(symbols)
        self.lookup = np.zeros(1 << 16, np.int32)  # of 16 bits: length << 8 | symbol
        self.code, self.length = np.zeros(256, np.int64), np.zeros(256, np.int64)
        code = at = 0
        for n, count in enumerate(self.counts, 1):
            for _ in range(count):
                s = self.symbols[at]
                self.code[s], self.length[s] = code, n
                self.lookup[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | s
                code, at = code + 1, at + 1
            code <<= 1

    @classmethod
    def of(cls, weights: dict[int, int]) -> Huffman:
        lengths = code_lengths(weights)
        assert max(lengths.values()) <= 16
        order = sorted(lengths, key=lambda s: (lengths[s], s))
        return cls(bytes(sum(v == n for v in lengths.values()) for n in range(1, 17)), bytes(order))

    def segment(self, kind: int) -> bytes:
        return b"\xff\xc4" + struct.pack(">HB", 19 + len(self.symbols), kind) + self.counts + self.symbols


def written_tables() -> tuple[Huffman, Huffman]:
    """For DC and AC. The weights suit bytes of text; every symbol has a code."""
    dc = {s: {6: 40, 5: 20, 7: 8}.get(s, 1) for s in range(12)}
    ac = {r << 4 | s: {6: 9000, 5: 3000, 0: 1500, 7: 900}.get(r << 4 | s, 4) for r in range(16) for s in range(11)}
    return Huffman.of(dc), Huffman.of(ac)


_SIZES = np.array([x.bit_length() for x in range(1 << 12)])


def bits_of(x: np.ndarray) -> np.ndarray:
    """Number of binary digits of absolute values below 4096."""
    return _SIZES[np.abs(x)]


def _joined(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], segments: int, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit strings (segment, order in it, value, length of 32 at most) to bytes: each segment filled with ones, FF stuffed, then
    its restart marker where marks has one (0: none). Each part is sorted. Returns the bytes and where each segment begins, with the end."""
    seg, order, value, length = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*parts, strict=True))
    if len(parts) > 1:
        sort = np.argsort(seg * 256 + order, kind="stable")
        seg, value, length = seg[sort], value[sort], length[sort]
    ends = np.cumsum(length)
    edges = np.searchsorted(seg, np.arange(segments + 1))
    total = np.concatenate([[0], ends])[edges]
    bits = np.diff(total)
    size = (bits + 7) // 8 + 2 * (marks > 0)
    base = np.concatenate([[0], np.cumsum(size)])
    at = ends - length + (8 * base[:-1] - total[:-1])[seg]
    word, byte = value << (40 - length - (at & 7)), at >> 3
    n = int(base[-1])
    sums = np.zeros(n + 5)
    for j in range(5):
        sums += np.bincount(byte + j, weights=(word >> (32 - 8 * j)) & 255, minlength=n + 5)
    data = sums[:n].astype(np.uint8)
    fill = -bits % 8
    data[base[:-1] + (bits + 7) // 8 - 1] |= ((1 << fill) - 1).astype(np.uint8)
    marked = np.flatnonzero(marks > 0)
    is_mark = np.zeros(n, bool)
    for k, v in ((2, 0xFF), (1, marks[marked])):
        data[base[marked + 1] - k] = v
        is_mark[base[marked + 1] - k] = True
    stuff = (data == 0xFF) & ~is_mark
    moved = np.concatenate([[0], np.cumsum(1 + stuff)])
    done = np.zeros(moved[-1], np.uint8)
    done[moved[:-1]] = data
    return done, moved[base]


def encode(coefficients: list[np.ndarray], blocks: np.ndarray, comments: list[bytes]) -> list[bytes]:
    """Files of strips one MCU high, or as many rows as it takes.

    coefficients: for each component the zigzag blocks of all files in their raster order; blocks: MCUs across and down of
    each file. A block's AC coefficients are all 2 or more in size, or all zero, so that refinement adds no new ones.
    """
    dc, ac = written_tables()
    mcus = blocks.prod(1)
    scans: list[tuple[np.ndarray, np.ndarray]] = []
    for c, first, last, high, low in SCANS:
        x = coefficients[c]
        each = mcus * SAMPLING[c][0] * SAMPLING[c][1]
        n = len(x)
        place = np.arange(n) - np.repeat(np.cumsum(each) - each, each)
        marks = np.where(place < np.repeat(each, each) - 1, 0xD0 + place % 8, 0)
        ids = np.arange(n)
        if first == 0 and high == 0:
            v = x[:, 0] >> low
            size = bits_of(v)
            parts = [(ids, np.zeros(n, np.int64), dc.code[size] << size | np.where(v < 0, v + (1 << size) - 1, v), dc.length[size] + size)]
        elif first == 0:
            parts = [(ids, np.zeros(n, np.int64), (x[:, 0] >> low) & 1, np.ones(n, np.int64))]
        elif high == 0:
            v = x[:, first : last + 1]
            v = np.sign(v) * (np.abs(v) >> low)
            seg, k = np.nonzero(v)
            before = np.where(np.concatenate([[-1], seg[:-1]]) == seg, np.concatenate([[0], k[:-1]]), -1) if len(seg) else k
            run, w = k - before - 1, v[seg, k]
            size = bits_of(w)
            symbol = (run % 16) << 4 | size
            parts = [(seg, 2 * k + 1, ac.code[symbol] << size | np.where(w < 0, w + (1 << size) - 1, w), ac.length[symbol] + size)]
            if (run > 15).any():  # runs of 16 zeros
                parts.append((np.repeat(seg, run // 16), 2 * np.repeat(k, run // 16), *(np.full((run // 16).sum(), t[0xF0]) for t in (ac.code, ac.length))))
            ended = np.flatnonzero(v[:, -1] == 0)
            if len(ended):
                parts.append((ended, np.full(len(ended), 255), *(np.full(len(ended), t[0]) for t in (ac.code, ac.length))))
        else:
            v = np.abs(x[:, first : last + 1])
            if ((v >> high == 0) & (v >> low != 0)).any():
                raise ValueError("a coefficient would become nonzero in a refinement scan")
            parts = [(ids, np.zeros(n, np.int64), *(np.full(n, t[0]) for t in (ac.code, ac.length)))]
            old = v != 0
            count = np.cumsum(old, 1)
            if (count[:, -1] % v.shape[1] == 0).all():  # blocks full or empty: 16 bits at a time
                full = np.flatnonzero(old[:, 0])
                raw = (v[full] >> low) & 1
                for k in range(0, v.shape[1], 16):
                    some = raw[:, k : k + 16]
                    parts.append((full, np.full(len(full), k + 1), some @ (1 << np.arange(some.shape[1])[::-1]), np.full(len(full), some.shape[1])))
            else:
                seg, k = np.nonzero(old)
                parts.append((seg, k + 1, (v[seg, k] >> low) & 1, np.ones(len(seg), np.int64)))
        data, at = _joined(parts, n, marks)
        scans.append((data, at[np.concatenate([[0], np.cumsum(each)])]))
    quant = b"\xff\xdb\x00\x43\x00" + b"\x01" * 64
    tables = dc.segment(0x00) + ac.segment(0x10) + b"\xff\xdd\x00\x04\x00\x01"  # a restart after every block
    out = []
    for i, (across, down) in enumerate(blocks.tolist()):
        frame = b"\xff\xc2" + struct.pack(">HBHHB", 17, 8, 16 * down, 16 * across, 3) + b"".join(bytes((c + 1, h << 4 | v, 0)) for c, (h, v) in enumerate(SAMPLING))
        parts = [b"\xff\xd8\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00", b"\xff\xfe", struct.pack(">H", 2 + len(comments[i])), comments[i], quant, frame, tables]
        for (c, first, last, high, low), (data, at) in zip(SCANS, scans, strict=True):
            parts += [b"\xff\xda\x00\x08\x01", bytes((c + 1, 0, first, last, high << 4 | low)), data[at[i] : at[i + 1]].tobytes()]
        out.append(b"".join(parts) + b"\xff\xd9")
    return out


@dataclass
class Frame:
    """What a file says of itself, and where its scans' data lie."""

    width: int = 0
    height: int = 0
    sampling: list[tuple[int, int]] = field(default_factory=list)
    quant: list[np.ndarray] = field(default_factory=list)
    comment: bytes = b""
    scans: list[tuple] = field(default_factory=list)  # ((components, first, last, high, low), tables, interval, begin, end)

    @property
    def mcus(self) -> tuple[int, int]:
        h, v = (max(s[i] for s in self.sampling) for i in (0, 1))
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


_END = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]", re.S)


def parse(data: bytes, known: dict[tuple[bytes, bytes], Huffman]) -> Frame:
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    f, at, interval, quant, tables, ids = Frame(), 2, 0, {}, {}, []
    while at < len(data) and data[at + 1] != 0xD9:
        kind, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if kind == 0xFE:
            f.comment = body
        elif kind == 0xDB:
            while body:
                wide = 1 + (body[0] >> 4)
                quant[body[0] & 15] = np.frombuffer(body, ">u2" if wide == 2 else "u1", 64, 1).astype(np.int64)
                body = body[1 + 64 * wide :]
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                key = bytes(body[1:17]), bytes(body[17 : 17 + n])
                tables[body[0]] = known.setdefault(key, Huffman(*key)) if key not in known else known[key]
                body = body[17 + n :]
        elif kind == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif kind == 0xC2:
            if body[0] != 8:
                raise ValueError("samples of other than 8 bits")
            f.height, f.width = struct.unpack_from(">HH", body, 1)
            rest = [body[6 + 3 * i : 9 + 3 * i] for i in range(body[5])]
            ids, f.sampling, f.quant = [r[0] for r in rest], [(r[1] >> 4, r[1] & 15) for r in rest], [quant[r[2]] for r in rest]
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a progressive Huffman-coded file")
        elif kind == 0xDA:
            n = body[0]
            members = tuple(ids.index(body[1 + 2 * i]) for i in range(n))
            first, last, near = body[1 + 2 * n : 4 + 2 * n]
            used = tuple(tables.get(body[2 + 2 * i] >> 4) if first == 0 else tables.get(0x10 | body[2 + 2 * i] & 15) for i in range(n))
            end = m.start() if (m := _END.search(data, at)) else len(data)
            f.scans.append(((members, first, last, near >> 4, near & 15), used, interval, at, end))
            at = end
    return f


class _Bits:
    """Reading heads over one clean byte string."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        d = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.int64)
        self.data = d
        self.words = (d[:-3] << 24) | (d[1:-2] << 16) | (d[2:-1] << 8) | d[3:]
        self.last = len(self.words) - 1
        self.at = at.astype(np.int64)

    def peek(self, who: np.ndarray) -> np.ndarray:
        """The next 16 bits."""
        at = self.at[who]
        return (self.words[np.minimum(at >> 3, self.last)] >> (16 - (at & 7))) & 0xFFFF

    def take(self, who: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """The next n bits, 16 at most, for each."""
        got = self.peek(who) >> (16 - n)
        self.at[who] += n
        return got

    def symbol(self, who: np.ndarray, lookup: np.ndarray, table: np.ndarray) -> np.ndarray:
        got = lookup[table[who], self.peek(who)]
        self.at[who] += got >> 8
        return got & 255


def _signed(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where((size > 0) & (v < (1 << np.maximum(size - 1, 0))), v - (1 << size) + 1, v)


def decode(files: list[bytes]) -> tuple[list[Frame], list[list[np.ndarray]]]:
    """Frames and, for each file and component, its coefficients: zigzag blocks in raster order."""
    known: dict[tuple[bytes, bytes], Huffman] = {}
    frames = [parse(f, known) for f in files]
    shape = [[(f.mcus[0] * h, f.mcus[1] * v) for h, v in f.sampling] for f in frames]
    base, total = [], 0
    for s in shape:
        base.append([])
        for w, h in s:
            base[-1].append(total)
            total += w * h
    store = np.zeros((total, 64), np.int32)
    groups: dict[tuple, list[tuple[int, tuple]]] = {}
    for i, f in enumerate(frames):
        for k, s in enumerate(f.scans):
            groups.setdefault((k, s[0]), []).append((i, s))
    orders: dict[tuple, tuple] = {}
    for (_, spec), members in sorted(groups.items(), key=lambda g: g[0]):
        for i, _ in members:
            if (i, spec[0]) not in orders:
                orders[i, spec[0]] = _coded_order(frames[i], shape[i], base[i], spec[0])
        _scan(spec, members, files, orders, store)
    return frames, [[store[b : b + w * h] for b, (w, h) in zip(bs, s, strict=True)] for bs, s in zip(base, shape, strict=True)]


def _coded_order(f: Frame, shape: list[tuple[int, int]], base: list[int], comps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, int]:
    """Blocks (in the store) in coding order, the scan's component number of each, and blocks in an MCU."""
    if len(comps) == 1:
        c = comps[0]
        hmax, vmax = (max(s[i] for s in f.sampling) for i in (0, 1))
        across = -(-(-(-f.width * f.sampling[c][0] // hmax)) // 8)
        down = -(-(-(-f.height * f.sampling[c][1] // vmax)) // 8)
        y, x = np.divmod(np.arange(across * down), across)
        return base[c] + y * shape[c][0] + x, np.zeros(across * down, np.int64), 1
    across, down = f.mcus
    my, mx = np.divmod(np.arange(across * down), across)
    at = [(k, base[c] + (my * v + dy) * shape[c][0] + mx * h + dx) for k, c in enumerate(comps) for h, v in [f.sampling[c]] for dy in range(v) for dx in range(h)]
    return np.stack([a for _, a in at], 1).ravel(), np.tile([k for k, _ in at], across * down), len(at)


def _scan(spec: tuple, members: list, files: list[bytes], orders: dict[tuple, tuple], store: np.ndarray) -> None:
    comps, first, last, high, low = spec
    tables: list[Huffman] = []
    block_of, comp_of, steps, counts, rows, regions = [], [], [], [], [], []
    for i, (_, used, interval, begin, end) in members:
        order, comp, in_mcu = orders[i, comps]
        block_of.append(order)
        comp_of.append(comp)
        steps.append((interval or len(order)) * in_mcu)
        counts.append(len(order))
        for t in used:
            if t is not None and t not in tables:
                tables.append(t)
        rows.append([tables.index(t) if t is not None else 0 for t in used])
        regions.append(np.frombuffer(files[i], np.uint8, end - begin, begin))
    step, count = np.array(steps), np.array(counts)
    segments = -(-count // step)
    inside = np.arange(segments.sum()) - np.repeat(np.cumsum(segments) - segments, segments)
    length = np.minimum(np.repeat(step, segments), np.repeat(count, segments) - np.repeat(step, segments) * inside)
    table = np.repeat(np.array(rows), segments, 0)
    raw, sizes = np.concatenate(regions), np.array([len(r) for r in regions])
    ff = np.concatenate([[False], raw[:-1] == 0xFF])
    ff[np.cumsum(sizes)[:-1][sizes[1:] > 0]] = False
    mark = ff & (raw >= 0xD0) & (raw <= 0xD7)
    drop = (ff & (raw == 0)) | mark | np.concatenate([mark[1:], [False]])
    kept = np.concatenate([[0], np.cumsum(~drop)])
    heads = np.concatenate([np.cumsum(sizes) - sizes, np.flatnonzero(mark) + 1])
    start = np.sort(heads)
    blocks, comp = np.concatenate(block_of), np.concatenate(comp_of)
    if len(start) != len(length):
        raise ValueError(f"{len(length)} restart segments are due and {len(start)} are there")
    bits = _Bits(raw[~drop], kept[start] * 8)
    lookup = np.stack([t.lookup for t in tables]) if tables else np.zeros((1, 1), np.int32)
    offset = np.cumsum(length) - length
    predicted = np.zeros((len(length), len(comps)), np.int64)
    eob = np.zeros(len(length), np.int64)
    for b in range(int(length.max(initial=0))):
        who = np.flatnonzero(length > b)
        at, k = blocks[offset[who] + b], comp[offset[who] + b]
        if first == 0 and high == 0:
            size = bits.symbol(who, lookup, table[np.arange(len(table)), 0] if len(comps) == 1 else _picked(table, who, k))
            predicted[who, k] += _signed(bits.take(who, size), size)
            store[at, 0] = predicted[who, k] << low
        elif first == 0:
            store[at, 0] |= bits.take(who, 1).astype(np.int32) << low
        elif high == 0:
            _ac_first(bits, lookup, table[:, 0], who, at, eob, first, last, low, store)
        else:
            _ac_refine(bits, lookup, table[:, 0], who, at, eob, first, last, low, store)


def _picked(table: np.ndarray, who: np.ndarray, k: np.ndarray) -> np.ndarray:
    out = np.zeros(len(table), np.int64)
    out[who] = table[who, k]
    return out


def _ac_first(bits: _Bits, lookup: np.ndarray, table: np.ndarray, who: np.ndarray, at: np.ndarray, eob: np.ndarray, first: int, last: int, low: int, store: np.ndarray) -> None:
    idle = eob[who] > 0
    eob[who[idle]] -= 1
    who, at = who[~idle], at[~idle]
    k, pos, one = np.full(len(who), first), bits.at[who], lookup[0] if len(lookup) == 1 else None
    while len(who):
        window = (bits.words[pos >> 3] << (pos & 7)) & 0xFFFFFFFF  # 25 bits at least
        got = one[window >> 16] if one is not None else lookup[table[who], window >> 16]
        n, run, size = got >> 8, (got >> 4) & 15, got & 15
        used = n + size
        v = (window >> (32 - used)) & ((1 << size) - 1)
        if (used > 25).any():  # long codes with many bits behind
            far = np.flatnonzero(used > 25)
            p = pos[far] + n[far]
            v[far] = ((bits.words[p >> 3] << (p & 7)) & 0xFFFFFFFF) >> (32 - size[far])
        pos = pos + used
        k = k + run
        if size.all():
            store[at, k] = _signed(v, size) << low
            k = k + 1
            on = k <= last
        else:
            ends = (size == 0) & (run < 15)
            e = np.flatnonzero(ends)
            bits.at[who[e]] = pos[e]
            eob[who[e]] = (1 << run[e]) - 1 + bits.take(who[e], run[e])
            pos[e] = bits.at[who[e]]
            put = np.flatnonzero(size)
            store[at[put], k[put]] = _signed(v[put], size[put]) << low
            k = k + 1
            on = ~ends & (k <= last)
        if not on.all():
            bits.at[who[~on]] = pos[~on]
            who, at, k, pos = who[on], at[on], k[on], pos[on]


def _ac_refine(bits: _Bits, lookup: np.ndarray, table: np.ndarray, who: np.ndarray, at: np.ndarray, eob: np.ndarray, first: int, last: int, low: int, store: np.ndarray) -> None:
    one = 1 << low
    block = store[at]
    run, new = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64)
    asks = eob[who] == 0  # whether the next coefficient needs a symbol
    for k in range(first, last + 1):
        if asks.any():
            w = np.flatnonzero(asks)
            s = bits.symbol(who[w], lookup, table)
            r, size = s >> 4, s & 15
            ends = (size == 0) & (r < 15)
            if ends.any():
                e = who[w[ends]]
                eob[e] = (1 << r[ends]) + bits.take(e, r[ends])
            run[w] = np.where(ends, 99, r)
            fresh = w[size > 0]
            new[w] = 0
            if len(fresh):
                new[fresh] = np.where(bits.take(who[fresh], 1) > 0, one, -one)
            asks[w] = False
        if k == first and (eob[who] > 0).all():
            # within end-of-band runs there are correction bits alone: all of them at once
            part = block[:, first : last + 1]
            old = part != 0
            count = np.cumsum(old, 1)
            pos = bits.at[who][:, None] + count - 1
            bit = (bits.data[pos >> 3] >> (7 - (pos & 7))) & 1
            store[at, first : last + 1] = np.where(old & (bit > 0) & ((np.abs(part) & one) == 0), part + np.sign(part) * one, part)
            bits.at[who] += count[:, -1]
            eob[who] -= 1
            return
        c = block[:, k]
        old = c != 0
        if old.any():
            o = np.flatnonzero(old)
            bit = bits.take(who[o], 1)
            block[o, k] += (np.sign(c[o]) * bit * one * ((np.abs(c[o]) & one) == 0)).astype(block.dtype)
        if not old.all():
            z = np.flatnonzero(~old & (run < 99))
            if len(z):
                here = z[run[z] == 0]
                block[here, k] = new[here]
                asks[here] = True
                run[z] -= 1
    asks &= run < 99
    run[:] = 0
    store[at, first : last + 1] = block[:, first : last + 1]
    held = eob[who] > 0
    eob[who[held]] -= 1


_COSINES = np.array([[(0.5 if u else 0.5 / np.sqrt(2)) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)], np.float32)


def planes(coefficients: np.ndarray, quant: np.ndarray, across: int) -> np.ndarray:
    """Samples 0 to 255 of a component, by the inverse cosine transform of its blocks."""
    flat = np.zeros((len(coefficients), 64), np.float32)
    flat[:, ZIGZAG] = coefficients * quant
    x = flat.reshape(-1, 8) @ _COSINES
    x = x.reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 8) @ _COSINES  # columns
    x = x.reshape(-1, 8, 8).transpose(0, 2, 1) + 128
    down = len(coefficients) // across
    return np.clip(x, 0, 255).reshape(down, across, 8, 8).transpose(0, 2, 1, 3).reshape(8 * down, 8 * across)


def rgb(f: Frame, coefficients: list[np.ndarray]) -> np.ndarray:
    """The picture in full resolution: height, width, 3 bytes. Chroma is repeated to the size of luma."""
    hmax, vmax = (max(s[i] for s in f.sampling) for i in (0, 1))
    full = []
    for (h, v), q, c in zip(f.sampling, f.quant, coefficients, strict=True):
        p = planes(c, q, f.mcus[0] * h)
        full.append(np.repeat(np.repeat(p, vmax // v, 0), hmax // h, 1)[: f.height, : f.width])
    y = full[0]
    if len(full) == 1:
        return np.repeat(np.rint(y).astype(np.uint8)[..., None], 3, 2)
    cb, cr = full[1] - 128, full[2] - 128
    out = np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], 2)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)
