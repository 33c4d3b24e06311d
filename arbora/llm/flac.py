"""FLAC media columns: mono 8-bit streams, coded and decoded for many frames at a time.

Encoder: frames of BLOCK samples; each takes the cheapest of a constant, the fixed predictors of order 0 to 4, a
quantised linear predictor of order LPC_ORDER and verbatim samples.  The seek table has a point for every frame, so a
reader finds any sample, and the decoder all frames, without scanning.

Decoder: all frames of a slice advance in lockstep, one sample a step: a 64-bit window at each frame's bit position
gives the Rice code (or escaped residual), the predictor adds what it expects.  CRC-8 of headers, CRC-16 of frames
and the MD5 of the stream are verified; a mismatch raises.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.shared import new_path
from arbora.llm.tokens import memo

BLOCK = 1152
UNIT = 192
RATE = 16_000
LPC_ORDER = 4
PRECISION = 12
SLICE_BYTES = 1_500_000
#: A seek point, and how many a metadata block of 24 bits of length holds; longer streams have several.
POINT = np.dtype([("sample", ">u8"), ("offset", ">u8"), ("size", ">u2")])
MOST_POINTS = ((1 << 24) - 1) // 18
#: Fixed values of the format: coefficients of the fixed predictors, block size codes, and those of an explicit size.
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]
SIZES = {1: 192, 2: 576, 3: 1152, 4: 2304, 5: 4608, 8: 256, 9: 512, 10: 1024, 11: 2048, 12: 4096, 13: 8192, 14: 16384, 15: 32768}


def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, table = 1 << (bits - 1), []
    for x in range(256):
        c = x << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ (poly if c & top else 0)
        table.append(c & (1 << bits) - 1)
    return np.array(table, dtype=np.int64)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    c = 0
    for x in data:
        c = int(CRC8[c ^ x])
    return c


def crc16(buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-16 of many byte ranges at once."""
    order = np.argsort(-length, kind="stable")
    at, size = start[order], length[order]
    c = np.zeros(len(at), dtype=np.int64)
    active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    for i, n in enumerate(active):
        head = c[:n]
        c[:n] = ((head << 8) & 0xFFFF) ^ CRC16[(head >> 8) ^ buffer[at[:n] + i]]
    out = np.empty_like(c)
    out[order] = c
    return out


@memo(100_000)
def frame_header(number: int, size: int) -> bytes:
    if number < 0x80:
        coded = bytes([number])
    else:
        extra = 1 + (number >= 1 << 11) + (number >= 1 << 16) + (number >= 1 << 21) + (number >= 1 << 26)
        tail = [0x80 | number >> 6 * i & 0x3F for i in reversed(range(extra))]
        coded = bytes([(0xFF << (7 - extra) & 0xFF) | number >> 6 * extra, *tail])
    known = {v: k for k, v in SIZES.items()}.get(size, 7)
    head = bytes([0xFF, 0xF8, known << 4 | 5, 0x02]) + coded + (struct.pack(">H", size - 1) if known == 7 else b"")
    return head + bytes([crc8(head)])


@memo(100_000)
def read_header(head: bytes) -> tuple[int, int]:
    """Block size of a whole frame header, and its length; raises ValueError."""
    if head[0] != 0xFF or head[1] != 0xF8 or head[3] not in (0x02, 0x00):
        raise ValueError("no frame of 8-bit mono")
    if crc8(head[:-1]) != head[-1]:
        raise ValueError("frame header checksum")
    code = head[2] >> 4
    size = head[-2] + 1 if code == 6 else struct.unpack(">H", head[-3:-1])[0] + 1 if code == 7 else SIZES[code]
    return size, len(head)


def header_length(buffer: bytes, at: int) -> int:
    lead, code, rate = buffer[at + 4], buffer[at + 2] >> 4, buffer[at + 2] & 15
    coded = 1 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length()
    return 4 + coded + (code == 6) + 2 * (code == 7) + (rate == 12) + 2 * (rate in (13, 14)) + 1


def _levinson(r: np.ndarray) -> np.ndarray:
    """Predictor coefficients (frames, LPC_ORDER) from autocorrelations (frames, LPC_ORDER + 1)."""
    n, p = len(r), LPC_ORDER
    a, err = np.zeros((n, p)), r[:, 0] * (1 + 1e-9) + 1e-9
    for i in range(p):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / err
        new = a.copy()
        new[:, i] = k
        new[:, :i] = a[:, :i] - k[:, None] * a[:, i - 1 :: -1][:, :i] if i else new[:, :i]
        a, err = new, np.maximum(err * (1 - k * k), 1e-9)
    return a


class _Bits:
    def __init__(self, n_bytes: int):
        self.bits = np.zeros(n_bytes * 8, dtype=np.uint8)

    def put(self, at: np.ndarray, value: np.ndarray, width: int) -> None:
        for b in range(width):
            self.bits[at + b] = (value >> (width - 1 - b)) & 1


def encode_frames(pieces: list[memoryview], first: list[int], block: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The frames of the pieces, the first of which has the given number, in a row; their sizes, and how many each piece has."""
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"".join(pieces) + bytes(block), dtype=np.uint8)
    frames = -(-lengths // block)
    owner = np.repeat(np.arange(len(pieces)), frames)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(frames) - frames, frames)
    number = place + np.array(first, dtype=np.int64)[owner]
    starts = np.cumsum(lengths) - lengths
    size = np.minimum(block, lengths[owner] - place * block)
    n = len(owner)
    column = np.arange(block)
    real = column < size[:, None]
    x = np.where(real, data[(starts[owner] + place * block)[:, None] + column].astype(np.int32) - 128, 0)

    # residuals of each predictor; kinds 0 to 4 are fixed orders, 5 is the linear predictor
    best_cost, kind, residual = np.full(n, np.inf), np.zeros(n, dtype=np.int64), x.copy()
    d, orders = x, [0, 1, 2, 3, 4, LPC_ORDER]
    f = x.astype(np.float32)
    auto = np.stack([np.einsum("ij,ij->i", f[:, j:], f[:, : block - j]) for j in range(LPC_ORDER + 1)], 1).astype(np.float64)
    c = _levinson(auto)
    shift = np.clip(PRECISION - 2 - np.ceil(np.log2(np.abs(c).max(1) + 1e-12)), 0, 15).astype(np.int64)
    limit = 1 << (PRECISION - 1)
    coef = np.clip(np.round(c * (1 << shift)[:, None]), -limit, limit - 1).astype(np.int64)
    for k in range(6):
        if k == 5:
            guess = np.zeros((n, block), dtype=np.int32)
            for j in range(LPC_ORDER):
                guess[:, j + 1 :] += coef[:, j : j + 1].astype(np.int32) * x[:, : block - j - 1]
            d = x - (guess >> shift[:, None].astype(np.int32))
        elif k:
            d = np.concatenate([d[:, :1], d[:, 1:] - d[:, :-1]], 1)
        used = np.abs(d[:, orders[k] :]) * real[:, orders[k] :]
        cost = used.sum(1) + 6.0 * orders[k] + 8.0 * LPC_ORDER * (k == 5)
        better = cost < best_cost
        best_cost[better], kind[better] = cost[better], k
        residual[better] = d[better]
    order = np.array(orders)[kind]
    coded = real & (column >= order[:, None])
    u = ((residual << 1) ^ (residual >> 31)) * coded
    count = np.maximum(1, coded.sum(1))
    total = u.sum(1)
    k0 = np.clip(np.floor(np.log2(np.maximum(total / count, 1e-9))), 0, 13).astype(np.int64)
    bits_at = lambda k: (u >> k[:, None].astype(np.int32)).sum(1) + count * (1 + k)
    low, high = bits_at(k0), bits_at(k0 + 1)
    k = np.where(high < low, k0 + 1, k0)
    rice_bits = np.minimum(low, high)
    constant = np.where(real, x == x[:, :1], True).all(1)
    verbatim = ~constant & (rice_bits + 8 * order >= 8 * size)
    plain = ~constant & ~verbatim

    heads = [frame_header(int(a), int(b)) for a, b in zip(number, size, strict=True)]
    head_size = np.array([len(h) for h in heads], dtype=np.int64)
    linear = plain & (kind == 5)
    before = 8 * head_size + 8 + 8 * order * plain + linear * (9 + PRECISION * LPC_ORDER) + 10 * plain
    body = np.where(plain, rice_bits, np.where(constant, 8, 8 * size))
    frame_bytes = -(-(before + body) // 8) + 2
    frame_at = np.cumsum(frame_bytes) - frame_bytes
    out = _Bits(int(frame_bytes.sum()))
    at = 8 * (frame_at + head_size)
    subtype = np.where(constant, 0, np.where(verbatim, 1, np.where(linear, 32 + LPC_ORDER - 1, 8 + order)))
    out.put(at, subtype << 1, 8)
    at = at + 8
    some = np.flatnonzero(constant)
    out.put(at[some], x[some, 0] & 255, 8)
    raw = np.nonzero(verbatim[:, None] & real)
    out.put(at[raw[0]] + 8 * raw[1], x[raw] & 255, 8)
    for j in range(4):
        some = np.flatnonzero(plain & (order > j))
        out.put(at[some], x[some, j] & 255, 8)
        at[some] += 8
    some = np.flatnonzero(linear)
    out.put(at[some], np.full(len(some), PRECISION - 1), 4)
    out.put(at[some] + 4, shift[some], 5)
    for j in range(LPC_ORDER):
        out.put(at[some] + 9 + PRECISION * j, coef[some, j] & (1 << PRECISION) - 1, PRECISION)
    at[some] += 9 + PRECISION * LPC_ORDER
    some = np.flatnonzero(plain)
    out.put(at[some] + 6, k[some], 4)  # coding method 0 and partition order 0 are zeros
    at[some] += 10
    row, col = np.nonzero(coded & plain[:, None])
    value, kk = u[row, col].astype(np.int64), k[row]
    q = value >> kk
    width = q + 1 + kk
    ends = np.cumsum(width)
    first = np.searchsorted(row, some)
    base = np.zeros(n, dtype=np.int64)
    base[some] = at[some] - (ends[first] - width[first]) if len(row) else 0
    last_bit = base[row] + ends - 1
    value = (value & (1 << kk) - 1) | (1 << kk)
    for b in range(int(kk.max(initial=0)) + 1):
        has = kk >= b
        out.bits[last_bit[has] - b] = (value[has] >> b) & 1
    packed = np.packbits(out.bits)
    for i in range(int(head_size.max(initial=0))):
        has = np.flatnonzero(head_size > i)
        packed[frame_at[has] + i] = np.array([heads[h][i] for h in has], dtype=np.uint8)
    check = crc16(packed, frame_at, frame_bytes - 2)
    packed[frame_at + frame_bytes - 2], packed[frame_at + frame_bytes - 1] = check >> 8, check & 255

    return packed.tobytes(), frame_bytes, frames


def _frame_runs(lengths: list[int], unit: int, most: int) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of (item, from, to) that cover all items in order, cut at multiples of ``unit`` so that a run holds about ``most``."""
    run, room, step = [], most, max(unit, most // unit * unit)
    for i, n in enumerate(lengths):
        at = 0
        while at < n:
            if room < unit and run:
                yield run
                run, room = [], most
            end = min(n, at + max(unit, min(step, room // unit * unit)))
            run.append((i, at, end))
            room -= end - at
            at = end
    if run:
        yield run


def encode(payloads: list[bytes], block: int = BLOCK) -> list[bytes]:
    """The FLAC stream of each payload, whose bytes, less 128, are the samples.  An empty payload has no frame.

    Frames are made for about SLICE_BYTES of samples at a time, whether these are many payloads or a part of one.
    """
    bodies, sizes = [[] for _ in payloads], [[] for _ in payloads]
    for run in _frame_runs([len(p) for p in payloads], block, SLICE_BYTES):
        whole, each, frames = encode_frames([memoryview(payloads[i])[a:b] for i, a, b in run], [a // block for _, a, _ in run], block)
        f0, at = 0, 0
        for (i, _, _), f in zip(run, frames.tolist(), strict=True):
            own = each[f0 : f0 + f]
            bodies[i].append(whole[at : at + int(own.sum())])
            sizes[i].append(own)
            f0, at = f0 + f, at + int(own.sum())
    streams = []
    for payload, body, parts in zip(payloads, bodies, sizes, strict=True):
        own = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        low, high = (int(own.min()), int(own.max())) if len(own) else (0, 0)
        md5 = hashlib.md5()
        for k in range(0, len(payload), SLICE_BYTES):
            md5.update((np.frombuffer(payload[k : k + SLICE_BYTES], dtype=np.uint8) ^ 128).tobytes())
        info = struct.pack(">HH", block, block) + struct.pack(">I", low)[1:] + struct.pack(">I", high)[1:] + struct.pack(">Q", RATE << 44 | 7 << 36 | len(payload)) + md5.digest()
        points = np.zeros(len(own), dtype=POINT)
        points["sample"] = np.arange(len(own)) * block
        points["offset"], points["size"] = np.cumsum(own) - own, np.minimum(block, len(payload) - np.arange(len(own)) * block)
        tables = [points[k : k + MOST_POINTS].tobytes() for k in range(0, max(1, len(points)), MOST_POINTS)]
        head = [b"fLaC", b"\x00", struct.pack(">I", len(info))[1:], info]
        for k, table in enumerate(tables):
            head += [b"\x83" if k == len(tables) - 1 else b"\x03", struct.pack(">I", len(table))[1:], table]
        streams.append(b"".join(head + body))
    return streams


def metadata(media: bytes) -> tuple[int, bytes, np.ndarray, int]:
    """Samples, MD5, seek points (sample, offset, size), and where frames start."""
    if media[:4] != b"fLaC":
        raise ValueError("no FLAC stream")
    at, last, info, tables = 4, False, b"", [np.zeros(0, dtype=POINT)]
    while not last:
        last, kind, size = media[at] >> 7, media[at] & 127, int.from_bytes(media[at + 1 : at + 4], "big")
        body = bytes(media[at + 4 : at + 4 + size])
        if kind == 0:
            info = body
        elif kind == 3:
            tables.append(np.frombuffer(body, dtype=POINT))
        at += 4 + size
    packed = struct.unpack(">Q", info[10:18])[0]
    if packed >> 41 & 7 or (packed >> 36 & 31) != 7:
        raise ValueError("only mono streams of 8 bits")
    return packed & (1 << 36) - 1, info[18:34], np.concatenate(tables), at


_CLZ16 = np.array([16 if x == 0 else 16 - int(x).bit_length() for x in range(1 << 16)], dtype=np.int64)


def decode_frames(buffer: bytes, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples (largest block size, frames) and block size of the frames at ``start``, their checksums verified."""
    n = len(start)
    data = np.frombuffer(buffer + bytes(16), dtype=np.uint8)
    stored = data[start + length - 2].astype(np.int64) << 8 | data[start + length - 1]
    if (crc16(data, start, length - 2) != stored).any():
        raise ValueError("frame checksum")
    found = [read_header(buffer[s : s + header_length(buffer, s)]) for s in start.tolist()]
    size = np.array([a for a, _ in found], dtype=np.int64)
    by = np.argsort(-size, kind="stable")
    start, length, size = start[by], length[by], size[by]
    at = 8 * (start + np.array([b for _, b in found], dtype=np.int64)[by])
    word = np.zeros(len(data) - 8, dtype=np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | data[i : len(data) - 8 + i]

    def window(p: np.ndarray) -> np.ndarray:
        return word[p >> 3] << (p & 7).astype(np.uint64)

    def take(p: np.ndarray, width: int) -> np.ndarray:
        return (window(p) >> np.uint64(64 - width)).astype(np.int64)

    signed = lambda v, width: v - ((v >> (width - 1)) << width)
    subtype = take(at, 8)
    if (subtype & 1).any() or (subtype >> 7).any():
        raise ValueError("wasted bits are not supported")
    subtype, at = subtype >> 1, at + 8
    most = int(size[0]) if n else 0
    x = np.zeros((most + 32, n), dtype=np.int64)  # rows 0 to 31 stand before the first sample
    out = x[32:]
    fixed, linear = (subtype >= 8) & (subtype <= 12), subtype >= 32
    order = np.where(fixed, subtype - 8, np.where(linear, subtype - 31, 0))
    if (~fixed & ~linear & (subtype > 1)).any():
        raise ValueError("reserved subframe")
    for i in np.flatnonzero(subtype == 0):
        out[: size[i], i] = signed(int(take(at[i : i + 1], 8)[0]), 8)
    for i in np.flatnonzero(subtype == 1):
        first = at[i] >> 3
        out[: size[i], i] = data[first : first + size[i]].view(np.int8)
    predicted = fixed | linear
    depth = int(order.max(initial=0))
    for j in range(depth):
        some = np.flatnonzero(order > j)
        out[j, some] = signed(take(at[some], 8), 8)
        at[some] += 8
    coef, shift = np.zeros((32, n), dtype=np.int64), np.zeros(n, dtype=np.int64)
    for o, values in enumerate(FIXED):
        for j, v in enumerate(values):
            coef[j, fixed & (order == o)] = v
    some = np.flatnonzero(linear)
    if len(some):
        precision = take(at[some], 4) + 1
        shift[some] = signed(take(at[some] + 4, 5), 5)
        at[some] += 9
        for j in range(depth):
            has = order[some] > j
            lane, width = some[has], precision[has]
            raw = (window(at[lane]) >> (64 - width).astype(np.uint64)).astype(np.int64)
            coef[j, lane] = raw - ((raw >> (width - 1)) << width)
            at[lane] += width
    method, parts = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    some = np.flatnonzero(predicted)
    method[some], parts[some] = take(at[some], 2), take(at[some] + 2, 4)
    at[some] += 6
    if (method > 1).any():
        raise ValueError("reserved residual coding")
    bits_of_k, per_part = 4 + method, np.maximum(1, size >> parts)
    k, raw_width = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    active = np.searchsorted(-size, -np.arange(most), "left")
    next_part = np.where(predicted, 0, most + 1)
    for i in range(most):
        m = int(active[i])
        fresh = np.flatnonzero((next_part[:m] <= i) & (order[:m] <= i))
        if len(fresh):
            width = bits_of_k[fresh]
            value = (window(at[fresh]) >> (64 - width).astype(np.uint64)).astype(np.int64)
            at[fresh] += width
            escaped = value == (1 << width) - 1
            k[fresh], raw_width[fresh] = value, -1
            lanes = fresh[escaped]
            raw_width[lanes] = take(at[lanes], 5)
            at[lanes] += 5
            next_part[fresh] = (i // per_part[fresh] + 1) * per_part[fresh]
        lane = slice(0, m) if predicted[:m].all() and i >= depth else np.flatnonzero(predicted[:m] & (order[:m] <= i))
        p, kk = at[lane], k[lane]
        w = window(p)
        q = _CLZ16[(w >> np.uint64(48)).astype(np.int64)]
        long = np.flatnonzero(q == 16)
        for j in long:  # a long run of zeros
            if raw_width[lane][j] < 0:
                here = int(p[j])
                while not take(np.array([here]), 1)[0]:
                    here += 1
                q[j] = here - int(p[j])
        body = p + q + 1
        low = np.where(kk > 0, window(body) >> (64 - np.maximum(kk, 1)).astype(np.uint64), np.uint64(0)).astype(np.int64)
        u = q << kk | low
        r = (u >> 1) ^ -(u & 1)
        moved = body + kk
        raw = raw_width[lane]
        if (raw >= 0).any():
            width = np.maximum(raw, 1)
            v = (w >> (64 - width).astype(np.uint64)).astype(np.int64)
            v = np.where(raw > 0, v - ((v >> (width - 1)) << width), 0)
            r, moved = np.where(raw >= 0, v, r), np.where(raw >= 0, p + np.maximum(raw, 0), moved)
        at[lane] = moved
        guess = 0
        for j in range(depth):
            guess = guess + coef[j, lane] * x[31 + i - j, lane]
        out[i, lane] = r + (guess >> shift[lane]) if depth else r
    if (at[predicted] > 8 * (start + length - 2)[predicted]).any():
        raise ValueError("frame overrun")
    samples, sizes = np.empty_like(out), np.empty_like(size)
    samples[:, by], sizes[by] = out, size
    return samples, sizes


def _blocks(media: list[bytes], heads: list[tuple]) -> Iterator[tuple[int, int, bytes]]:
    """(stream, first sample, unsigned 8-bit samples) of every frame in order; about SLICE_BYTES of samples are decoded at a time."""
    counts = [len(points) for _, _, points, _ in heads]
    widest = max((int(points["size"].max()) for _, _, points, _ in heads if len(points)), default=1)
    for run in _frame_runs(counts, 1, max(1, SLICE_BYTES // max(1, widest))):
        buffer, starts, lengths, base = [], [], [], 0
        for i, a, b in run:
            _, _, points, first = heads[i]
            offset = points["offset"][a:b].astype(np.int64)
            end = int(points["offset"][b]) if b < counts[i] else len(media[i]) - first
            buffer.append(media[i][first + int(offset[0]) : first + end])
            starts.append(base + offset - offset[0])
            lengths.append(np.diff(np.append(offset, end)))
            base += end - int(offset[0])
        samples, sizes = decode_frames(b"".join(buffer), np.concatenate(starts), np.concatenate(lengths))
        octets = np.ascontiguousarray(samples.T) + 128
        if octets.size and (octets.min() < 0 or octets.max() > 255):
            raise ValueError("sample out of range")
        octets, f = octets.astype(np.uint8), 0
        for i, a, b in run:
            for j in range(a, b):
                yield i, int(heads[i][2]["sample"][j]), octets[f, : sizes[f]].tobytes()
                f += 1


def decoded(media: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(stream, first sample, samples) of every block of every stream in order; a stream that ends with another MD5 or length raises."""
    heads = [metadata(m) for m in media]
    md5, seen = [hashlib.md5() for _ in media], [0] * len(media)
    for i, first, pcm in _blocks(media, heads):
        md5[i].update((np.frombuffer(pcm, dtype=np.uint8) ^ 128).tobytes())
        seen[i] += len(pcm)
        yield i, first, pcm
    for (total, digest, _, _), own, n in zip(heads, md5, seen, strict=True):
        if n != total or own.digest() != digest:
            raise ValueError("stream differs from its MD5")


def decode(media: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """Of each stream its PCM blocks: (first sample, unsigned 8-bit samples), verified."""
    out: list[list[tuple[int, bytes]]] = [[] for _ in media]
    for i, first, pcm in decoded(media):
        out[i].append((first, pcm))
    return out


def read_samples(media: bytes, first: int, n: int) -> bytes:
    """``n`` samples from ``first`` on, decoding only the frames that hold them."""
    _, _, points, at = metadata(media)
    sample, offset = points["sample"].astype(np.int64), points["offset"].astype(np.int64)
    a, b = max(0, int(np.searchsorted(sample, first, "right")) - 1), int(np.searchsorted(sample, first + n, "left"))
    if b <= a:
        return b""
    ends = np.append(offset[1:], len(media) - at)
    samples, sizes = decode_frames(media, at + offset[a:b], ends[a:b] - offset[a:b])
    whole = b"".join((samples[: sizes[j], j] + 128).astype(np.uint8).tobytes() for j in range(b - a))
    return whole[first - int(sample[a]) :][:n]


def payload_of(text: str | None) -> bytes:
    """UTF-8, padded with spaces to a positive multiple of UNIT bytes."""
    data = (text or "").encode("utf-8", "replace")
    return data + b" " * (max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data))


class Digest:
    """What is computed of a payload block by block: length, SHA-256, CRC-32 of the last 16 bytes, and features.

    The features are sum, energy, zero crossings, least and greatest of the signed samples.
    """

    def __init__(self):
        self.n, self.sha, self.tail = 0, hashlib.sha256(), b""
        self.sum, self.energy, self.crossings, self.low, self.high = 0, 0, 0, 0, 0

    def add(self, pcm: bytes) -> None:
        before = self.tail[-1:]
        self.sha.update(pcm)
        self.n, self.tail = self.n + len(pcm), (self.tail + pcm)[-16:]
        x = np.frombuffer(before + pcm, dtype=np.uint8).astype(np.int64) - 128
        self.crossings += int(((x[1:] < 0) != (x[:-1] < 0)).sum())
        x = x[len(before) :]
        self.sum, self.energy = self.sum + int(x.sum()), self.energy + int((x * x).sum())
        self.low, self.high = min(self.low, int(x.min(initial=0))), max(self.high, int(x.max(initial=0)))

    def row(self) -> tuple[int, str, int, str]:
        return self.n, self.sha.hexdigest(), zlib.crc32(self.tail), f"sum={self.sum};energy={self.energy};crossings={self.crossings};min={self.low};max={self.high}"


def digests(media: list[bytes]) -> list[tuple]:
    """(payload bytes, SHA-256, CRC-32 of the tail, features) of each stream, decoded and verified."""
    found, now, at = [Digest() for _ in media], [], -1
    for i, _, pcm in decoded(media):
        if i != at or sum(map(len, now)) > SLICE_BYTES:  # a payload's blocks are added together
            if now:
                found[at].add(b"".join(now))
            now, at = [], i
        now.append(pcm)
    if now:
        found[at].add(b"".join(now))
    return [d.row() for d in found]


def _runs(sizes: list[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, s in enumerate(sizes):
        if i > first and total + s > most:
            yield first, i
            first, total = i, 0
        total += s
    if first < len(sizes):
        yield first, len(sizes)


def with_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: the FLAC stream of every whole text; null and empty texts are UNIT spaces."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for a, b in _runs(sizes):
                media = encode([payload_of(t) for t in texts.slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes[a:b], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(store, f"doc_id {id_type}, n_bytes long, media binary")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """doc_id, block, first_sample, n_samples, pcm: the decoded blocks of a media column, each at its sample offset."""
    id_type = media.schema["doc_id"].dataType.simpleString()

    def made(keys: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        cells = list(zip(*rows, strict=True))
        arrays = [keys.take(pa.array(cells[0], pa.int64())), pa.array(cells[1], pa.int32()), pa.array(cells[2], pa.int64()), pa.array(cells[3], pa.int32()), pa.array(cells[4], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "block", "first_sample", "n_samples", "pcm"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, streams = batch.column(0), batch.column(1).to_pylist()
            for a, b in _runs([len(s) for s in streams]):
                rows, size, j, last = [], 0, 0, -1
                for i, first, pcm in decoded(streams[a:b]):
                    j, last = j + 1 if i == last else 0, i
                    rows.append((a + i, j, first, len(pcm), pcm))
                    size += len(pcm)
                    if size > SLICE_BYTES:
                        yield made(keys, rows)
                        rows, size = [], 0
                if rows:
                    yield made(keys, rows)

    return media.select("doc_id", "media").mapInArrow(blocks, f"doc_id {id_type}, block int, first_sample long, n_samples int, pcm binary")


def media_digests(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    Streams are written to a file in the shared folder, a file for each run of about SLICE_BYTES or one longer text, and
    all further columns come from what is read back; the file then goes, so that the streams of a corpus, hardly smaller
    than its texts, never lie there together.  Rows with a null id and repeated rows are stored like any other; null
    texts are empty; equal texts give equal streams; other columns are not read.  A very long text is coded and decoded
    in runs of frames.
    """
    id_type, folder = docs.schema["doc_id"].dataType.simpleString(), new_path(docs.sparkSession, "media")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            streams = batch.column(2)
            for a, b in _runs(pc.binary_length(streams).to_pylist()):
                path, at = f"{root}/{uuid.uuid4().hex}.flac", [0]
                with store.open_output_stream(path, compression=None) as out:
                    for m in streams.slice(a, b - a):
                        out.write(m.as_buffer())
                        at.append(at[-1] + m.as_buffer().size)
                with store.open_input_file(path) as file:
                    media = [file.read_at(y - x, x) for x, y in zip(at, at[1:], strict=False)]
                store.delete_file(path)
                rows = [(*row[:3], len(m), hashlib.sha256(m).hexdigest(), row[3]) for m, row in zip(media, digests(media), strict=True)]
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *made], names=names)

    schema = f"doc_id {id_type}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return with_media(docs).mapInArrow(digest, schema)
