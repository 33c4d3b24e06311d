import hashlib
import random
import zlib

import numpy as np
import pytest

from arbora.llm import flac as K

SCHEMA = "doc_id long, text string, media string"


def slow_decode(m):
    """Bit by bit, frame after frame, without the seek table."""
    at, last = 4, False
    while not last:
        last, size = m[at] >> 7, int.from_bytes(m[at + 1 : at + 4], "big")
        at += 4 + size
    bits = "".join(f"{b:08b}" for b in m[at:])
    p, out = 0, bytearray()

    def take(n):
        nonlocal p
        p += n
        return int(bits[p - n : p] or "0", 2)

    def signed(n):
        v = take(n)
        return v - (1 << n) if n and v >> (n - 1) else v

    while p < len(bits):
        assert take(14) == 0x3FFE
        take(2)
        code, _, _ = take(4), take(4), take(8)
        lead = take(8)
        take(8 * (0 if lead < 128 else 7 - (lead ^ 0xFF).bit_length()))
        size = take(16) + 1 if code == 7 else K.SIZES[code]
        take(8)
        kind = take(8) >> 1
        if kind == 0:
            x = [signed(8)] * size
        elif kind == 1:
            x = [signed(8) for _ in range(size)]
        else:
            order = kind - 8 if kind < 32 else kind - 31
            x = [signed(8) for _ in range(order)]
            coef, shift = K.FIXED[order] if kind < 32 else [], 0
            if kind >= 32:
                width = take(4) + 1
                shift = signed(5)
                coef = [signed(width) for _ in range(order)]
            assert take(2) == 0
            parts = take(4)
            for i in range(1 << parts):
                k = take(4)
                for _ in range((size >> parts) - (order if i == 0 else 0)):
                    q = 0
                    while not take(1):
                        q += 1
                    u = q << k | take(k)
                    x.append(((u >> 1) ^ -(u & 1)) + (sum(c * x[-1 - j] for j, c in enumerate(coef)) >> shift))
        p = -(-p // 8) * 8
        take(16)
        out += bytes(v + 128 for v in x)
    return bytes(out)


def payloads():
    rng = random.Random(16)
    wave = bytes(int(128 + 90 * np.sin(i / 9)) for i in range(192 * 13))
    noise = rng.randbytes(192 * 7)
    steps = bytes(rng.choice([0, 255]) if rng.random() < 0.01 else 100 for _ in range(1152 * 3))
    text = ("The quick été brown 日本 fox. " * 300).encode()
    return [b"", b" " * 192, wave, noise, steps, K.payload_of(text.decode()), bytes(range(256)) * 9, b"\x00" * 1152 + b"\xff" * 1152, K.payload_of("x" * 2_000_000)]


def test_round_trip_and_slow_decoder():
    made = K.encode(payloads())
    for p, m, blocks in zip(payloads(), made, K.decode(made), strict=True):
        assert b"".join(b for _, b in blocks) == p
        assert [a for a, _ in blocks] == list(range(0, len(p), K.BLOCK))
        if len(p) < 100_000:
            assert slow_decode(m) == p
    kinds = {m[K.metadata(m)[3] + 6] >> 1 for m in made if len(m) > 60}
    assert {0, 1} <= kinds and any(k >= 32 for k in kinds) or any(8 <= k <= 12 for k in kinds)
    assert len(made[2]) < 0.6 * len(payloads()[2])


def test_linear_predictor_and_seek():
    rng = np.random.default_rng(17)
    x = np.zeros(192 * 40)
    for i in range(3, len(x)):
        x[i] = 1.5 * x[i - 1] - 0.8 * x[i - 2] + rng.normal() * 6
    p = np.clip(x + 128, 0, 255).astype(np.uint8).tobytes()
    (m,) = K.encode([p])
    assert m[K.metadata(m)[3] + 6] >> 1 == 32 + K.LPC_ORDER - 1 and slow_decode(m) == p
    for first, n in ((0, 10), (1100, 200), (5000, 2680), (7679, 5), (1152, 1152)):
        assert K.read_samples(m, first, n) == p[first : first + n]


def test_partitions_and_escapes():
    """A frame with partitions, one of them escaped, as other encoders write them."""
    samples = [3, 4, 5, 6] * 24 + [100, -100, 7, 0] * 24
    bits = f"{8:07b}0" + "00" + f"{1:04b}" + f"{2:04b}"
    for s in samples[:96]:
        u = 2 * s if s >= 0 else -2 * s - 1
        bits += "0" * (u >> 2) + "1" + f"{u & 3:02b}"
    bits += "1111" + f"{8:05b}" + "".join(f"{s & 255:08b}" for s in samples[96:])
    body = K.frame_header(0, 192) + int(bits + "0" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big")
    check = K.crc16(np.frombuffer(body, dtype=np.uint8), np.array([0]), np.array([len(body)]))[0]
    frame = body + int(check).to_bytes(2, "big")
    got, size = K.decode_frames(frame, np.array([0]), np.array([len(frame)]))
    assert size[0] == 192 and got[:, 0].tolist() == samples


def test_damage_is_found():
    (m,) = K.encode([K.payload_of("some text " * 500)])
    first = K.metadata(m)[3]
    for at in (first + 4, first + 40, len(m) - 1, 30):
        bad = bytearray(m)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            K.decode([bytes(bad)])


def test_columns(spark):
    texts = [None, "", "a", "é" * 96, "x" * 192, "x" * 193, "long text " * 40_000, "a"]
    df = spark.createDataFrame([(i if i != 5 else None, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in K.media_digests(df).collect()}
    for i, t in enumerate(texts):
        r, data = got[i if i != 5 else None], (t or "").encode()
        padded = data + b" " * (max(192, -(-len(data) // 192) * 192) - len(data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
    assert got[2][2:] == got[7][2:]
    blocks = K.pcm_blocks(K.with_media(df)).where("doc_id = 6").orderBy("block").collect()
    assert b"".join(b.pcm for b in blocks).rstrip() == ("long text " * 40_000).rstrip().encode()
    assert [b.first_sample for b in blocks[:3]] == [0, 1152, 2304]
    assert K.media_digests(df.limit(0)).collect() == [] and K.media_digests(df.unionByName(df)).count() == 16
