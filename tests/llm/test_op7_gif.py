import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from matchcast.llm import gif_media as op
from matchcast.llm import queries
from tests.llm.cases import ROWS, frame

#: A public example of the format: 10 x 10 samples of four colours, with its code stream.
SAMPLE = bytes.fromhex("47494638396" "10a000a00910000ffffffff00000000ff00000021f90400000000002c000000000a000a000002168c2d99872a1cdc33a00275ec95faa8de608c04914c0100" "3b")


def test_known_file():
    frame_ = next(op.decode(SAMPLE))
    want = ["1111122222"] * 3 + ["1110000222"] * 2 + ["2220000111"] * 2 + ["2222211111"] * 3
    assert ["".join(map(str, r)) for r in frame_.samples.tolist()] == want
    assert frame_.canvas[0, 0].tolist() == [255, 0, 0, 255] and frame_.canvas[0, 9].tolist() == [0, 0, 255, 255]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.integers(1, 40))
def test_codes_round_trip(data, times):
    data = data * times
    assert op.lzw_decode(op.lzw_encode(data), 8, len(data)) == data


@pytest.mark.parametrize("data", [b"", bytes(60_000), np.random.default_rng(0).bytes(60_000), bytes(range(256)) * 100])
def test_payload_round_trip(data):
    whole = op.payload(data)
    assert len(whole) % op.WIDTH == 0 and len(whole) > 0 and whole.startswith(data)
    frames = [*op.decode(op.encode(whole))]
    assert b"".join(f.samples.tobytes() for f in frames) == whole and all(f.start_ms == i * f.delay_ms for i, f in enumerate(frames))


def image(frames, size=(4, 2), table=((9, 9, 9), (255, 0, 0), (0, 255, 0), (0, 0, 255))):
    """A file of frames (left, top, rows, disposal, transparent, interlaced)."""
    out = b"GIF89a" + struct.pack("<HHBBB", *size, 0x91, 0, 0) + bytes(c for t in table for c in t)
    for left, top, rows, disposal, clear, lace in frames:
        flat = bytes(x for r in (rows if not lace else [rows[i] for i in op.interlaced(len(rows))]) for x in r)
        out += b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), 7, clear or 0) + b"\0"
        out += b"\x2c" + struct.pack("<HHHHB", left, top, len(rows[0]), len(rows), 0x40 if lace else 0) + b"\x02" + op.blocks(op.lzw_encode(flat, 2))
    return out + b"\x3b"


def test_disposal_and_transparency():
    red, hole = [[1, 1], [1, 1]], [[2, 0], [0, 2]]
    found = list(op.decode(image([(0, 0, [[3] * 4, [3] * 4], 1, None, False), (0, 0, red, 3, None, False), (1, 0, hole, 2, 0, False), (3, 0, [[1]], 0, None, False)])))
    blue = [0, 0, 255, 255]
    assert found[1].canvas[0, 0].tolist() == [255, 0, 0, 255] and found[1].canvas[0, 2].tolist() == blue
    assert found[2].canvas[0, 0].tolist() == blue and found[2].canvas[0, 1].tolist() == [0, 255, 0, 255] and found[2].canvas[0, 2].tolist() == blue
    assert found[3].canvas[0, 1].tolist() == [0, 0, 0, 0] and found[3].canvas[0, 3].tolist() == [255, 0, 0, 255] and [f.start_ms for f in found] == [0, 70, 140, 210]


def test_interlace():
    rows = [[i % 4] * 4 for i in range(11)]
    assert next(op.decode(image([(0, 0, rows, 0, None, True)], (4, 11)))).samples.tolist() == rows


def test_not_a_gif(spark):
    with pytest.raises(ValueError):
        [*op.decode(b"GIF88a whatever")]
    media = spark.createDataFrame([(1, b"no"), (2, None), (3, op.encode(op.payload(b"x" * 20_000)))], "doc_id bigint, media binary")
    got = op.frames(media).collect()
    assert [r.doc_id for r in got] == [3, 3] and sum(got[0].histogram) == 3 * got[0].width * got[0].height


def plain(data):
    """(samples, delay, RGB of the canvas) of each frame of a file with a palette for all and no interlacing: bit by bit, by the format."""
    wide, high = data[6] | data[7] << 8, data[8] | data[9] << 8
    table, at, out, delay = [tuple(data[13 + 3 * i : 16 + 3 * i]) for i in range(2 << (data[10] & 7))], 13 + 3 * (2 << (data[10] & 7)), [], 0
    screen = [None] * (wide * high)
    while data[at] != 0x3B:
        if data[at] == 0x21:
            assert data[at + 1 : at + 3] == b"\xf9\x04" and data[at + 3] >> 2 & 7 == 2
            delay, at = data[at + 4] | data[at + 5] << 8, at + 8
            continue
        w, h, depth = data[at + 5] | data[at + 6] << 8, data[at + 7] | data[at + 8] << 8, data[at + 10]
        at, raw = at + 11, b""
        while data[at]:
            raw, at = raw + data[at + 1 : at + 1 + data[at]], at + 1 + data[at]
        at, whole, bit, size, words, last, flat = at + 1, int.from_bytes(raw, "little"), 0, depth + 1, {}, None, []
        while True:
            code = whole >> bit & (1 << size) - 1
            bit += size
            if code == 1 << depth:
                words, size, last = {i: (i,) for i in range(1 << depth)} | {(1 << depth) + k: () for k in (0, 1)}, depth + 1, None
                continue
            if code == (1 << depth) + 1:
                break
            entry = words[code] if code in words else last + last[:1]
            if last is not None and len(words) < 4096:
                words[len(words)] = last + entry[:1]
                size = max(size, min(12, len(words).bit_length()))
            flat += entry
            last = entry
        assert len(flat) == w * h and w == wide
        screen = [table[flat[i]] if i < len(flat) else None for i in range(wide * high)]  # the place of the frame before is cleared
        out.append((bytes(flat), delay * 10, screen))
    return out


def bins(frames):
    count = [[0] * op.BINS for _ in range(3)]
    for _, _, screen in frames:
        for rgb in filter(None, screen):
            for c in range(3):
                count[c][rgb[c] * op.BINS // 256] += 1
    return ";".join(f"{n}={'/'.join(map(str, count[c]))}" for c, n in enumerate(("red", "green", "blue")))


@pytest.mark.parametrize("text", [b"", b"a short text.", "ünï ".encode() * 900, np.random.default_rng(4).bytes(30_000)])
def test_feature_equals_plain_decoding(text):
    media = op.encode(op.payload(text))
    frames, got = plain(media), op.stored(text)
    assert b"".join(f[0] for f in frames) == op.payload(text) and got[4:6] == (len(media), hashlib.sha256(media).hexdigest())
    assert got[6] == f"frames={len(frames)};ms={sum(f[1] for f in frames)};{bins(frames)}"


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10_000), st.lists(st.tuples(st.integers(0, 10_000), st.integers(0, 255)), max_size=6))
def test_any_bytes(stop, changes):
    """Files that break off, or with bytes changed: frames or ValueError, nothing else."""
    for raw in (SAMPLE, image([(0, 0, [[3] * 4, [3] * 4], 1, None, False), (1, 0, [[2, 0], [0, 2]], 2, 0, True)]), op.encode(op.payload(b"some words " * 90))):
        data = bytearray(raw)
        for at, value in changes:
            data[at % len(data)] = value
        try:
            assert all(f.canvas.nbytes <= 4 * op.CANVAS for f in op.decode(bytes(data[: len(raw) - stop % len(raw)])))
        except ValueError:
            pass


def test_a_large_screen_is_refused():
    with pytest.raises(ValueError):
        [*op.decode(b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0) + b"\x3b")]


def test_rows_of_bad_files(spark):
    good = op.encode(op.payload(b"x" * 20_000))
    media = spark.createDataFrame([(i, good[: len(good) * i // 7]) for i in range(8)] + [(None, SAMPLE)], "doc_id bigint, media binary")
    got = op.frames(media).collect()
    assert [(r.doc_id, r.frame, r.start_ms) for r in got if r.doc_id == 7] == [(7, 0, 0), (7, 1, 40)] and {r.doc_id for r in got} <= {7, 6, None} and any(r.doc_id is None for r in got)


def test_cases(spark):
    got = op.store(frame(spark), content=True).collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = next(x[1] for x in ROWS if x[0] == r.doc_id) or ""
        whole = op.payload(text.encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text.encode()), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-16:]))
        assert (r.media_bytes, r.media_sha256) == (len(r.media), hashlib.sha256(r.media).hexdigest())
    assert len({r.media_sha256 for r in got if r.doc_id in (4, 5)}) == 1 and op.store(frame(spark, [])).count() == 0


def test_query(spark, sf):
    docs = {r.doc_id: op.payload(r.text.encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op7_gif_media(spark, sf).collect()
    assert {r.doc_id: r.payload_sha256 for r in got} == {k: hashlib.sha256(v).hexdigest() for k, v in docs.items()}
