"""Animated GIF as a media column: texts stored as palette samples, and a decoder of timed frames with colour histograms.

A payload is stored as an animation of frames of ``WIDTH`` samples by up to ``ROWS`` rows under a palette of 256 colours: each
frame's LZW stream carries the payload's next bytes, and is cleared before the next is drawn. The decoder reads any GIF87a or GIF89a: it
decodes LZW code streams, applies global and local palettes, interlacing, transparency and the disposal rules, and gives the canvas as
shown with each frame, its time and its colour histogram.

Defined cases: null text is empty; an empty text is one row of spaces; equal texts give equal bytes and values; texts of any
length are stored whole; other columns are ignored; an empty table gives an empty table of the same schema. ``decode`` takes any bytes:
those that are no GIF, break off within a block, or ask for a canvas of more than ``CANVAS`` samples raise ``ValueError``; samples that a
code stream lacks are transparent or 0, images beyond the screen are cropped to it, colours that a palette lacks are black. ``frames``
gives no rows for bytes that ``decode`` refuses, and for nulls.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchcast.shared import bounded

#: Samples in a row, most rows of a frame, hundredths of a second that each frame is shown, bins of a histogram per channel.
WIDTH, ROWS, DELAY, BINS = 192, 64, 4, 8
#: Most samples of a screen that is drawn, and most samples of all frames together.
CANVAS, SAMPLES = 1 << 24, 1 << 28
#: The palette of stored texts: a sample's bits 5-7 are its red, 2-4 its green, 0-1 its blue.
COLOURS = bytes(c for i in range(256) for c in ((i >> 5) * 255 // 7, (i >> 2 & 7) * 255 // 7, (i & 3) * 255 // 3))


@lru_cache(maxsize=8)
def widths(depth: int) -> np.ndarray:
    """Bits of the codes after a clear code, until the table is full. The first code adds no entry."""
    size = (1 << depth) + 2 + np.arange(4096 - (1 << depth) - 1)
    # the i-th code is read when the table has size[i] - 1 entries but for the first
    return np.maximum(depth + 1, np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64)).clip(max=12)


def lzw_encode(data: bytes, depth: int = 8) -> bytes:
    """The code stream of samples, least significant bit first."""
    clear, stop = 1 << depth, (1 << depth) + 1
    table: dict[int, int] = {}
    codes, get, free, prefix = [clear], table.get, stop + 1, -1
    put = codes.append
    resets = [1]
    for c in data:
        key = prefix << 8 | c
        if prefix < 0:
            prefix = c
            continue
        if (found := get(key)) is not None:
            prefix = found
            continue
        put(prefix)
        if free < 4096:
            table[key] = free
            free += 1
        else:
            put(clear)
            resets.append(len(codes))
            table.clear()
            free = stop + 1
        prefix = c
    if prefix >= 0:
        put(prefix)
    put(stop)
    return pack(np.array(codes, np.uint32), np.array(resets), depth)


def pack(codes: np.ndarray, resets: np.ndarray, depth: int) -> bytes:
    """Bits of the codes; ``resets`` are the places after clear codes."""
    own = widths(depth)
    n = len(codes)
    since = np.arange(n) - resets[np.maximum(np.searchsorted(resets, np.arange(n), "right") - 1, 0)]
    since[: resets[0]] = 0
    bits = own[np.minimum(since, len(own) - 1)]
    bits[: resets[0]] = depth + 1
    at = np.cumsum(bits) - bits
    out = np.zeros(int(at[-1] + bits[-1]) // 8 + 4, np.uint8)
    shifted = codes.astype(np.uint32) << (at & 7).astype(np.uint32)
    place = at >> 3
    for k in range(3):
        np.bitwise_or.at(out, place + k, (shifted >> np.uint32(8 * k) & np.uint32(255)).astype(np.uint8))
    return out[: (int(at[-1] + bits[-1]) + 7) // 8].tobytes()


def lzw_decode(stream: bytes, depth: int, most: int) -> bytes:
    """Samples of a code stream, ``most`` at most; a stream that breaks off gives what it has."""
    clear, stop = 1 << depth, (1 << depth) + 1
    own = widths(depth)
    raw = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.uint32)
    total = len(stream) * 8
    first = [bytes([i]) for i in range(clear)] + [b"", b""]
    out: list[bytes] = []
    put, size, at, full = out.append, 0, 0, False
    table, last = list(first), None
    while at + depth + 1 <= total and size < most:
        span = np.full(4096, 12) if full else own
        places = at + np.cumsum(span) - span
        span = span[: np.searchsorted(places + span, total, "right")]
        if not len(span):
            break
        places = places[: len(span)]
        byte = places >> 3
        value = (raw[byte] | raw[byte + 1] << np.uint32(8) | raw[byte + 2] << np.uint32(16)) >> (places & 7).astype(np.uint32) & ((1 << span) - 1).astype(np.uint32)
        ends = np.flatnonzero((value == clear) | (value == stop))
        used = int(ends[0]) if len(ends) else len(value)
        add, known = table.append, len(table)
        for code in value[:used].tolist():
            if last is None:
                if code >= known:
                    raise ValueError("LZW code out of range")
                entry = table[code]
            else:
                if code < known:
                    entry = table[code]
                elif code == known and known < 4096:
                    entry = last + last[:1]
                else:
                    raise ValueError("LZW code out of range")
                if known < 4096:
                    add(last + entry[:1])
                    known += 1
            put(entry)
            size += len(entry)
            last = entry
        if not len(ends):
            at, full = int(places[-1] + span[-1]), True
            continue
        at = int(places[used] + span[used])
        if value[used] == stop:
            break
        table, last, full = list(first), None, False
    return b"".join(out)[:most]


def blocks(data: bytes) -> bytes:
    """Sub-blocks of at most 255 bytes and their end."""
    whole = len(data) // 255 * 255
    body = np.empty((whole // 255, 256), np.uint8)
    body[:, 0] = 255
    body[:, 1:] = np.frombuffer(data[:whole], np.uint8).reshape(-1, 255)
    rest = data[whole:]
    return body.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def payload(text: bytes) -> bytes:
    """Padded by spaces to a positive multiple of the row's width."""
    return text + b" " * (-len(text) % WIDTH if text else WIDTH)


def encode(data: bytes, width: int = WIDTH, rows: int = ROWS, delay: int = DELAY) -> bytes:
    """An animation that carries the bytes, whose count is a multiple of ``width``, one frame after the other."""
    height = min(rows, len(data) // width)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), COLOURS]
    for s in range(0, len(data), width * rows):
        part = data[s : s + width * rows]
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", 2 << 2, delay, 0) + b"\0")  # afterwards its place is cleared
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0) + b"\x08" + blocks(lzw_encode(part)))
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    """``samples``: palette indexes of the image's own place; ``canvas``: RGBA of the whole screen once it is drawn."""

    start_ms: int
    delay_ms: int
    left: int
    top: int
    width: int
    height: int
    disposal: int
    transparent: int | None
    samples: np.ndarray
    palette: np.ndarray
    canvas: np.ndarray | None = field(default=None, repr=False)


def part(data: bytes, at: int, n: int) -> bytes:
    """``n`` bytes from a place on."""
    if at + n > len(data):
        raise ValueError("the file breaks off")
    return data[at : at + n]


def palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    n = 2 << (flags & 7)
    return np.frombuffer(part(data, at, 3 * n), np.uint8).reshape(-1, 3), at + 3 * n


def sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    out = []
    while n := part(data, at, 1)[0]:
        out.append(part(data, at + 1, n))
        at += n + 1
    return b"".join(out), at + 1


def interlaced(rows: int) -> np.ndarray:
    """Place of each stored row."""
    return np.concatenate([np.arange(s, rows, k) for s, k in ((0, 8), (4, 8), (2, 4), (1, 2))])


def rgb(colours: np.ndarray) -> np.ndarray:
    """All 256 colours of a palette; those that it lacks are black."""
    if len(colours) == 256:
        return colours
    out = np.zeros((256, 3), np.uint8)
    out[: len(colours)] = colours
    return out


def decode(data: bytes, most: int = CANVAS) -> Iterator[Frame]:
    """Timed frames, one after the other, each with the canvas under the disposal and transparency rules."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    wide, high, flags, _, _ = struct.unpack("<HHBBB", part(data, 6, 7))
    if wide * high > most:
        raise ValueError("the screen is too large")
    common, at = palette(data, 13, flags) if flags & 0x80 else (np.zeros((0, 3), np.uint8), 13)
    canvas = np.zeros((high, wide, 4), np.uint8)
    now, disposal, delay, clear, drawn = 0, 0, 0, None, 0
    while at < len(data) and (kind := data[at]) != 0x3B:
        if kind == 0x21:
            if part(data, at + 1, 1)[0] == 0xF9:
                own, at = sub_blocks(data, at + 2)
                packed, delay, index = struct.unpack("<BHB", part(own, 0, 4))
                disposal, clear = packed >> 2 & 7, index if packed & 1 else None
            else:
                _, at = sub_blocks(data, at + 2)
            continue
        if kind != 0x2C:
            raise ValueError("unknown block")
        left, top, w, h, own = struct.unpack("<HHHHB", part(data, at + 1, 9))
        at += 10
        colours, at = palette(data, at, own) if own & 0x80 else (common, at)
        depth = part(data, at, 1)[0]
        stream, at = sub_blocks(data, at + 1)
        drawn += w * h
        if not 1 <= depth <= 8 or w * h > most or drawn > SAMPLES:
            raise ValueError("an image is out of bounds")
        flat = np.frombuffer(lzw_decode(stream, depth, w * h), np.uint8)
        if len(flat) < w * h:
            flat = np.r_[flat, np.full(w * h - len(flat), clear or 0, np.uint8)]
        samples = flat.reshape(h, w)
        if own & 0x40:
            straight = np.empty_like(samples)
            straight[interlaced(h)] = samples
            samples = straight
        before = canvas.copy() if disposal == 3 else None
        place = canvas[top : top + h, left : left + w]
        seen = samples[: place.shape[0], : place.shape[1]]
        if clear is None:
            place[..., :3], place[..., 3] = rgb(colours)[seen], 255
        else:
            shown = seen != clear
            place[shown, :3], place[shown, 3] = rgb(colours)[seen[shown]], 255
        yield Frame(now, delay * 10, left, top, w, h, disposal, clear, samples, colours, canvas.copy())
        if disposal == 2:
            place[:] = 0
        elif disposal == 3:
            canvas[:] = before
        now += delay * 10
        disposal, delay, clear = 0, 0, None


def histogram(canvas: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts of what is shown on a canvas by red, by green and by blue, ``bins`` each."""
    flat = canvas.reshape(-1, 4)
    shown = flat if flat[:, 3].all() else flat[flat[:, 3] > 0]
    return np.concatenate([np.bincount(shown[:, c], minlength=256).reshape(bins, -1).sum(1) for c in range(3)])


SCHEMA = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def stored(text: bytes) -> tuple:
    """Stores one text, reads the stored bytes back and computes its features from the frames as they are shown."""
    media = encode(payload(text))
    back, seen, n, end = [], 0, 0, 0
    for f in decode(media):
        back.append(f.samples.tobytes())
        seen, n, end = seen + histogram(f.canvas), n + 1, f.start_ms + f.delay_ms
    raw = b"".join(back)
    feature = f"frames={n};ms={end};" + ";".join(f"{c}={'/'.join(map(str, x))}" for c, x in zip(("red", "green", "blue"), seen.reshape(3, -1).tolist(), strict=True))
    return len(text), len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature


def store(docs: DataFrame, text: str = "text", key: str = "doc_id", content: bool = False) -> DataFrame:
    """One row per document: sizes, digests and features of its animation. ``content`` adds the GIF bytes as ``media``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                texts = [x or b"" for x in part.column(1).cast(pa.binary()).to_pylist()]
                columns = [part.column(0), *(pa.array(x) for x in zip(*map(stored, texts), strict=True))]
                names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                if content:
                    columns.append(pa.array([encode(payload(x)) for x in texts], pa.binary()))
                    names.append("media")
                yield pa.RecordBatch.from_arrays(columns, names)

    return bounded(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA + (", media binary" if content else ""))


FRAMES = "doc_id bigint, frame int, start_ms bigint, delay_ms bigint, left int, top int, width int, height int, disposal int, histogram array<bigint>, canvas binary"
ARROW = pa.schema([("doc_id", pa.int64()), ("frame", pa.int32()), ("start_ms", pa.int64()), ("delay_ms", pa.int64()), ("left", pa.int32()), ("top", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("disposal", pa.int32()), ("histogram", pa.list_(pa.int64())), ("canvas", pa.binary())])


def frames(media: DataFrame, column: str = "media", key: str = "doc_id", most: int = CANVAS) -> DataFrame:
    """One row per timed frame of a column of GIFs: the colour histogram of the canvas as shown, and its RGBA bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key_, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not raw.is_valid:
                    continue
                data = raw.as_py()
                try:
                    for _ in decode(data, most):  # whole, or no row at all
                        pass
                except ValueError:
                    continue
                for i, f in enumerate(decode(data, most)):
                    row = key_, i, f.start_ms, f.delay_ms, f.left, f.top, f.width, f.height, f.disposal, histogram(f.canvas).tolist(), f.canvas.tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, ARROW.types, strict=True)], schema=ARROW)

    return bounded(media).select(F.col(key).cast("bigint").alias("doc_id"), F.col(column).cast("binary").alias("media")).mapInArrow(run, FRAMES)
