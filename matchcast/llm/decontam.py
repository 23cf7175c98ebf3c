"""Benchmark decontamination by SimHash of item-sized windows.

For every benchmark item, each window of a document with as many words as the item gets a 64-bit fingerprint: the signs of the sums
of its weighted shingles' bits. Items are indexed by four blocks of their fingerprints; every fingerprint within ``RADIUS`` bits of the
window's is within a quarter of that in one block, whose near values are enumerated (random items are candidates in one case of seven).
Those found are verified by exact weighted-shingle similarity (sum of the lesser over sum of the greater weights). Shingles are five
words in lower case without punctuation, an item of fewer words is one shingle; a shingle's weight falls with the share of items that
have it.

Windows are fingerprinted where the document holds enough of an item's shingles for the similarity to be reached at all; this
leaves no window out that verification could accept. No exchange is needed: items go to the executors in blocks of bounded bytes, and
a benchmark of more bytes takes one pass over the documents per block.

Defined cases: null and empty texts, and items without words, match nothing; a document shorter than an item is one window; repeated
items each match; repeated rows each give their rows; of windows alike the first counts; texts of any length are read whole; other
columns are ignored; empty tables give an empty table of the same schema. Offsets are code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchcast.shared import bounded
from matchcast.llm.vec import ALNUM, LOWER, U64, chunks, ragged, shingles, span_hashes, utf8, words

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 19
#: Bits of a block of a fingerprint.
BLOCK_BITS = 16
#: Bytes of items that are sent to the executors at once.
ITEM_BYTES = 4 << 20
SCREEN_BITS = 22


def bits(hashes: np.ndarray) -> np.ndarray:
    """+1 and -1 by hash and bit."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


class BlockIndex:
    """Items' fingerprints by blocks of ``BLOCK_BITS`` bits: any within ``radius`` of a query differs from it in at most
    ``radius // blocks`` bits of one block, so the items of all values that near are the candidates."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        self.shifts = [U64(s) for s in range(0, 64, BLOCK_BITS)]
        apart = np.bitwise_count(np.arange(1 << BLOCK_BITS, dtype=np.uint32))
        self.masks = np.flatnonzero(apart <= radius // len(self.shifts))
        self.values, self.items, self.bounds = [], [], []
        for shift in self.shifts:
            value = (prints >> shift & U64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            by = np.argsort(value, kind="stable")
            self.values.append(value)
            self.items.append(by)
            self.bounds.append(np.searchsorted(value[by], np.arange((1 << BLOCK_BITS) + 1)) if len(prints) > len(self.masks) else None)

    def candidates(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) places that are near in block ``k``: by enumerating the near values, or, where there are fewer items than these,
        by comparing the items' values."""
        own = (queries >> self.shifts[k] & U64((1 << BLOCK_BITS) - 1)).astype(np.int64)
        if self.bounds[k] is None:
            return np.nonzero(np.bitwise_count(own[:, None] ^ self.values[k][None, :]) <= self.radius // len(self.shifts))
        near = own[:, None] ^ self.masks[None, :]
        start, count = self.bounds[k][near].ravel(), (self.bounds[k][near + 1] - self.bounds[k][near]).ravel()
        return np.repeat(np.repeat(np.arange(len(queries)), len(self.masks)), count), self.items[k][np.repeat(start, count) + ragged(count)]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) places of all pairs within the radius, once each, by query."""
        found = []
        for s in range(0, len(queries), 512):
            part = queries[s : s + 512]
            for k in range(len(self.shifts)):
                q, i = self.candidates(part, k)
                close = np.bitwise_count(part[q] ^ self.prints[i]) <= self.radius
                found.append((q[close] + s) * len(self.prints) + i[close])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // max(1, len(self.prints)), pairs % max(1, len(self.prints))


class Items:
    """Benchmark items with their weighted shingles, fingerprints and indexes by size."""

    def __init__(self, texts: list[bytes], weigh: dict[int, float], default: float, shingle: int = SHINGLE, similarity: float = SIMILARITY):
        self.shingle, self.similarity, self.default = shingle, similarity, default
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([*map(len, texts)])].astype(np.int64)
        hashes, rows, sizes = item_shingles(data, offsets, shingle)
        self.sizes = sizes
        self.counts: list[dict[int, int]] = [{} for _ in texts]
        for h, r in zip(hashes.tolist(), rows.tolist(), strict=True):
            self.counts[r][h] = self.counts[r].get(h, 0) + 1
        self.total = np.array([sum(n * weigh.get(h, default) for h, n in c.items()) for c in self.counts])
        self.known = np.unique(hashes)
        self.weight = np.array([weigh.get(h, default) for h in self.known.tolist()])
        self.owners: list[list[int]] = [[] for _ in self.known]
        for r, c in enumerate(self.counts):
            for h in c:
                self.owners[int(np.searchsorted(self.known, U64(h)))].append(r)
        self.screen = np.zeros(1 << SCREEN_BITS, bool)
        self.screen[(self.known & U64((1 << SCREEN_BITS) - 1)).astype(np.int64)] = True
        prints = np.zeros(len(texts), U64)
        for r in np.unique(rows):
            own = hashes[rows == r]
            prints[r] = fingerprints((bits(own) * self.weights(own)[:, None]).sum(0, keepdims=True))[0]
        self.by_size = {int(m): (np.flatnonzero(sizes == m), BlockIndex(prints[sizes == m])) for m in np.unique(sizes) if m}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the items' shingles, or -1."""
        place = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.screen[(hashes & U64((1 << SCREEN_BITS) - 1)).astype(np.int64)])
        if len(maybe) and len(self.known):
            at = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
            place[maybe] = np.where(self.known[at] == hashes[maybe], at, -1)
        return place

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, hashes)
        at = np.minimum(at, len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.weight[at], self.default)

    def best(self, hashes: np.ndarray, place: np.ndarray, k: int) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first shingle, count of shingles) of the best window of each item of one document, whose shingles of
        ``k`` words and their places among the items' are given."""
        at = np.flatnonzero(place >= 0)
        held: dict[int, float] = {}
        for p in np.unique(place[at]).tolist():
            n = int((place[at] == p).sum())
            for r in self.owners[p]:
                if min(self.sizes[r], self.shingle) == k:
                    held[r] = held.get(r, 0.0) + self.weight[p] * min(n, self.counts[r][int(self.known[p])])
        sizes: dict[int, set[int]] = {}
        for r, w in held.items():
            if w >= self.similarity * self.total[r] - 1e-9:
                sizes.setdefault(int(self.sizes[r]), set()).add(r)
        found: dict[int, tuple[float, int, int]] = {}
        for m, wanted in sizes.items():
            length = min(m - k + 1, len(hashes))
            marked = np.zeros(len(hashes) + 1, np.int64)
            hit = at[[any(r in wanted for r in self.owners[p]) for p in place[at].tolist()]]
            np.add.at(marked, np.maximum(hit - length + 1, 0), 1)
            np.add.at(marked, hit + 1, -1)
            starts = np.flatnonzero(np.cumsum(marked)[: len(hashes) - length + 1] > 0)
            if not len(starts):
                continue
            owners, index = self.by_size[m]
            cuts = np.flatnonzero(np.r_[True, np.diff(starts) > length, True])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                for lo in range(a, b, 4096):
                    own = starts[lo : min(lo + 4096, b)]
                    base, stop = int(own[0]), int(own[-1]) + length
                    part = hashes[base:stop]
                    weight = self.weights(part)
                    total = np.zeros((len(part) + 1, 64), np.float64)
                    np.cumsum(bits(part) * weight[:, None], axis=0, out=total[1:])
                    q, i = index.near(fingerprints(total[own - base + length] - total[own - base]))
                    for s, r in zip(own[q].tolist(), owners[i].tolist(), strict=True):
                        value = self.similar(hashes[s : s + length], r)
                        if value >= self.similarity - 1e-9 and value > found.get(r, (0.0, 0, 0))[0]:
                            found[r] = (value, s, length)
        return [(r, *x) for r, x in sorted(found.items())]

    def similar(self, window: np.ndarray, item: int) -> float:
        """Exact weighted Jaccard similarity of two bags of shingles."""
        own, both, greater = self.counts[item], 0.0, float(self.total[item])
        values, n = np.unique(window, return_counts=True)
        for h, c, w in zip(values.tolist(), n.tolist(), self.weights(values).tolist(), strict=True):
            have = own.get(h, 0)
            both += w * min(c, have)
            greater += w * max(c - have, 0)
        return both / greater if greater else 0.0


def item_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and rows of shingles, and each row's count of words."""
    data = LOWER[data]
    starts, ends, rows = words(data, offsets, ALNUM)
    hashes, of, _ = shingles(span_hashes(data, starts, ends), rows, k)
    return hashes, of, np.bincount(rows, minlength=len(offsets) - 1)


def matches(items: Items, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first byte, end byte) of the best window of every item that a row holds."""
    folded = LOWER[data]
    starts, ends, rows = words(folded, offsets, ALNUM)
    if not len(starts):
        return
    own = span_hashes(folded, starts, ends)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for k in sorted({min(m, items.shingle) for m in items.by_size}):
        hashes, of, first = shingles(own, rows, k)
        place = items.find(hashes)
        hit = np.flatnonzero(place >= 0)
        for r in np.unique(of[hit]).tolist():
            a, b = np.searchsorted(of, r, "left"), np.searchsorted(of, r, "right")
            last_word = int(np.searchsorted(rows, r, "right")) - 1
            for item, value, s, n in items.best(hashes[a:b], place[a:b], k):
                w = int(first[a + s])
                best[r, item] = (value, int(starts[w]), int(ends[min(w + n + k - 2, last_word)]))
    yield from ((r, i, *x) for (r, i), x in sorted(best.items()))


def blocks_of(benchmark: DataFrame, text: str, key: str, most: int = ITEM_BYTES) -> tuple[list[tuple[list[int], list[bytes]]], dict[int, float], float]:
    """Items in blocks of bounded bytes; weights of the shingles that several items have, and that of all others."""
    rows = benchmark.select(F.col(key).cast("bigint"), F.col(text).cast("string")).where(F.col(text).isNotNull()).orderBy(key, text)
    blocks: list[tuple[list[int], list[bytes]]] = []
    size, n, share = most, 0, {}
    for k, t in rows.toLocalIterator():
        raw = t.encode()
        if size + len(raw) > most or not blocks:
            blocks.append(([], []))
            size = 0
        blocks[-1][0].append(k)
        blocks[-1][1].append(raw)
        size += len(raw)
        n += 1
        for h in np.unique(item_shingles(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), SHINGLE)[0]).tolist():
            share[h] = share.get(h, 0) + 1
    default = 1 + np.log(max(n, 1))
    return blocks, {h: 1 + np.log(n / c) for h, c in share.items() if c > 1}, float(default)


SCHEMA = "doc_id bigint, item_id bigint, similarity double, start int, end int"


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", most: int = ITEM_BYTES) -> DataFrame:
    """One row per document and item that it holds: the similarity and place of the best window."""
    blocks, weigh, default = blocks_of(benchmark, item_text, item_key, most)
    source = bounded(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if not blocks:
        return source.sparkSession.createDataFrame([], SCHEMA)

    def over(keys: list[int], texts: list[bytes]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(texts, weigh, default)
            for batch in batches:
                data, offsets = utf8(batch.column(1))
                for a, b in chunks(offsets):
                    part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                    found = [*matches(items, part, own)]
                    if found:
                        row, item, value, s, e = zip(*found, strict=True)
                        points = lambda at: pa.array([int(((part[own[r] : x] & 0xC0) != 0x80).sum()) for r, x in zip(row, at, strict=True)], pa.int32())  # noqa: B023, E731
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([a + r for r in row])), pa.array([keys[i] for i in item], pa.int64()), pa.array(value), points(s), points(e)], ["doc_id", "item_id", "similarity", "start", "end"])

        return source.mapInArrow(run, SCHEMA)

    return reduce(DataFrame.unionByName, [over(*b) for b in blocks])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id", most: int = ITEM_BYTES) -> DataFrame:
    """The documents that hold no item; all columns stay."""
    blocks, weigh, default = blocks_of(benchmark, item_text, item_key, most)

    def without(frame: DataFrame, texts: list[bytes]) -> DataFrame:
        column = frame.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(texts, weigh, default)
            for batch in batches:
                data, offsets = utf8(batch.column(column))
                keep = np.ones(batch.num_rows, bool)
                for a, b in chunks(offsets):
                    for r, *_ in matches(items, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
                        keep[a + r] = False
                yield batch.filter(pa.array(keep))

        return frame.mapInArrow(run, frame.schema)

    return reduce(lambda frame, b: without(frame, b[1]), blocks, bounded(docs))
