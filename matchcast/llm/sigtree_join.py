"""N-gram Jaccard self-join by signature trees.

Two documents whose sets of word shingles have a Jaccard similarity of ``num / den`` or more share m of the first tokens of both sets,
in any common order (a set of n tokens needs its first n - ceil(n num / den) + m). So documents meet in a block for every such token,
and one that has fewer than m tokens in common with any others has no link. Tokens that stand in many documents come last in the order, and so in few blocks; this changes cost, not results.

In a block, documents are the leaves of a signature tree. Its nodes hold the OR of their documents' token bitmaps, the range of set
sizes, and the most tokens that bits may hide; a dual traversal descends only into pairs of nodes whose greatest possible overlap
suffices, and compares the documents' own, longer bitmaps at the leaves. Pairs that are left may be links; what a block gives is not
those pairs but which documents they join, a row per document, and all blocks together give families that no link leaves.

Two rounds find the families: one over the blocks of the first tokens alone, and one over all blocks, of which those within a family
are passed over. Each family then is one more signature tree, over the exact sets: its pairs are verified by bitmaps of the tokens
that the family's documents share, whose common bits are the overlap. Equal sets are one node throughout. Blocks and families of more
than ``BLOCK`` nodes are dealt into parts of which every two meet, so none is gathered in one task.

Defined cases: null texts and texts without words have an empty set and are linked with nothing; a text with fewer words than a
shingle is one shingle; rows that share a doc_id are rows of their own; null doc_ids link like others and are nobody's least; texts of
any length are read whole; other columns are ignored; an empty table gives an empty table of the same schema.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from matchcast.llm.components import components
from matchcast.llm.hot import split_join
from matchcast.shared import BROADCAST_BYTES, bounded, cut
from matchcast.llm.vec import LOWER, SPACE, U64, chunks, mix, ragged, shingles, span_hashes, utf8, words

#: Tokens of round 1; most nodes of a block's part; children of a tree's node; bits of its bitmap; bits of a leaf's bitmap per token,
#: in blocks and in families, and at most.
FIRST, BLOCK, FAN, NODE_BITS, LEAF_BITS, FAMILY_BITS, MOST_BITS = 4, 4096, 16, 256, 1, 4, 1 << 16
#: A set of n tokens has to share 1 + n // MORE of its first tokens.
MORE = 50
#: Tokens and nodes of a family's part at most; nodes of a family whose pairs are verified by bitmaps, and bytes of these at most.
PART_TOKENS, PART_NODES, DENSE, DENSE_BYTES = 1 << 20, 8192, 32, 32 << 20
#: A token that ``OFTEN`` of ``COUNTED`` documents in a row have among their first is counted as frequent; at most so many are put
#: last, and each is dealt over so many tasks.
COUNTED, OFTEN, FREQUENT, SALTS = 10_000, 2, 1 << 18, 64
#: Rows of one token that are held to see whether it is shared; a token of more is.
HELD = 1 << 20
NONE = -(1 << 63)


def sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows' ascending distinct shingle hashes, and n + 1 bounds."""
    n = len(offsets) - 1
    data = LOWER[data]
    starts, ends, rows = words(data, offsets, ~SPACE)
    hashes, of, _ = shingles(span_hashes(data, starts, ends), rows, k)
    bounds = np.searchsorted(of, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    if len(hashes):
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[fresh], np.searchsorted(of[fresh], np.arange(n + 1))


def digests(values: np.ndarray, bounds: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set; the first half names its node."""
    out = []
    for own in (U64(0xA4093822299F31D0), U64(0x082EFA98EC4E6C89)):
        total = np.r_[U64(0), np.cumsum(mix(values ^ mix(np.array([salt], U64) + own)))]
        out.append(mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(U64)).view(np.int64))
    return out[0], out[1]


def signature(values: np.ndarray, per: int = LEAF_BITS) -> bytes:
    """The bitmap of a set, of as many bits as suit its size."""
    width = leaf_bits(len(values), per)
    bits = np.zeros(width, np.uint8)
    bits[(values >> U64(17) & U64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def leaf_bits(n: int, per: int) -> int:
    return min(max(NODE_BITS, 1 << (per * n - 1).bit_length()), MOST_BITS)


def taken(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """How many first tokens of sets of such sizes are looked at."""
    least = -(-n * num // den)
    return n - least + np.minimum(1 + n // MORE, least)


def profile(docs: DataFrame, k: int, num: int, den: int, salt: int) -> DataFrame:
    """kind 0: doc_id, n, node and the other half of the digest of each row; kind 1: token (as node) and the count (n) of rows with it,
    where it is frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "n", "nid", "rest"]

        def frequent(parts: list[np.ndarray]) -> pa.RecordBatch:
            token, count = np.unique(np.concatenate(parts), return_counts=True)
            token, count = token[count >= OFTEN], count[count >= OFTEN]
            m = len(token)
            return pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int8)), pa.nulls(m, pa.int64()), pa.array(count), pa.array(token.view(np.int64)), pa.array(np.zeros(m, np.int64))], names)

        recent: list[np.ndarray] = []
        seen = 0
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in chunks(offsets):
                values, bounds = sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
                nid, rest = digests(values, bounds, salt)
                n = b - a
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int8)), batch.column(0).slice(a, n), pa.array(np.diff(bounds)), pa.array(nid), pa.array(rest)], names)
                front = np.minimum(taken(np.diff(bounds), num, den), np.diff(bounds))
                recent.append(values[np.repeat(bounds[:-1], front) + ragged(front)])
                seen += n
                if seen >= COUNTED:
                    yield frequent(recent)
                    recent, seen = [], 0
        if seen:
            yield frequent(recent)

    return docs.mapInArrow(run, "kind tinyint, doc_id bigint, n bigint, nid bigint, rest bigint")


def prefixes(docs: DataFrame, k: int, num: int, den: int, frequent: np.ndarray, salt: int) -> DataFrame:
    """node, n, its first tokens in the common order (those that are frequent apart), and bitmap, of the sets of all rows: each task
    gives a node once, however many copies it has."""

    def lists(parts: list[np.ndarray]) -> pa.ListArray:
        ends = np.r_[0, np.cumsum([*map(len, parts)])].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in chunks(offsets):
                values, bounds = sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
                n = np.diff(bounds)
                nid, _ = digests(values, bounds, salt)
                rows = np.array([r for r in np.flatnonzero(n).tolist() if (name := int(nid[r])) not in given and not given.add(name)], np.int64)
                if not len(rows):
                    continue
                take = taken(n, num, den)
                late = np.zeros(len(values), bool)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                    late = frequent[at] == values
                first, second, prints = [], [], []
                for r in rows.tolist():
                    own, back = values[bounds[r] : bounds[r + 1]], late[bounds[r] : bounds[r + 1]]
                    prints.append(signature(own))
                    front = own[~back] if back.any() else own
                    first.append(front[: take[r]])
                    second.append(own[back][: max(0, take[r] - len(front))])
                yield pa.RecordBatch.from_arrays([pa.array(nid[rows]), pa.array(n[rows]), lists(first), lists(second), pa.array(prints, pa.binary())], ["nid", "n", "first", "late", "sig"])

    return docs.select("text").mapInArrow(run, "nid bigint, n bigint, first array<bigint>, late array<bigint>, sig binary")


def partnered(t: np.ndarray, num: int, den: int) -> np.ndarray:
    """Places of those rows (token, salt, n, nid, comp), sorted by token, n and nid, that may have a partner."""
    token, salt, n, nid, comp = t
    m = len(token)
    same = np.r_[False, token[1:] == token[:-1]]
    fresh = ~(same & np.r_[False, nid[1:] == nid[:-1]])
    at = np.flatnonzero(fresh)
    token, salt, n, nid, comp = (x[at] for x in t)
    m = len(at)
    start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, m]))
    mixed = (np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start))[group]
    near = np.zeros(m, bool)
    if m > 1:
        pair = (token[1:] == token[:-1]) & (n[:-1] * den >= n[1:] * num)
        near[1:] |= pair
        near[:-1] |= pair
    return at[(salt >= 0) | mixed & near]


def judged(batches: Iterator[pa.RecordBatch], num: int, den: int, most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Of sorted rows those that may have a partner, and all rows of a token of more than ``most``."""
    held = np.zeros((5, 0), np.int64)
    passed = None  # the token whose rows are all passed on

    def out(t: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(t[i][at]) for i in (0, 2, 3, 4)], ["token", "n", "nid", "comp"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy() for c in batch.columns])
        if passed is not None:
            rest = int(np.searchsorted(rows[0], passed, "right"))
            if rest:
                yield out(rows, np.arange(rest))
                rows = rows[:, rest:]
                if not rows.shape[1]:
                    continue
            passed = None
        held = np.concatenate([held, rows], axis=1)
        last = int(np.searchsorted(held[0], held[0, -1], "left"))
        if last:
            yield out(held[:, :last], partnered(held[:, :last], num, den))
            held = held[:, last:]
        elif held.shape[1] > most:
            yield out(held, np.arange(held.shape[1]))
            passed = int(held[0, -1])
            held = held[:, :0]
    if held.shape[1]:
        yield out(held, partnered(held, num, den))


def shared(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Of rows (token, salt, n, nid, comp) those that may have a partner: another component has the token too, and a set next in size
    is near enough. One exchange of the tokens brings them together; rows of a frequent token, dealt by a salt, all stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return judged(batches, num, den)

    dealt = entries.repartition(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), "token", "salt").sortWithinPartitions("token", "n", "nid")
    return dealt.select("token", "salt", "n", "nid", "comp").mapInArrow(run, "token bigint, n bigint, nid bigint, comp bigint")


class Leaves:
    """Documents of a batch of blocks: set sizes, components, sides, and bitmaps by width."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, side: np.ndarray, sigs: list[bytes], num: int, den: int):
        self.n, self.comp, self.side, self.num, self.den = n, comp, side, num, den
        self.width = np.fromiter(map(len, sigs), np.int64, len(sigs)) * 8
        self.place = np.zeros(len(n), np.int64)
        self.maps: dict[int, np.ndarray] = {}
        self.small = np.zeros((len(n), NODE_BITS // 64), U64)
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.place[at] = np.arange(len(at))
            self.maps[w] = np.frombuffer(b"".join([sigs[i] for i in at.tolist()]), U64).reshape(len(at), -1)
            self.small[at] = np.bitwise_or.reduce(self.maps[w].reshape(len(at), -1, NODE_BITS // 64), axis=1)
        self.hidden = n - np.bitwise_count(self.small).sum(1, dtype=np.int64)

    def needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least overlap of two sets of the given sizes at the similarity."""
        return -(-(a + b) * self.num // (self.num + self.den))

    def bitmaps(self, at: np.ndarray, own: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of documents whose width is ``own`` or, where it is greater, folded to ``width``."""
        out = np.empty((len(at), width // 64), U64)
        for w in np.unique(own).tolist():
            those = own == w
            rows = self.maps[w][self.place[at[those]]]
            out[those] = rows if w == width else np.bitwise_or.reduce(rows.reshape(len(rows), -1, width // 64), axis=1)
        return out

    def close(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether each pair may reach the similarity: by sizes, then by bitmaps."""
        a, b = self.n[i], self.n[j]
        good = (self.comp[i] != self.comp[j]) & (np.minimum(a, b) * self.den >= np.maximum(a, b) * self.num) & ((self.side[i] != self.side[j]) | (self.side[i] < 0))
        at = np.flatnonzero(good)
        width = np.minimum(self.width[i[at]], self.width[j[at]])
        for w in np.unique(width).tolist():
            every = at[width == w]
            step = max(1, (8 << 20) // (w // 8))
            for s in range(0, len(every), step):
                own = every[s : s + step]
                x, y = self.bitmaps(i[own], self.width[i[own]], w), self.bitmaps(j[own], self.width[j[own]], w)
                most = np.minimum(self.n[i[own]] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), self.n[j[own]] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
                good[own[most < self.needed(self.n[i[own]], self.n[j[own]])]] = False
        return good


class Tree:
    """A forest over the leaves: each block a tree of its own, whose levels are built from the leaves up."""

    def __init__(self, leaves: Leaves, bounds: np.ndarray):
        """``bounds``: n + 1 places where the blocks begin."""
        self.leaves = leaves
        self.levels: list[dict[str, np.ndarray]] = []
        own = {"lo": leaves.n, "hi": leaves.n, "bits": leaves.small, "hidden": leaves.hidden, "cmin": leaves.comp, "cmax": leaves.comp}
        edges = bounds
        while True:
            sizes = np.diff(edges)
            count = -(-sizes // FAN)
            starts = np.repeat(edges[:-1], count) + ragged(count) * FAN
            stops = np.minimum(starts + FAN, np.repeat(edges[1:], count))
            red = lambda f, v: f.reduceat(v, starts, axis=0)  # noqa: B023, E731
            own = {"lo": red(np.minimum, own["lo"]), "hi": red(np.maximum, own["hi"]), "bits": red(np.bitwise_or, own["bits"]), "hidden": red(np.maximum, own["hidden"]), "cmin": red(np.minimum, own["cmin"]), "cmax": red(np.maximum, own["cmax"]), "start": starts, "stop": stops}
            self.levels.append(own)
            edges = np.r_[0, np.cumsum(count)]
            if (count <= 1).all():
                break

    def open(self, level: dict[str, np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether documents under both nodes may be linked and are not of one component."""
        num, den = self.leaves.num, self.leaves.den
        sizes = (level["hi"][p] * den >= level["lo"][q] * num) & (level["hi"][q] * den >= level["lo"][p] * num)
        mixed = (level["cmin"][p] != level["cmax"][q]) | (level["cmax"][p] != level["cmin"][q])
        most = np.bitwise_count(level["bits"][p] & level["bits"][q]).sum(1, dtype=np.int64) + np.minimum(level["hidden"][p], level["hidden"][q])
        return sizes & mixed & (most >= self.leaves.needed(level["lo"][p], level["lo"][q]))

    def expand(self, level: dict[str, np.ndarray], p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of children, each once."""
        a, b = level["stop"][p] - level["start"][p], level["stop"][q] - level["start"][q]
        each = ragged(a * b)
        wide, first, second = np.repeat(b, a * b), np.repeat(level["start"][p], a * b), np.repeat(level["start"][q], a * b)
        i, j = first + each // wide, second + each % wide
        keep = (np.repeat(p, a * b) != np.repeat(q, a * b)) | (i <= j)
        return i[keep], j[keep]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves that may be linked, in bounded portions."""
        top = np.arange(len(self.levels[-1]["lo"]))
        stack = [(len(self.levels) - 1, top, top)]
        while stack:
            depth, p, q = stack.pop()
            for s in range(0, len(p), 2048):
                a, b = p[s : s + 2048], q[s : s + 2048]
                if depth >= 0:
                    good = self.open(self.levels[depth], a, b)
                    a, b = self.expand(self.levels[depth], a[good], b[good])
                    if depth:
                        if len(a):
                            stack.append((depth - 1, a, b))
                    else:
                        off = a != b
                        a, b = a[off], b[off]
                        good = self.leaves.close(a, b)
                        if good.any():
                            yield a[good], b[good]


class Labels:
    """Groups of documents that pairs join, by the least of each."""

    def __init__(self, start: np.ndarray):
        self.of = start.copy()

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.of[i], self.of[j]
        apart = a != b
        if not apart.any():
            return
        edges = np.unique(np.stack([np.minimum(a, b)[apart], np.maximum(a, b)[apart]], 1), axis=0)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for x, y in edges.tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        old = np.unique(edges)
        new = np.array([root(x) for x in old.tolist()])
        at = np.minimum(np.searchsorted(old, self.of), len(old) - 1)
        self.of = np.where(old[at] == self.of, new[at], self.of)


def whole_blocks(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], least: int) -> Iterator[pa.Table]:
    """Tables of whole blocks, of ``least`` rows or a little more, from rows that are sorted by the blocks' keys."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= least:  # up to the last block that is surely whole
            table = pa.Table.from_batches(held).combine_chunks()
            same = np.stack([table[c].to_numpy() for c in keys])
            same = (same == same[:, -1:]).all(0)
            if not same.all():
                cut_at = len(same) - int(np.argmin(same[::-1]))
                yield table.slice(0, cut_at)
                table = table.slice(cut_at).combine_chunks()
            held, size = table.to_batches(), table.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def several(table: pa.Table, keys: tuple[str, ...]) -> tuple[pa.Table, np.ndarray]:
    """The rows of blocks with more than one row, and the bounds of these blocks."""
    key = np.stack([table[c].to_numpy() for c in keys])
    bounds = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, key.shape[1]]
    sizes = np.diff(bounds)
    many = sizes > 1
    return table.filter(pa.array(np.repeat(many, sizes))), np.r_[0, np.cumsum(sizes[many])]


def joined_by(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) between components whose documents may be linked, from rows (token, p, q, nid, n, comp, side, sig) sorted by
    block: of each block at most an edge per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_blocks(batches, ("token", "p", "q"), 2 * BLOCK):
            table, bounds = several(table, ("token", "p", "q"))
            if not table.num_rows:
                continue
            comp = table["comp"].to_numpy()
            names, start = np.unique(comp, return_inverse=True)
            leaves = Leaves(table["n"].to_numpy(), start, table["side"].to_numpy(), table["sig"].combine_chunks().to_pylist(), num, den)
            labels = Labels(start)
            for i, j in Tree(leaves, bounds).pairs():
                labels.join(i, j)
                leaves.comp = labels.of
            pairs = np.unique(np.stack([labels.of, start], 1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(names[pairs[:, 0]]), pa.array(names[pairs[:, 1]])], ["a", "b"])

    return blocks.mapInArrow(run, "a bigint, b bigint").distinct()


def exact_bitmaps(values: list[np.ndarray]) -> np.ndarray | None:
    """Bitmaps of the tokens that two of the sets or more have: the common bits of two are their overlap. None if they were too large."""
    flat = np.concatenate(values)
    token, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.full(len(token), -1)
    number[count > 1] = np.arange((count > 1).sum())
    width = max(64, -(-int((count > 1).sum()) // 64) * 64)
    if len(values) * width // 8 > DENSE_BYTES:
        return None
    row, column = np.repeat(np.arange(len(values)), [*map(len, values)]), number[place]
    row, column = row[column >= 0], column[column >= 0]
    out = np.zeros((len(values), width // 8), np.uint8)
    np.bitwise_or.at(out, (row, column >> 3), (1 << (column & 7)).astype(np.uint8))
    return out.view(U64)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two ascending sets."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


class Families:
    """Exact overlaps of pairs of one batch, by bitmaps within larger families and by sets elsewhere."""

    def __init__(self, values: list[np.ndarray], bounds: np.ndarray):
        self.values, self.bounds, self.at, self.maps = values, bounds, -1, None

    def overlaps(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        family = np.searchsorted(self.bounds, i, "right") - 1
        for f in np.unique(family).tolist():
            at = np.flatnonzero(family == f)
            start, stop = int(self.bounds[f]), int(self.bounds[f + 1])
            if f != self.at:
                self.at, self.maps = f, exact_bitmaps(self.values[start:stop]) if stop - start > DENSE else None
            if self.maps is None:
                out[at] = [overlap(self.values[a], self.values[b]) for a, b in zip(i[at].tolist(), j[at].tolist(), strict=True)]
                continue
            step = max(1, (16 << 20) // (self.maps.shape[1] * 8))
            for k in range(0, len(at), step):
                own = at[k : k + step]
                out[own] = np.bitwise_count(self.maps[i[own] - start] & self.maps[j[own] - start]).sum(1, dtype=np.int64)
        return out


def linked(families: DataFrame, num: int, den: int) -> DataFrame:
    """From rows (family, p, q, nid, side, body) sorted by family, part and size: (a, b, n) with a = b for the count n of links of a
    node, and with a < b, n = 0 for links that join the same nodes as all links do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_blocks(batches, ("family", "p", "q"), 512):
            table, bounds = several(whole, ("family", "p", "q"))
            if not table.num_rows:
                continue
            nid = table["nid"].to_numpy()
            values = [np.frombuffer(x.as_buffer(), U64) for x in table["body"]]
            size = np.fromiter(map(len, values), np.int64, len(values))
            leaves = Leaves(size, np.arange(len(nid)), table["side"].to_numpy(), [signature(x, FAMILY_BITS) for x in values], num, den)
            exact, labels, degree = Families(values, bounds), Labels(np.arange(len(nid))), np.zeros(len(nid), np.int64)
            for i, j in Tree(leaves, bounds).pairs():
                common = exact.overlaps(i, j)
                good = common * den >= (size[i] + size[j] - common) * num
                i, j = i[good], j[good]
                degree += np.bincount(i, minlength=len(nid)) + np.bincount(j, minlength=len(nid))
                labels.join(i, j)
            some, own = np.flatnonzero(degree), np.flatnonzero(labels.of != np.arange(len(nid)))
            first, second = nid[labels.of[own]], nid[own]
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(np.r_[nid[some], np.minimum(first, second)]), pa.array(np.r_[nid[some], np.maximum(first, second)]), pa.array(np.r_[degree[some], np.zeros(len(own), np.int64)])], ["a", "b", "n"])

    return families.mapInArrow(run, "a bigint, b bigint, n bigint")


def parted(rows: DataFrame) -> DataFrame:
    """Adds p, q and side: blocks of more than one of their ``parts`` are dealt by the hash of the node, and every two parts meet; side
    tells them apart, and is -1 where a part meets itself."""
    parts = F.col("parts")
    dealt = rows.withColumn("_own", F.pmod(F.xxhash64("nid"), parts).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
    side = F.when(F.col("_own") == F.col("_other"), F.lit(-1)).otherwise((F.col("_own") > F.col("_other")).cast("int"))
    return dealt.withColumn("p", F.least("_own", "_other")).withColumn("q", F.greatest("_own", "_other")).withColumn("side", side).drop("_own", "_other", "parts")


def bodies(wanted: DataFrame, docs: DataFrame, k: int, salt: int, again: bool) -> DataFrame:
    """Adds the exact set, made from the text of the document ``rep`` whose set has the name and rest of the digest, to rows (nid, rest,
    rep, ..). Where rows share a doc_id (``again``), texts are found by the names of their sets, so that many rows of one doc_id do not
    all meet, and each task gives a set once."""
    small = wanted.count() * 64 <= BROADCAST_BYTES
    wanted_ = F.broadcast(wanted) if small else wanted
    if again:
        named = names(docs.select("text"), "text", k, salt)
        texts = named.join(wanted_, F.col("_nid") == F.col("nid"))
    else:
        texts = docs.withColumn("_rep", F.coalesce("doc_id", F.lit(NONE))).join(wanted_, F.col("_rep") == F.col("rep"))
    others = [c for c in wanted.columns if c not in ("nid", "rest", "rep")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in chunks(offsets):
                values, bounds = sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
                nid, rest = digests(values, bounds, salt)
                part = batch.slice(a, b - a)
                fits = np.flatnonzero((nid == part.column(0).to_numpy()) & (rest == part.column(1).to_numpy()))
                keep = [r for r in fits.tolist() if (name := int(nid[r])) not in given and not given.add(name)]
                if keep:
                    raw = [values[bounds[r] : bounds[r + 1]].tobytes() for r in keep]
                    taken = part.take(pa.array(keep))
                    yield pa.RecordBatch.from_arrays([taken.column(0), *taken.columns[3:], pa.array(raw, pa.binary())], ["nid", *others, "body"])

    schema = "nid bigint, " + "".join(f"`{c}` {wanted.schema[c].dataType.simpleString()}, " for c in others) + "body binary"
    found = texts.select("nid", "rest", "text", *others).mapInArrow(make, schema)
    return found.dropDuplicates(["nid"]) if again else found


def repeated(rows: DataFrame) -> bool:
    """Whether rows share a doc_id, or several have none."""
    return not rows.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").limit(1).isEmpty()


def join(documents: DataFrame, text: str = "text", key: str = "doc_id", k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable by links) and n_links (how many other sets its own is linked
    with)."""
    return named_join(documents, text, key, k, num, den)[0].drop("nid")


def names(documents: DataFrame, text: str, k: int, salt: int) -> DataFrame:
    """Adds the name of each row's set, as ``_nid``."""
    named = [*documents.columns, "_nid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            for a, b in chunks(offsets):
                nid, _ = digests(*sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k), salt)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], pa.array(nid)], named)

    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in documents.schema)
    return bounded(documents).select("*", F.col(text).cast("string").alias("_text")).mapInArrow(run, f"{columns}, _nid bigint")


def named_join(documents: DataFrame, text: str, key: str, k: int, num: int, den: int) -> tuple[DataFrame, int]:
    """``join`` with the name of each row's set, nid, and the salt of the names."""
    docs = bounded(documents).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    spark = docs.sparkSession
    seen, salt = cut(profile(docs, k, num, den, 0)), 0
    while not seen.where("kind = 0").groupBy("nid").agg(F.min("rest").alias("x"), F.max("rest").alias("y")).where("x <> y").limit(1).isEmpty():
        salt += 1  # two sets have one name
        seen = cut(profile(docs, k, num, den, salt))
    rows = seen.where("kind = 0")
    often = seen.where("kind = 1").groupBy("nid").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "nid").limit(FREQUENT).select("nid").toArrow()
    frequent = np.sort(often["nid"].to_numpy().view(U64)) if often.num_rows else np.zeros(0, U64)

    made = cut(prefixes(docs, k, num, den, frequent, salt))
    nodes = rows.where("n > 0").groupBy("nid").agg(F.first("rest").alias("rest"), F.first("n").alias("n"), F.coalesce(F.min("doc_id"), F.lit(NONE)).alias("rep"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64("nid"), F.lit(SALTS)).cast("bigint")

    def edges(entries: DataFrame, every: bool) -> DataFrame:
        """Of entries (token, salt, n, nid, comp): which components may be linked. With ``every``, all first tokens are among them."""
        kept = shared(entries, num, den)
        if every:  # a set's rows are fewer than the words of its text, so one exchange by set may gather them
            least = F.least(F.floor(F.col("n") / MORE) + 1, F.ceil(F.col("n") * num / den))
            kept = kept.withColumn("_c", F.count("*").over(Window.partitionBy("nid"))).where(F.col("_c") >= least).drop("_c")
        kept = cut(kept)
        blocks = cut(kept.groupBy("token").agg(F.count("*").alias("g")).where("g > 1").select("token", F.col("g").alias("n"), F.ceil(F.col("g") / BLOCK).cast("int").alias("parts")))
        placed = split_join(kept.withColumnRenamed("n", "size"), blocks, ["token"], ["nid"]).drop("n").withColumnRenamed("size", "n")
        some = cut(placed.select("nid").distinct())
        bitmaps = made.select("nid", "sig").join(F.broadcast(some) if some.count() * 16 <= BROADCAST_BYTES else some, "nid", "left_semi").groupBy("nid").agg(F.first("sig").alias("sig"))
        placed = parted(placed).join(bitmaps, "nid")
        dealt = placed.repartition(partitions, "token", "p", "q").sortWithinPartitions("token", "p", "q", "comp", "n", "nid")
        return cut(joined_by(dealt.select("token", "p", "q", "nid", "n", "comp", "side", "sig"), num, den))

    def tokens(frame: DataFrame, most: int | None) -> DataFrame:
        """One row per first token, salted where it is frequent."""
        if most:
            front = F.slice("first", 1, most)
            parts = front, F.slice("late", 1, F.greatest(F.lit(0), F.lit(most) - F.size(front)))
        else:
            parts = F.col("first"), F.col("late")
        every = F.concat(F.transform(parts[0], lambda x: F.struct(x.alias("token"), F.lit(-1).cast("bigint").alias("salt"))), F.transform(parts[1], lambda x: F.struct(x.alias("token"), spread.alias("salt"))))
        return frame.select(F.explode(every).alias("_t"), "n", "nid", "comp").select("_t.token", "_t.salt", "n", "nid", "comp")

    first = edges(tokens(made.withColumn("comp", F.col("nid")), FIRST), False)
    known = components(first).withColumnRenamed("node", "nid")
    known = F.broadcast(known) if known.count() * 40 <= BROADCAST_BYTES else known
    second = edges(tokens(made.join(known, "nid", "left").withColumn("comp", F.coalesce("root", "nid")), None), True)
    family = components(first.unionByName(second)).select(F.col("node").alias("nid"), F.col("root").alias("family"))

    named = family.join(nodes, "nid")
    parts = F.greatest(F.ceil(F.sum("n") / PART_TOKENS), F.ceil(F.count("*") / PART_NODES)).cast("int").alias("parts")
    wanted = cut(named.join(named.groupBy("family").agg(parts), "family"))
    placed = parted(bodies(wanted, docs, k, salt, repeated(rows)))
    dealt = placed.repartition(partitions, "family", "p", "q").sortWithinPartitions("family", "p", "q", "n", "nid")
    found = cut(linked(dealt.select("family", "p", "q", "nid", "side", "body"), num, den))
    roots = components(found.where("a < b").select("a", "b"))
    degree = found.where("a = b").groupBy(F.col("a").alias("nid")).agg(F.sum("n").alias("n_links"))
    least = rows.where("n > 0").groupBy("nid").agg(F.min("doc_id").alias("least"))
    own = least.join(roots.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    named = own.join(own.groupBy("root").agg(F.min("least").alias("component_id")), "root").join(degree, "nid", "left").select("nid", "component_id", "n_links")
    out = rows.where("n > 0").join(named, "nid").select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "nid")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links"), "nid")
    return out.unionByName(alone), salt


def keep_one(documents: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents without those whose component has a lesser doc_id; all columns stay, whatever their names. Of rows with equal doc_id
    and text one stays, whichever; of rows that share a doc_id but not a text each is judged by its own; rows without doc_id stay."""
    found, salt = named_join(documents, text, key, k, num, den)
    found = cut(found.select("doc_id", "component_id", "nid"))
    again = repeated(found)
    gone = cut(found.where("component_id < doc_id").select("doc_id", *(["nid"] if again else [])).distinct())
    small = gone.count() * (24 if again else 16) <= BROADCAST_BYTES
    gone = F.broadcast(gone) if small else gone
    if not again:
        return documents.join(gone, documents[key].cast("bigint") == gone["doc_id"], "left_anti")
    own = lambda c: F.col(f"`{c.replace('`', '``')}`")
    packed = documents.select(F.struct(*map(own, documents.columns)).alias("document"), own(key).cast("bigint").alias("doc_id"), own(text).cast("string").alias("text"))
    rows = names(packed, "text", k, salt)  # rows of one doc_id may be of several sets
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("nid").alias("_set"))
    left = rows.join(gone, (F.col("doc_id") == F.col("_gone")) & (F.col("_nid") == F.col("_set")), "left_anti")
    return left.where("doc_id is null").unionByName(left.where("doc_id is not null").dropDuplicates(["doc_id", "text"])).select("document.*")


#: The same for the defaults of ``join`` in SQL: sets of near sizes that share a shingle are counted, and links followed.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])))) END AS sh FROM w
), k AS (SELECT r, doc_id, len(sh) AS n, sh, md5(array_to_string(sh, chr(10))) AS k FROM s),
u AS (SELECT k, any_value(n) AS n, any_value(sh) AS sh, min(doc_id) AS least FROM k WHERE n > 0 GROUP BY k),
e AS (SELECT k, n, unnest(sh) AS t FROM u),
p AS (
  SELECT a.k AS x, b.k AS y FROM e a JOIN e b ON a.t = b.t AND a.k < b.k AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
reach AS (SELECT k AS x, k AS y FROM u UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
m AS (SELECT x AS k, min(least) AS component_id FROM reach JOIN u ON reach.y = u.k GROUP BY x),
d AS (SELECT x AS k, count(*) AS n_links FROM l GROUP BY x)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id, coalesce(n_links, 0) AS n_links
FROM k LEFT JOIN m USING (k) LEFT JOIN d USING (k)
"""
