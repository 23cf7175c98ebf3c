"""BPE encoding and decoding through a pair occurrence index.

The distinct pre-tokens of a batch are laid end to end as one linked sequence of symbols. An index maps every pair that has
a merge to all its positions in the batch; ranks are taken in ascending order from a heap, all positions of a rank are merged
at once, and only the lists of the pairs that those merges touch are updated. Results per pre-token are kept in a bounded cache.

Defined cases: null text is empty; an empty text has no ids and decodes to the empty string; repeated rows and texts give equal
rows; texts of any length are taken whole (memory follows the longest single text); other columns are ignored; an empty table
gives an empty table of the same schema.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchcast.shared import bounded

#: Bytes of text whose words are in memory at once, and words that the cache may hold.
CHUNK_BYTES, CACHE_WORDS = 4 << 20, 250_000


def compiled(letters: str, numbers: str, spaces: str) -> re.Pattern:
    """The split pattern of the vocabulary file: contractions (fixed values), letters, single numbers, other signs."""
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


#: For texts within Latin-1, whose classes are short.
NARROW = compiled("A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\x09-\x0d\x20\x85\xa0")


@lru_cache(maxsize=1)
def wide() -> tuple[re.Pattern, dict[int, str]]:
    """For other texts: the pattern with the letters, numbers and white space of the tokenizers library's own Unicode tables,
    and the characters that it lower-cases in another way than Python."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    found = []
    for kind in (r"\p{L}+", r"\p{N}+", r"\s+"):
        runs = pre_tokenizers.Split(Regex(kind), "removed", invert=True).pre_tokenize_str(every)
        found.append("".join(f"\\U{ord(x[0]):08x}-\\U{ord(x[-1]):08x}" for run, _ in runs for x in whole_ranges(run)))
    lower = normalizers.Lowercase().normalize_str("\n".join(every[11:])).split("\n")
    return compiled(*found), {ord(c): y for c, y in zip(every[11:], lower, strict=True) if c.lower() != y}


def whole_ranges(run: str) -> list[str]:
    """A run of characters in ascending order, cut where code points are missing."""
    codes = np.array([*map(ord, run)])
    at = np.flatnonzero(np.r_[True, np.diff(codes) != 1, True])
    return [run[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class PairIndexBPE:
    """Merges of a vocabulary file, applied to many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        cut = len(model["continuing_subword_prefix"] or "")
        self.left, self.right, self.made = left, right, np.array([self.vocab[a + b[cut:]] for a, b in pairs], np.int64)
        keys = left << 32 | right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        letters = byte_letters()
        self.plain = np.array([self.vocab[c] for c in letters], np.int64)
        self.final = np.array([self.vocab[c + self.suffix] for c in letters], np.int64)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where there is no merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, and n + 1 offsets into them."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(words) else 0
        if not total:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        last = ends[sizes > 0] - 1
        symbol = self.plain[raw]
        symbol[last] = self.final[raw[last]]
        after, before = np.arange(1, total + 1), np.arange(-1, total - 1)
        after[last] = -1
        before[ends[:-1][ends[:-1] < total]] = -1
        before[0] = -1
        alive = np.ones(total, bool)

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(positions: np.ndarray) -> None:
            """Adds the pairs that begin at the positions to the lists of their ranks."""
            rank = self.ranks(symbol[positions], symbol[after[positions]])
            keep = rank >= 0
            rank, positions = rank[keep], positions[keep]
            if not len(rank):
                return
            if len(rank) > 1:
                by = np.argsort(rank, kind="stable")
                rank, positions = rank[by], positions[by]
            starts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
            for r, s, e in zip(rank[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(rank)], strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(positions[s:e])

        note(np.flatnonzero(after >= 0))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            a, b, new = self.left[rank], self.right[rank], self.made[rank]
            at = at[alive[at] & (symbol[at] == a)]
            at = at[after[at] >= 0]
            at = at[symbol[after[at]] == b]
            if a == b and len(at) > 1:  # of overlapping pairs, the leftmost goes first
                keep, taken = [], -1
                for p, q in zip(at.tolist(), after[at].tolist(), strict=True):
                    if p != taken:
                        keep.append(p)
                        taken = q
                at = np.array(keep, np.int64)
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbol[at] = new
            alive[gone] = False
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            prior = before[at]
            touched = np.concatenate([prior[prior >= 0], at[inner]])
            if len(touched):
                note(touched)
        kept = np.flatnonzero(alive)
        return symbol[kept], np.searchsorted(kept, np.r_[0, ends])

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of NFC text in lower case, each character by itself. White space never reaches one, so its runs may stay."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pattern, special = wide()
            text = unicodedata.normalize("NFC", text)
            return pattern.findall(text.translate(special).replace("Σ", "σ").lower())
        return NARROW.findall(text.lower())

    def words(self, text: str) -> list[str]:
        """Pre-tokens; those of the special tokens' strings stand as they are, with a null character before them."""
        if "<|" not in text or not self.specials or not self.specials.search(text):
            return self.pieces(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += self.pieces(text[at : m.start()])
            out.append("\0" + m[0])
            at = m.end()
        return out + self.pieces(text[at:])

    def decode(self, ids) -> str:
        """The file names no decoder: tokens are joined by one space."""
        token = self.token
        return " ".join([token[i] for i in ids])


@lru_cache(maxsize=2)
def loaded(path: str) -> PairIndexBPE:
    return PairIndexBPE(path)


class Codec:
    """Encodes and decodes texts chunk by chunk with a cache of pre-tokens: word -> ids as text, decoded text."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.bpe, self.limit = loaded(path), cache_words
        self.ids: dict[str, str] = {}
        self.text: dict[str, str] = {}

    def learn(self, lists: list[list[str]]) -> None:
        new = set().union(*lists)
        if len(self.ids) + len(new) > self.limit:
            self.ids.clear()
            self.text.clear()
        new.difference_update(self.ids)
        marked = [w for w in new if w[0] == "\0" and w[1:] in self.bpe.special]
        for w in marked:
            i = self.bpe.special[w[1:]]
            self.ids[w], self.text[w] = str(i), self.bpe.decode([i])
        fresh = list(new.difference(marked))
        found, at = self.bpe.encode_words([w.encode() for w in fresh])
        flat, places = found.tolist(), at.tolist()
        for w, s, e in zip(fresh, places, places[1:], strict=False):
            own = flat[s:e]
            self.ids[w], self.text[w] = " ".join(map(str, own)), self.bpe.decode(own)

    def rows(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Count of ids, ids joined by one space, and the decoded text."""
        i = 0
        while i < len(texts):
            lists, size = [], 0
            while i < len(texts) and size < CHUNK_BYTES:
                lists.append(self.bpe.words(texts[i]))
                size += len(texts[i])
                i += 1
            self.learn(lists)
            ids, text = self.ids.__getitem__, self.text.__getitem__
            for words in lists:
                joined = " ".join(map(ids, words))
                yield joined.count(" ") + bool(joined), joined, " ".join(map(text, words))


def encode_ids(path: str, texts: list[str]) -> list[list[int]]:
    """Ids of each text."""
    return [list(map(int, ids.split())) for _, ids, _ in Codec(path).rows(texts)]


SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", content: bool = False) -> DataFrame:
    """Encodes and decodes every whole text. ``content`` adds the ids (array) and the decoded text themselves.

    ``path`` is the vocabulary file's place on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                n, ids, back, full_ids, full = [], [], [], [], []
                for count, joined, decoded in codec.rows([x or "" for x in part.column(1).to_pylist()]):
                    n.append(count)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    back.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if content:
                        full_ids.append(list(map(int, joined.split())))
                        full.append(decoded)
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if content:
                    columns += [pa.array(full_ids, pa.list_(pa.int32())), pa.array(full, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return bounded(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA + (", ids array<int>, decoded string" if content else ""))
