"""Token ids in directly addressable codes: random access to any token without decoding a block.

An id is split into chunks of ``BITS`` bits, lowest first. Level 0 holds the first chunk of every id; a continuation bitmap says
which ids go on, and level 1 holds the next chunk of just those, in order, and so on. A rank directory holds the count of set bits
before every block of ``BLOCK`` bits, so the place of an id in the next level is one directory entry and one popcount away.

File format: a Parquet table in a folder that Spark can write, one row per shard, in ascending order of documents: partition,
shard, before (tokens of the partition's earlier shards), doc_ids, starts and counts (of its documents, in order: the place of the first
token within the shard, and how many there are), n_tokens, levels, bitmaps and ranks (one binary value per level). A shard closes at
``SHARD_TOKENS`` tokens; a document is never divided. All reading is by place, through the rank directories (``Levels.access``).

Defined cases: null text is empty; an empty text is the end id alone; rows that share a doc_id, or have none, keep one row each, in the
order of the table, and are dealt over tasks like others; null doc_ids come first; texts of any length are taken whole; other columns
are ignored; an empty table gives an empty table of the same schema.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from matchcast.shared import BROADCAST_BYTES, bounded
from matchcast.llm.vec import ragged, span_hashes


BITS, BLOCK, SHARD_TOKENS = 8, 512, 1 << 20
#: Bytes of text whose pre-tokens are in memory at once, and pre-tokens that the cache may hold.
CHUNK_BYTES, CACHE_WORDS = 1 << 20, 2_000_000
#: Places that are read at once, and most places that a shard is asked for in one row.
PLACES, ASKED = 1 << 16, 1 << 16
#: Fixed value: the split pattern of the byte-level vocabulary, as the library applies it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Levels:
    """Directly addressable codes of unsigned 32-bit ids."""

    def __init__(self, levels: list[np.ndarray], bitmaps: list[np.ndarray], ranks: list[np.ndarray]):
        self.levels, self.bitmaps, self.ranks = levels, bitmaps, ranks

    @classmethod
    def of(cls, ids: np.ndarray) -> Levels:
        levels, bitmaps, ranks, rest = [], [], [], ids.astype(np.uint32)
        while True:
            levels.append((rest & np.uint32((1 << BITS) - 1)).astype(np.uint8))
            on = rest >> np.uint32(BITS) != 0
            bits = np.zeros(-(-len(rest) // BLOCK) * (BLOCK // 8), np.uint8)
            packed = np.packbits(on, bitorder="little")
            bits[: len(packed)] = packed
            per = np.bitwise_count(bits.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
            bitmaps.append(bits)
            ranks.append(np.r_[np.uint32(0), np.cumsum(per, dtype=np.uint32)[:-1]].astype(np.uint32) if len(per) else per)
            rest = rest[on] >> np.uint32(BITS)
            if not len(rest):
                return cls(levels, bitmaps, ranks)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at any places, in any order."""
        place = np.asarray(at, np.int64)
        value = np.zeros(len(place), np.uint32)
        live = np.arange(len(place))
        for k, level in enumerate(self.levels):
            value[live] |= level[place].astype(np.uint32) << np.uint32(BITS * k)
            bits = self.bitmaps[k]
            goes = bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
            live, place = live[goes], place[goes]
            if not len(live):
                break
            place = self.rank(k, place)
        return value

    def rank(self, k: int, place: np.ndarray) -> np.ndarray:
        """Set bits of the level's bitmap before each place: the directory's count before its block, and popcounts within the block."""
        words = self.bitmaps[k].view(np.uint64)
        word, first = place >> 6, place // BLOCK * (BLOCK // 64)
        count = self.ranks[k][place // BLOCK].astype(np.int64)
        for j in range(BLOCK // 64 - 1):
            more = np.flatnonzero(first + j < word)
            if not len(more):
                break
            count[more] += np.bitwise_count(words[first[more] + j])
        return count + np.bitwise_count(words[word] & (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids at the places from ``start`` to ``stop``, in portions."""
        found = [self.access(np.arange(a, min(a + PLACES, stop))) for a in range(start, stop, PLACES)]
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def blobs(self) -> tuple[list[bytes], list[bytes], list[bytes]]:
        return [x.tobytes() for x in self.levels], [x.tobytes() for x in self.bitmaps], [x.tobytes() for x in self.ranks]

    @classmethod
    def read(cls, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]) -> Levels:
        view = lambda blobs, kind: [np.frombuffer(x, kind) for x in blobs]
        return cls(view(levels, np.uint8), view(bitmaps, np.uint8), view(ranks, np.uint32))


#: Classes of Latin-1 characters: 1 letters, 2 numbers, 3 other signs, 4 white space.
KINDS = np.full(256, 3, np.uint8)
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]] = 1
KINDS[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = 2
KINDS[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = 4


def pre_token_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens that PATTERN finds in Latin-1 texts without apostrophes.

    A run of letters, numbers or signs takes one space before it along; of white space before other characters, all but the last
    character is one pre-token, and the last its own unless it is taken along."""
    n = len(data)
    kind = KINDS[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    gap = kind == 4
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= first[:-1]
    led = np.zeros(n, bool)  # after a space of the same text
    led[1:] = (data[:-1] == 0x20) & ~first[1:-1]
    before = np.zeros(n, bool)  # the last of white space, with another character of the same text after it
    before[:-1] = ~gap[1:] & ~first[1:-1]
    return np.flatnonzero(np.where(gap, change | before, change & ~led))


class Encoder:
    """The tokenizers library behind a bounded cache of pre-tokens, looked up by their 64-bit hashes for whole chunks at once."""

    def __init__(self, path: str, end_id: int, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library, self.limit = Tokenizer.from_file(path), cache_words
        self.library.no_padding()
        self.library.no_truncation()
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary has ids beyond 16 bits")
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.end = np.array([end_id], np.uint16).tobytes()
        self.forget()

    def forget(self) -> None:
        """Hashes in ascending order, and for each the place and count of its ids."""
        self.known, self.place, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint16)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Adds pre-tokens, whose hashes ascend and are new."""
        ids, counts = [], []
        for s in range(0, len(words), 20_000):
            found = self.library.encode(words[s : s + 20_000], is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint16))
            counts.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(words[s : s + 20_000])))
        count = np.concatenate(counts).astype(np.int32)
        place = len(self.ids) + np.cumsum(count, dtype=np.int32) - count
        at = np.searchsorted(self.known, hashes)
        self.known, self.place, self.count = np.insert(self.known, at, hashes), np.insert(self.place, at, place), np.insert(self.count, at, count)
        self.ids = np.concatenate([self.ids, *ids])

    def chunk(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of Latin-1 texts without apostrophes and special tokens."""
        offsets = np.r_[0, np.cumsum([*map(len, texts)])]
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        starts = pre_token_starts(data, offsets)
        ends = np.r_[starts[1:], len(data)]
        if not len(starts):
            yield from (b"" for _ in texts)
            return
        hashes, inverse = np.unique(span_hashes(data, starts, ends), return_inverse=True)
        if len(self.known) + len(hashes) > self.limit:
            self.forget()
        at = np.searchsorted(self.known, hashes)
        lost = np.ones(len(hashes), bool)
        inside = at < len(self.known)
        lost[inside] = self.known[at[inside]] != hashes[inside]
        if lost.any():
            example = np.zeros(len(hashes), np.int64)
            example[inverse] = np.arange(len(starts))
            some = example[lost]
            self.learn(hashes[lost], [joined[a:b].decode("latin-1") for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)])
            at = np.searchsorted(self.known, hashes)
        entry = at[inverse]
        counts = self.count[entry].astype(np.int64)
        flat = self.ids[np.repeat(self.place[entry].astype(np.int64), counts) + ragged(counts)]
        total = np.r_[0, np.cumsum(counts)]
        cuts = total[np.searchsorted(starts, offsets)].tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield flat[a:b].tobytes()

    def rows(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text and the end id, as little-endian unsigned 16-bit values. A text that is not within Latin-1, has an
        apostrophe or a special token goes to the library whole."""
        i = 0
        while i < len(texts):
            narrow, whole, size, start = [], {}, 0, i
            while i < len(texts) and size < CHUNK_BYTES:
                text, plain = texts[i], None
                if "'" not in text and not any(x in text for x in self.special):
                    try:
                        plain = text.encode("latin-1")
                    except UnicodeEncodeError:
                        pass
                if plain is None:
                    whole[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()
                else:
                    narrow.append(plain)
                size += len(text)
                i += 1
            got = self.chunk(narrow) if narrow else iter(())
            for k in range(start, i):
                yield (whole[k] if k in whole else next(got)) + self.end


@lru_cache(maxsize=1)
def worker_encoder(path: str, end_id: int) -> Encoder:
    """One per Python worker, whose tasks share its cache."""
    return Encoder(path, end_id)


SHARDS = T.StructType([
    T.StructField("partition", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.LongType()), T.StructField("levels", T.ArrayType(T.BinaryType())),
    T.StructField("bitmaps", T.ArrayType(T.BinaryType())), T.StructField("ranks", T.ArrayType(T.BinaryType())),
])
ARROW = pa.schema([("partition", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("n_tokens", pa.int64()), *((x, pa.list_(pa.binary())) for x in ("levels", "bitmaps", "ranks"))])


def write(docs: DataFrame, path: str, folder: str, text: str = "text", key: str = "doc_id", end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes every whole text and writes the shards to ``folder`` in ascending order of ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = worker_encoder(path, end_id), 0
        keys: list[int] = []
        parts: list[bytes] = []
        size = partition = before = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), np.uint16)
            levels, bitmaps, ranks = Levels.of(ids).blobs()
            counts = np.fromiter((len(x) // 2 for x in parts), np.int64, len(parts))
            row = [[partition], [shard], [before], [keys], [np.cumsum(counts) - counts], [counts], [len(ids)], [levels], [bitmaps], [ranks]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, ARROW.types, strict=True)], schema=ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            partition = batch.column(2)[0].as_py()
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                for k, ids in zip(part.column(0).to_pylist(), encoder.rows([x or "" for x in part.column(1).to_pylist()]), strict=True):
                    keys.append(k)
                    parts.append(ids)
                    size += len(ids) // 2
                    if size >= shard_tokens:
                        yield close()
                        keys, parts, size, shard, before = [], [], 0, shard + 1, before + size
        if parts:
            yield close()

    spark = bounded(docs).sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).cast("string").alias("t"), F.monotonically_increasing_id().alias("m")).repartitionByRange(n, "k", "m").sortWithinPartitions("k", "m")
    ordered.select("k", "t", F.spark_partition_id().alias("p")).mapInArrow(run, SHARDS).write.parquet(folder)


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document, from the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The counts of the writer's partitions, a row each, are summed up to give every partition its offset, and go to the shards in a
    join; the shards themselves stay where they are read."""
    spark = bounded(shards).sparkSession
    totals = sorted((r["partition"], r["n"]) for r in shards.groupBy("partition").agg(F.sum("n_tokens").alias("n")).collect())
    before, offsets = 0, []
    for p, n in totals:
        offsets.append((p, before))
        before += n
    bases = spark.createDataFrame(offsets, "partition int, base bigint")
    placed = shards.join(F.broadcast(bases) if 16 * len(offsets) <= BROADCAST_BYTES else bases, "partition").withColumn("start", F.col("base") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = Levels.read(row["levels"], row["bitmaps"], row["ranks"])
                starts, counts = np.array(row["starts"], np.int64), np.array(row["counts"], np.int64)
                view = memoryview(levels.span(0, int(counts.sum())).astype("<u4").tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), (starts + counts).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + starts), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("doc_ids", "starts", "counts", "levels", "bitmaps", "ranks", "start").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def lookup(shards: DataFrame, wanted: DataFrame, doc: str = "doc_id", at: str = "at") -> DataFrame:
    """Token at place ``at`` of each wanted document, by random access; no row where there is no such place.

    ``wanted`` (doc_id, at) meets the documents of the shards' directory by a join on doc_id; only the shards' hit rows are read. A shard
    that is asked for many places gets them in lists of about ``ASKED``."""
    directory = shards.select("partition", "shard", F.explode(F.arrays_zip("doc_ids", "starts", "counts")).alias("d"))
    directory = directory.select("partition", "shard", F.col("d.doc_ids").alias("doc_id"), F.col("d.starts").alias("first"), F.col("d.counts").alias("n"))
    hits = wanted.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(at).cast("bigint").alias("at")).join(directory, "doc_id").where("at >= 0 and at < n")
    parts = hits.groupBy("partition", "shard").agg(F.ceil(F.count("*") / ASKED).alias("parts"))
    dealt = hits.join(parts, ["partition", "shard"]).withColumn("part", F.pmod(F.xxhash64("doc_id", "at", F.monotonically_increasing_id()), F.col("parts")))
    grouped = dealt.groupBy("partition", "shard", "part").agg(F.collect_list(F.struct("doc_id", "at", (F.col("first") + F.col("at")).alias("place"))).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                got = Levels.read(row["levels"], row["bitmaps"], row["ranks"]).access(np.array([x["place"] for x in row["asked"]]))
                yield pa.RecordBatch.from_arrays([pa.array([x["doc_id"] for x in row["asked"]], pa.int64()), pa.array([x["at"] for x in row["asked"]], pa.int64()), pa.array(got.astype(np.int64))], ["doc_id", "at", "token"])

    return shards.join(grouped, ["partition", "shard"]).select("levels", "bitmaps", "ranks", "asked").mapInArrow(run, "doc_id bigint, at bigint, token bigint")
