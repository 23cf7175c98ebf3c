"""Substring deduplication by hashing of lines and of parts of lines.

Units are normalised (A-Z in lower case, white space runs as one), digested to 128 bits, and grouped over the whole corpus. Of each
digest the earliest ranked occurrence stays: that in the smallest doc_id (of rows that share it, in the first row), and there the
first. All others are removed, and their offsets in the original text are kept. A passage that is copied into running text is found by the sentences within it and, whatever its
punctuation, by the runs of words within it that end where a word's hash says so.

Units with fewer words than ``LINE_WORDS``, ``SENTENCE_WORDS`` or ``RUN_WORDS`` are left alone, unless they have ``LINE_CHARS`` (lines) or
``PART_CHARS`` (sentences, runs) characters.

Passages are found apart from units (``passages``): every stretch of ``PASSAGE_WORDS`` words or more that stands earlier in the corpus is
removed whole, wherever it begins and ends. All windows of so many words are named by the least hash of the short runs of words in them,
so equal windows have equal names. Names of one occurrence are dropped; where all windows of a name stand in the same surroundings, these
are compared as one, and elsewhere each window is. Each character of a script without spaces, or of a word of over ``LONG_WORD`` bytes,
is a word there. Of a passage that repeats within a document and overlaps its first occurrence, the words beyond that are removed.

The groups are aggregated (least doc_id, count) before the exchange, so a line of a third of all documents is one row
per task; the occurrences are then joined to the repeated digests only, and those of a digest that very many have are dealt over tasks
(``hot``).

Digests that repeat are marked in maps of a fixed ``NAME_BITS`` bits, which go to every worker, so that only units whose bit is set are
exchanged with their offsets. Units that share a bit cost rows and change no result.

Defined cases: null and empty texts have no units; null doc_ids rank last; rows that share a doc_id, or have none, are documents of
their own, ranked by (doc_id, row), so of repeated rows all but one lose their units; texts of any length are taken whole; other columns
are ignored, and may be named as ours are; an empty table gives an empty table of the same schema. Offsets are code points, end
exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from matchcast.shared import bounded, cut
from matchcast.llm.hot import split_join
from matchcast.llm.vec import LOWER, SPACE, U64, chunks, mix, powers, ragged, span_hashes, utf8, words

LINE_WORDS, SENTENCE_WORDS, RUN_WORDS = 3, 5, 7
#: Characters from which a line, or a sentence or run, is a unit however few its words.
LINE_CHARS, PART_CHARS = 20, 40
#: Least words of a passage, words of the runs that name its windows, and the level of its pieces.
PASSAGE_WORDS, NAME_WORDS, PASSAGE = 50, 8, 3
#: Words of more bytes are taken by their characters in passages.
LONG_WORD = 64
#: Bits of the maps of repeated names. Names that share a bit cost rows and change no result.
NAME_BITS = 1 << 27
#: One word in so many ends a run.
RUN_ENDS = 10
LAST = (1 << 63) - 1


def units(data: np.ndarray, offsets: np.ndarray, line_words: int, sentence_words: int, run_words: int = RUN_WORDS) -> dict[str, np.ndarray]:
    """Row, level (0 line, 1 sentence, 2 run), both halves of the digest, byte offsets of each unit, first of its digest in its row or not."""
    data = LOWER[data]
    starts, ends, rows = words(data, offsets, ~SPACE)
    n = len(starts)
    if not n:
        return {k: np.zeros(0, np.int64) for k in ("row", "level", "h1", "h2", "start", "end", "fresh")}
    new_line = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 0x0A, out=new_line[1:])
    breaks = np.ones(n, bool)
    breaks[1:] = (rows[1:] != rows[:-1]) | (new_line[starts[1:]] != new_line[ends[:-1]])
    stops = np.zeros(256, bool)
    stops[[ord("."), ord("!"), ord("?")]] = True
    cuts = breaks.copy()
    cuts[1:] |= stops[data[ends[:-1] - 1]]

    own = span_hashes(data, starts, ends)
    runs = np.ones(n, bool)
    runs[1:] = (rows[1:] != rows[:-1]) | (own[:-1] % U64(RUN_ENDS) == 0)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    up, down = powers(n + 1)
    sums = []
    for salt in (U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)):
        total = np.zeros(n + 1, U64)
        np.cumsum(mix(own ^ salt) * up[:-1], out=total[1:])
        sums.append(total)
    found = []
    for level, marks, least, long in ((0, breaks, line_words, LINE_CHARS), (1, cuts, sentence_words, PART_CHARS), (2, runs, run_words, PART_CHARS)):
        first = np.flatnonzero(marks)
        last = np.r_[first[1:], n]
        keep = (last - first >= least) | (chars[ends[last - 1]] - chars[starts[first]] >= long)
        first, last = first[keep], last[keep]
        size = (last - first).astype(U64) * U64(4) + U64(level)
        found.append((rows[first], np.full(len(first), level), *(mix((t[last] - t[first]) * down[first] + size) for t in sums), starts[first], ends[last - 1]))
    row, level, h1, h2, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
    by = np.lexsort((start, h2, h1, row))
    fresh = np.ones(len(by), bool)
    r, a, b = row[by], h1[by], h2[by]
    fresh[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first_of = np.empty(len(by), bool)
    first_of[by] = fresh
    return {"row": row, "level": level, "h1": h1.view(np.int64), "h2": h2.view(np.int64), "start": start, "end": end, "fresh": first_of}


def places_of(docs: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    """The documents with their rank as columns ``_rank_doc`` and ``_rank_row``, and which of these tell rows apart.

    The key alone does where no two rows share it. Else rows are numbered as well, in a copy in the shared folder, so that every later
    pass sees the same numbers."""
    ranked = docs.withColumn("_rank_doc", F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)))
    if ranked.groupBy("_rank_doc").agg(F.count("*").alias("n")).where("n > 1").limit(1).isEmpty():
        return ranked.withColumn("_rank_row", F.lit(0).cast("bigint")), ["_rank_doc"]
    return cut(ranked.withColumn("_rank_row", F.monotonically_increasing_id())), ["_rank_doc", "_rank_row"]


def place(at: list[str]) -> Column:
    """What ranks occurrences: one number, or the pair in its order."""
    return F.col(at[0]) if len(at) == 1 else F.struct(*at)


def first(c: Column, at: list[str]) -> Column:
    """The doc_id of a place."""
    doc = c if len(at) == 1 else c[at[0]]
    return F.when(doc < LAST, doc)


def marked(names: DataFrame, *flags: Column) -> np.ndarray:
    """Maps of ``NAME_BITS`` bits of the names h1: in the first those of all rows, in the others those of the rows with the flag."""
    bit = F.expr("shiftleft(1L, cast(h1 & 63 as int))")
    columns = [bit.alias("m0"), *(F.when(f, bit).otherwise(F.lit(0).cast("bigint")).alias(f"m{i + 1}") for i, f in enumerate(flags))]
    marks = names.select(F.shiftright(F.col("h1").bitwiseAND(F.lit(NAME_BITS - 1)), 6).alias("word"), *columns)
    found = marks.groupBy("word").agg(*(F.bit_or(f"m{i}").alias(f"m{i}") for i in range(len(columns)))).toArrow()
    out = np.zeros((len(columns), NAME_BITS >> 6), U64)
    for i in range(len(columns)):
        out[i, found["word"].to_numpy()] = found[f"m{i}"].to_numpy().view(U64)
    return out


def holds(marks: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Whether the bit of each name is set."""
    bit = names & U64(NAME_BITS - 1)
    return (marks[(bit >> U64(6)).astype(np.int64)] >> (bit & U64(63)) & U64(1)).astype(bool)


def portions(batches: Iterator[pa.RecordBatch], ranks: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Ranks, bytes and offsets of rows (ranks.., text), in portions of bounded bytes."""
    for batch in batches:
        data, offsets = utf8(batch.column(ranks))
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(ranks)]
        for a, b in chunks(offsets):
            yield [k[a:b] for k in keys], data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def points(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, *at: np.ndarray) -> list[pa.Array]:
    """Code points before each byte offset, within its row."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    base = total[offsets[row]]
    return [pa.array((total[x] - base).astype(np.int32)) for x in at]


def typed(at: list[str], rest: str) -> str:
    return ", ".join(f"{c} bigint" for c in at) + ", " + rest


def unit_rows(ranked: DataFrame, at: list[str], text: str, limits: tuple[int, int, int], sent=None) -> DataFrame:
    """Ranks and digest of all units; with the broadcast maps ``sent``, of those whose name is marked there, also level, offsets, and
    whether the unit is the first of its digest in its row."""
    names = [*at, "h1", "h2", *(() if sent is None else ("level", "start", "end", "fresh"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, data, offsets in portions(batches, len(at)):
            u = units(data, offsets, *limits)
            if sent is not None:
                some = holds(sent.value[0], u["h1"].view(U64))
                u = {k: v[some] for k, v in u.items()}
            columns = [*(pa.array(k[u["row"]]) for k in keys), pa.array(u["h1"]), pa.array(u["h2"])]
            if sent is not None:
                columns += [pa.array(u["level"].astype(np.int8)), *points(data, offsets, u["row"], u["start"], u["end"]), pa.array(u["fresh"].astype(bool))]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = ranked.select(*at, F.col(text).cast("string"))
    return source.mapInArrow(run, typed(at, "h1 bigint, h2 bigint" + ("" if sent is None else ", level tinyint, start int, end int, fresh boolean")))


def ranked_repeats(ranked: DataFrame, at: list[str], text: str, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """Every unit to remove: ranks, level, start, end, kept (the place that keeps it)."""
    limits = line_words, sentence_words, run_words
    groups = unit_rows(ranked, at, text, limits).groupBy("h1", "h2").agg(F.min(place(at)).alias("kept"), F.count("*").alias("n"))
    many = cut(groups.where("n > 1"))
    sent = ranked.sparkSession.sparkContext.broadcast(marked(many))
    gone = split_join(unit_rows(ranked, at, text, limits, sent), many, ["h1", "h2"], [*at, "start"]).where((place(at) > F.col("kept")) | ~F.col("fresh"))
    return gone.select(*at, "level", "start", "end", "kept")


def named(found: DataFrame, at: list[str]) -> DataFrame:
    """doc_id, row (null where the key alone tells rows apart), level, start, end, kept_doc_id."""
    row = F.col(at[1]) if len(at) > 1 else F.lit(None).cast("bigint")
    return found.select(first(place(at), at).alias("doc_id"), row.alias("row"), "level", "start", "end", first(F.col("kept"), at).alias("kept_doc_id"))


def repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", **limits: int) -> DataFrame:
    """Every unit to remove: doc_id, row, level, start, end, kept_doc_id."""
    ranked, at = places_of(bounded(docs), key)
    return named(ranked_repeats(ranked, at, text, **limits), at)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of words, where characters of scripts without spaces and of long words stand alone."""
    starts, ends, rows = words(data, offsets, ~SPACE)
    long = ends - starts > LONG_WORD
    lead = (data & 0xC0) != 0x80
    first, second = data, np.r_[data[1:], np.zeros(min(1, len(data)), np.uint8)]
    alone = (first >= 0xE3) & (first <= 0xE9)  # kana and Chinese characters
    alone |= (first == 0xE0) & (second >= 0xB8) & (second <= 0xBF)  # Thai, Lao, Tibetan
    alone |= (first == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second == 0x9E) | (second == 0x9F))  # Burmese, Khmer
    alone |= (first == 0xEF) & ((second >= 0xA4) & (second <= 0xAB) | (second >= 0xBC) & (second <= 0xBE))
    alone |= (first == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    alone &= lead
    if not (alone.any() or long.any()):
        return starts, ends, rows
    edge = np.zeros(len(data) + 1, np.int64)
    edge[starts[long]] += 1
    edge[ends[long]] -= 1
    alone |= lead & (np.cumsum(edge[:-1]) > 0)
    begins = alone.copy()
    begins[starts] = True
    at = np.flatnonzero(lead)
    begins[at[1:][alone[at[:-1]]]] = True
    begins &= ~SPACE[data]
    own = np.flatnonzero(begins)
    word = np.searchsorted(starts, own, "right") - 1
    stops = ends[word]
    stops[:-1] = np.minimum(stops[:-1], own[1:])
    return own, stops, rows[word]


def least_of(values: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value, and its first place, of every ``w`` values in a row."""
    v, at, size = values, np.arange(len(values)), 1
    while size < w:
        step = min(size, w - size)
        take = v[step:] < v[:-step]
        v, at, size = np.where(take, v[step:], v[:-step]), np.where(take, at[step:], at[:-step]), size + step
    return v, at


def windows(data: np.ndarray, offsets: np.ndarray, size: int) -> dict[str, np.ndarray] | None:
    """Groups of neighbouring windows of ``size`` words with one place of the least hash: row, name, first window, number of windows, and
    digest of all words in them; the tokens' starts and ends, and the digest of every window. None where no row has a window."""
    data = LOWER[data]
    starts, ends, rows = tokens(data, offsets)
    n = len(starts)
    if n < size:
        return None
    own = span_hashes(data, starts, ends)
    up, down = powers(n + 1)
    total = []
    for salt in (U64(0xC0AC29B7C97C50DD), U64(0x3F84D5B5B5470917)):
        t = np.zeros(n + 1, U64)
        np.cumsum(mix(own ^ salt) * up[:-1], out=t[1:])
        total.append(t)
    k = min(NAME_WORDS, size)
    short = mix((total[0][k:] - total[0][:-k]) * down[: n - k + 1])
    whole = mix((total[1][size:] - total[1][:-size]) * down[: n - size + 1] + U64(size))
    name, place = least_of(short, size - k + 1)
    full = np.flatnonzero(rows[: n - size + 1] == rows[size - 1 :])
    if not len(full):
        return None
    fresh = np.ones(len(full), bool)
    fresh[1:] = (place[full[1:]] != place[full[:-1]]) | (full[1:] != full[:-1] + 1)
    at = np.flatnonzero(fresh)
    count = np.diff(np.r_[at, len(full)])
    first = full[at]
    last = first + count - 1 + size
    digest = mix((total[1][last] - total[1][first]) * down[first] + (count + size - 1).astype(U64) * U64(4) + U64(3))
    return {"row": rows[first], "name": name[first], "first": first, "count": count, "digest": digest, "whole": whole, "starts": starts, "ends": ends}


def pieces(w: dict[str, np.ndarray], size: int, seen: np.ndarray) -> dict[str, np.ndarray]:
    """Those windows whose name is repeated, by the maps ``seen`` of bits of names that repeat and of those in various surroundings: row,
    digest, byte offsets, where they begin beyond the first of their digest in the row, and whether they are that."""
    several, various = holds(seen[0], w["name"]), holds(seen[1], w["name"])
    one, each = np.flatnonzero(several & ~various), np.flatnonzero(several & various)
    count = w["count"][each]
    split = np.repeat(w["first"][each], count) + ragged(count)
    row = np.r_[w["row"][one], np.repeat(w["row"][each], count)]
    h1 = np.r_[w["name"][one], np.repeat(w["name"][each], count)]
    h2 = np.r_[w["digest"][one], w["whole"][split]]
    first = np.r_[w["first"][one], split]
    last = first + np.r_[w["count"][one], np.ones(len(split), np.int64)] + size - 2
    by = np.lexsort((first, h2, h1, row))
    fresh = np.ones(len(by), bool)
    r, a, b = row[by], h1[by], h2[by]
    fresh[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first_of, earliest = np.empty(len(by), bool), np.empty(len(by), np.int64)
    first_of[by] = fresh
    if len(by):
        earliest[by] = first[by][np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    beyond = np.where(first_of, first, np.maximum(first, earliest + size))
    return {"row": row, "h1": h1.view(np.int64), "h2": h2.view(np.int64), "start": w["starts"][first], "own": w["starts"][np.minimum(beyond, last)], "end": w["ends"][last], "fresh": first_of}


def ranked_passages(ranked: DataFrame, at: list[str], text: str, words_: int = PASSAGE_WORDS) -> DataFrame:
    """Pieces of every stretch of ``words_`` words or more that stands earlier, which together cover it: ranks, level, start, end, kept."""
    source = ranked.select(*at, F.col(text).cast("string"))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for keys, data, offsets in portions(batches, len(at)):
            if (w := windows(data, offsets, words_)) is not None:
                yield w, keys, data, offsets

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, *_ in parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(w["name"].view(np.int64)), pa.array(w["digest"].view(np.int64))], ["h1", "h2"])

    groups = source.mapInArrow(names, "h1 bigint, h2 bigint").groupBy("h1").agg(F.min("h2").alias("a"), F.max("h2").alias("b"), F.count("*").alias("n"))
    sent = ranked.sparkSession.sparkContext.broadcast(marked(groups.where("n > 1"), F.col("a") != F.col("b")))

    def rows(places: bool) -> DataFrame:
        header = [*at, "h1", "h2", *(("start", "own", "end", "fresh") if places else ())]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for w, keys, data, offsets in parts(batches):
                u = pieces(w, words_, sent.value)
                columns = [*(pa.array(k[u["row"]]) for k in keys), pa.array(u["h1"]), pa.array(u["h2"])]
                if places:
                    columns += [*points(data, offsets, u["row"], u["start"], u["own"], u["end"]), pa.array(u["fresh"])]
                yield pa.RecordBatch.from_arrays(columns, header)

        return source.mapInArrow(run, typed(at, "h1 bigint, h2 bigint" + (", start int, own int, end int, fresh boolean" if places else "")))

    many = cut(rows(False).groupBy("h1", "h2").agg(F.min(place(at)).alias("kept"), F.count("*").alias("n")).where("n > 1"))
    later = place(at) > F.col("kept")
    gone = split_join(rows(True), many, ["h1", "h2"], [*at, "start"]).where(later | ~F.col("fresh"))
    return gone.select(*at, F.lit(PASSAGE).cast("tinyint").alias("level"), F.when(later, F.col("start")).otherwise(F.col("own")).alias("start"), "end", "kept")


def passages(docs: DataFrame, text: str = "text", key: str = "doc_id", words_: int = PASSAGE_WORDS) -> DataFrame:
    """Pieces of every stretch of ``words_`` words or more that stands earlier, which together cover it: doc_id, row, level, start, end,
    kept_doc_id."""
    ranked, at = places_of(bounded(docs), key)
    return named(ranked_passages(ranked, at, text, words_), at)


def ranked_everything(ranked: DataFrame, at: list[str], text: str, **limits: int) -> DataFrame:
    return named(ranked_repeats(ranked, at, text, **limits).unionByName(ranked_passages(ranked, at, text)), at)


def everything(docs: DataFrame, text: str = "text", key: str = "doc_id", **limits: int) -> DataFrame:
    """Units and pieces of passages to remove."""
    return ranked_everything(*places_of(bounded(docs), key), text, **limits)


def by_document(found: DataFrame) -> DataFrame:
    """One row per document that loses text: count of units (pieces of passages apart), the documents that keep what is removed, the
    removed spans merged, as start:end, and its row where rows share a doc_id."""
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    grouped = found.groupBy("doc_id", "row").agg(F.count_if(F.col("level") < PASSAGE).alias("n_units"), F.array_sort(F.collect_set("kept_doc_id")).alias("kept_doc_ids"), spans.alias("all"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    merged = F.aggregate(
        "all",
        none,
        lambda a, x: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["end"] >= x["start"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(a, F.array(x))),
    )
    kept = grouped.withColumn("removed", merged)
    return kept.select("doc_id", "n_units", F.aggregate("removed", F.lit(0), lambda a, x: a + x["end"] - x["start"]).cast("bigint").alias("removed_chars"), "kept_doc_ids", F.array_join(F.transform("removed", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("removed"), "row")


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", **limits: int) -> DataFrame:
    """The documents without the repeated units and passages; all columns stay, whatever their names."""
    packed = bounded(docs).select(F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("document"))
    packed = packed.select("document", F.col("document").getField(key).alias("doc_id"), F.col("document").getField(text).cast("string").alias("text"))
    ranked, at = places_of(packed, "doc_id")
    gone = by_document(ranked_everything(ranked, at, "text", **limits)).select(F.coalesce("doc_id", F.lit(LAST)).alias("_rank_doc"), F.coalesce("row", F.lit(0)).alias("_rank_row"), "removed")
    cut_at = F.transform(F.split("removed", ","), lambda x: F.split(x, ":").cast("array<int>"))
    left = F.aggregate(
        cut_at,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("text")),
        lambda a, x: F.struct(x[1].alias("at"), F.concat(a["text"], F.substring(F.col("text"), a["at"] + 1, x[0] - a["at"])).alias("text")),
        lambda a: F.concat(a["text"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))),
    )
    joined = ranked.join(gone, ["_rank_doc", "_rank_row"], "left")
    own = F.col("document")
    return joined.select(*(F.when(F.col("removed").isNotNull(), left).otherwise(own.getField(c)).alias(c) if c == text else own.getField(c).alias(c) for c in docs.columns))
