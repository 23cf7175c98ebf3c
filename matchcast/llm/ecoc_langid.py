"""Language identification by error-correcting output codes over byte n-grams.

Counts of n-grams per language come from all training rows, in one pass and one aggregation. Each bit of the code splits the
languages in two; its binary classifier is linear in the n-grams, with the log ratio of their mean frequencies on both sides as
weights. A text's margins, one per bit, are decoded to the codeword of least loss, each bit weighted by how far it keeps its sides
apart in training; a text whose two best codewords are close is flagged.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; repeated rows get equal results; texts of any length
are read whole; of equal losses the first language by name wins; with no training rows every text is ``und``; with one language every text with a letter has it, with score 1; other
columns are ignored; an empty table gives an empty table of the same schema.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchcast.shared import bounded
from matchcast.llm.vec import chunks, utf8

#: Hashed n-grams of three bytes; most languages for which every split is a bit; smoothing; scale of margins; least lead.
BITS, EXHAUSTIVE, SMOOTH, SCALE, LEAD = 16, 7, 0.5, 24.0, 0.2
#: Letters in lower case; all else is a space.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram at each byte, and the row of each. Rows are edged by spaces; n-grams of white space alone are left out."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    edged = np.full(len(data) + 2 * n, 0x20, np.uint8)
    starts = offsets[:-1] + 2 * np.arange(n) + 1
    edged[np.repeat(starts - offsets[:-1], sizes) + np.arange(len(data))] = FOLD[data]
    a = edged.astype(np.uint32)
    h = (a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA77)) ^ (a[2:] * np.uint32(0xC2B2AE3D))
    h = (h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)
    good = edged[1:-1] != 0x20  # the middle one
    at = np.flatnonzero(good)
    return h[at], np.searchsorted(starts + sizes, at + 1, "right")


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            names = batch.column(1).to_pylist()
            for a, b in chunks(offsets, 1 << 19):
                h, row = grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                own = sorted(set(names[a:b]))
                code = np.array([own.index(x) for x in names[a:b]])
                found = np.bincount(code[row] << BITS | h, minlength=len(own) << BITS).reshape(len(own), -1)
                for k, name in enumerate(own):
                    total[name] = total.get(name, 0) + found[k]
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["lang", "gram", "n"])

    rows = bounded(docs).select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l")).where("t is not null and l is not null")
    return rows.mapInArrow(run, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """+1 and -1 by class and bit: every split in two for few classes, else the best of random dense codes."""
    if n <= EXHAUSTIVE:
        rest = list(itertools.product((1, -1), repeat=max(n - 1, 0)))[1:]
        return np.array([[1] * len(rest), *zip(*rest, strict=True)], np.int8) if rest else np.ones((n, 0), np.int8)
    random, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = random.choice(np.array([-1, 1], np.int8), (n, int(np.ceil(15 * np.log2(n)))))
        code = code[:, np.abs(code.sum(0)) < n]
        far = code.shape[1] - int((code.astype(int) @ code.T.astype(int) - 2 * code.shape[1] * np.eye(n, dtype=int)).max())
        if far > apart:
            best, apart = code, far
    return best


class Model:
    def __init__(self, langs: list[str], table: np.ndarray):
        """``table``: counts by language and n-gram."""
        self.langs, self.code = langs, codewords(len(langs))
        share = (table + SMOOTH) / (table + SMOOTH).sum(1, keepdims=True)
        weights, trust = [], []
        for bit in self.code.T:
            w = np.log(share[bit > 0].mean(0)) - np.log(share[bit < 0].mean(0))
            margin = share @ w  # expected, by language
            weights.append(w)
            trust.append(max(1e-3, (margin * bit).min()))
        self.weights = np.array(weights, np.float32).reshape(len(weights), 1 << BITS).T.copy()
        self.trust = np.array(trust) / np.mean(trust) if trust else np.zeros(0)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, score and lead over the next class, from mean margins by bit."""
        if len(self.langs) == 1:
            n = len(margins)
            return np.zeros(n, int), np.ones(n), np.ones(n)
        z = np.clip(margins * SCALE, -30, 30)
        loss = np.stack([(np.log1p(np.exp(-z * word)) * self.trust).sum(1) for word in self.code], 1)
        chance = np.exp(loss.min(1, keepdims=True) - loss)
        chance /= chance.sum(1, keepdims=True)
        two = np.sort(chance, 1)
        return loss.argmin(1), two[:, -1], two[:, -1] - two[:, -2]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """From all given rows. What comes to the driver has at most 2 ** BITS rows a language."""
    found = counts(docs, text, lang).toArrow()
    langs = sorted(set(found["lang"].to_pylist())) if found.num_rows else []
    table = np.zeros((len(langs), 1 << BITS))
    if langs:
        names = found["lang"].combine_chunks().dictionary_encode()
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        order = np.array([langs.index(x) for x in names.dictionary.to_pylist()])
        table[order[names.indices.to_numpy()], found["gram"].to_numpy()] = found["n"].to_numpy()
    return Model(langs, table)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns, lang_pred, score and ambiguous of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*model.langs, "und"], pa.string())
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            data, offsets = utf8(column)
            for a, b in chunks(offsets, 1 << 18):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                n = b - a
                best, score, lead = np.full(n, len(model.langs)), np.zeros(n), np.zeros(n)
                h, row = grams(part, own)
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
                if len(first) and model.langs:
                    sums = np.add.reduceat(model.weights[h], first, axis=0).astype(np.float64)
                    rows = row[first]
                    margins = sums / np.diff(np.r_[first, len(row)])[:, None]
                    best[rows], score[rows], lead[rows] = model.decode(margins)
                    ascii_letter = np.add.reduceat((part >= 0x41) & (FOLD[part] < 0x7B) & (FOLD[part] > 0x60), np.minimum(own[:-1], max(len(part) - 1, 0))) > 0
                    for r in rows[~ascii_letter[rows]].tolist():
                        if not has_letter(part[own[r] : own[r + 1]].tobytes()):
                            best[r], score[r], lead[r] = len(model.langs), 0, 0
                picked = batch.slice(a, n)
                yield pa.RecordBatch.from_arrays([*picked.columns[:-1], names.take(pa.array(best)), pa.array(score), pa.array((lead < LEAD) & (best < len(model.langs)))], [*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"])

    chosen = bounded(docs).select(*keep, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]) + ", lang_pred string, score double, ambiguous boolean"
    return chosen.mapInArrow(run, schema)
