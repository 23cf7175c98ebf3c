"""Quality classifier: Naive Bayes support vectors over byte n-gram indicators.

The class counts of the indicators come from all labelled training rows, in one aggregation; their log-count ratios scale the
indicators. A linear hinge-loss model on the scaled indicators is fit by dual coordinate descent on ``SAMPLE`` labelled rows at
most, those of the least hash of key and text, repeated rows once. Only these go to the one task that fits, which takes them in the
order of that hash, so the model does not depend on how the table is laid out. Its margins are turned into chances by a logistic curve
fit on a part of that sample which the model itself has not seen.

Defined cases: null and empty texts have no indicators and get the model's score for that; repeated rows get equal results; of several
labels of one key the lowest counts; rows without label do not train; texts of any length are read whole; with training rows of one
class only, or none, every score is that class's share (0.5 with none); a score equal to a limit passes it (``select``, and the query's
``predicted`` at 0.3); other columns are ignored; an empty table gives an empty table of the same schema.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchcast.shared import BROADCAST_BYTES, bounded
from matchcast.llm.vec import SPACE, chunks, span_hashes, utf8, words

#: Hashed n-grams of three bytes; most rows that the hinge-loss model is fit on; smoothing of counts; cost of errors; passes;
#: weight of the fitted against the mean weight; share of the sample for the logistic curve.
BITS, SAMPLE, SMOOTH, COST, PASSES, BETA, CURVE = 16, 6000, 1.0, 1.0, 12, 0.5, 0.25
#: Lengths of the word n-grams that repeat one word.
AGAIN = (2, 3, 4, 6)


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each row, ascending by row, and their rows: hashed n-grams of bytes, and, in the first places, those
    of words in an alphabet that only says whether a word is the one before again, for each length in ``AGAIN``."""
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = data.astype(np.uint32)
    h = (a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA77)) ^ (a[2:] * np.uint32(0xC2B2AE3D))
    h = ((h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)).astype(np.int64)
    h[h < len(AGAIN)] = len(AGAIN)
    row = np.repeat(np.arange(n), np.diff(offsets))
    inside = row[2:] == row[:-2]
    seen = np.zeros(n << BITS, bool)
    seen[(row[:-2] << BITS | h)[inside]] = True
    starts, ends, of = words(data, offsets, ~SPACE)
    if len(starts) > 1:
        own = span_hashes(data, starts, ends)
        same = np.r_[False, (own[1:] == own[:-1]) & (of[1:] == of[:-1])]
        for k, length in enumerate(AGAIN):
            run = same.copy()
            for j in range(1, length - 1):
                run[j:] &= same[:-j]
                run[:j] = False
            seen[of[run] << BITS | k] = True
    at = np.flatnonzero(seen)
    return at & ((1 << BITS) - 1), at >> BITS


def parts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows for ``indicators``: of bounded bytes and of 64 rows at most."""
    for a, b in chunks(offsets, 1 << 18):
        for s in range(a, b, 64):
            yield s, min(s + 64, b)


def class_counts(rows: DataFrame) -> DataFrame:
    """(y, gram, n) of rows (y, text); gram -1 counts the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, (1 << BITS) + 1), np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = utf8(batch.column(1))
            total[:, -1] += np.bincount(y, minlength=2)
            for a, b in parts(offsets):
                h, row = indicators(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                k = y[a:b][row]
                for c in (0, 1):
                    total[c, :-1] += np.bincount(h[k == c], minlength=1 << BITS)
        for c in (0, 1):
            at = np.flatnonzero(total[c])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), c, np.int32)), pa.array(np.where(at == 1 << BITS, -1, at).astype(np.int32)), pa.array(total[c, at])], ["y", "gram", "n"])

    return rows.select(F.col("y").cast("int"), "text").mapInArrow(run, "y int, gram int, n bigint").groupBy("y", "gram").agg(F.sum("n").alias("n"))


def dual_descent(xs: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = COST, passes: int = PASSES, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights of the scaled indicators and bias of an L1-loss support vector machine; rows are scaled to length one."""
    w, bias = np.zeros(len(ratio)), 0.0
    values = [ratio[x] for x in xs]
    values = [v / max(np.sqrt(v @ v), 1e-12) for v in values]
    alpha, random = np.zeros(len(xs)), np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in random.permutation(len(xs)):
            x, v = xs[i], values[i]
            gradient = y[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / (v @ v + 1), 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[x] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the chance of label 1, by Newton's method on smoothed targets."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    theta, x = np.array([1.0, 0.0]), np.stack([margin, np.ones(len(margin))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (p - t) + 1e-6 * theta
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-6 * np.eye(2), slope)
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


class Model:
    """``ratio`` scales the indicators, ``weights`` are for the scaled ones."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.ratio, self.weights, self.bias, self.slope, self.offset = ratio, weights, bias, slope, offset
        self.product, self.square = ratio * weights, ratio * ratio

    def margins(self, h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        length = np.sqrt(np.bincount(row, self.square[h], n))
        return np.bincount(row, self.product[h], n) / np.maximum(length, 1e-12) + self.bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        h, row = indicators(data, offsets)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(h, row, len(offsets) - 1) + self.offset, -30, 30)))


def joined(docs: DataFrame, labels: DataFrame, text: str, key: str) -> DataFrame:
    """(_key, y, text) of labelled rows. Labels are sent to all executors only where their count shows that they are small."""
    small = labels.count() * 16 <= BROADCAST_BYTES
    return bounded(docs).select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text")).join(F.broadcast(labels) if small else labels, "_key").select("_key", "y", "text")


def chosen(rows: DataFrame, sample: int) -> DataFrame:
    """(y, text) of the ``sample`` rows of (_key, y, text) with the least hash of key and text, in one partition and in that order.

    The limit comes from the hashes alone; rows beyond it stay where they are, and repeated rows become one in each task."""
    hashed = rows.withColumn("_h", F.xxhash64("_key", "text"))
    last = hashed.groupBy("_h").agg(F.first("y").alias("y")).orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    own = hashed.where(F.col("_h") <= F.lit(last)) if last is not None else hashed.limit(0)
    return own.groupBy("_h").agg(F.min("y").alias("y"), F.min("text").alias("text")).repartition(1).sortWithinPartitions("_h").select(F.col("y").cast("int"), "text")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model:
    """``labels`` has the training rows only: key and label 0 or 1."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("y"))
    rows_ = joined(docs, usable, text, key)
    found = class_counts(rows_.select("y", "text")).toArrow().to_pandas()
    table, rows = np.zeros((2, 1 << BITS)), np.zeros(2)
    for c in (0, 1):
        own = found[found.y == c]
        rows[c] = own.n[own.gram < 0].sum()
        table[c, own.gram[own.gram >= 0]] = own.n[own.gram >= 0]
    none = np.zeros(1 << BITS)
    if not rows.all():
        share = rows[1] / rows.sum() if rows.sum() else 0.5
        return Model(none, none, 0.0, 1.0, float(np.clip(np.log(max(share, 1e-9)) - np.log(max(1 - share, 1e-9)), -30, 30)))
    smooth = table + SMOOTH
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs: list[np.ndarray] = []
        ys: list[int] = []
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ys += batch.column(0).to_pylist()
            for a, b in parts(offsets):
                h, row = indicators(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                xs += np.split(h, np.searchsorted(row, np.arange(1, b - a)))
        y = np.where(np.array(ys) > 0, 1, -1)
        order = np.random.default_rng(3).permutation(len(y))
        cut = int(len(y) * CURVE)
        held, own = order[:cut], order[cut:]
        w, bias = dual_descent([xs[i] for i in own], ratio, y[own])
        blended = (1 - BETA) * np.abs(w).mean() + BETA * w
        blend_bias = BETA * bias
        raw = Model(ratio, blended, blend_bias, 1.0, 0.0)
        margin = np.array([raw.margins(xs[i], np.zeros(len(xs[i]), np.int64), 1)[0] for i in (held if len(set(y[held])) == 2 else order)])
        slope, offset = logistic(margin, y[held] if len(set(y[held])) == 2 else y[order])
        yield pa.RecordBatch.from_arrays([pa.array([blended.astype("<f8").tobytes()]), pa.array([float(blend_bias)]), pa.array([slope]), pa.array([offset])], ["w", "bias", "slope", "offset"])

    got = chosen(rows_, sample).mapInArrow(train, "w binary, bias double, slope double, offset double").first()
    return Model(ratio, np.frombuffer(got["w"], "<f8"), got["bias"], got["slope"], got["offset"])


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            found = [own.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in parts(offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(found) if found else np.zeros(0))], [*batch.schema.names[:-1], "score"])

    chosen = bounded(docs).select(*keep, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]) + ", score double"
    return chosen.mapInArrow(run, schema)


def select(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The documents that score ``least`` or more; all columns stay."""
    sent, column = bounded(docs).sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            data, offsets = utf8(batch.column(column))
            good = [own.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) >= least for a, b in parts(offsets)]
            yield batch.filter(pa.array(np.concatenate(good) if good else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)
