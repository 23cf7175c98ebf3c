"""A residual network for scores: trained by minibatches on one bounded sample, applied to all rows in Arrow batches.

Every layer is two linear maps: the first, of the layer's inputs, is rectified and normalised without scale and shift; the second, of the
layer's own width, is rectified and, in training alone, thinned by dropout. Some places add what came out two places before. A layer
may stand at two places, with the same weights and the same running statistics. Loss: Huber; steps: AdamW, with a rate that falls by a
factor each pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: The layers as the data pass them, and the place whose output each adds, or None.
PASS = (
    ("1000_1", None), ("500_1", None), ("100_1", None), ("100_2", None), ("100_3", 2), ("100_2", 3), ("100_5", 4),
    ("50_1", None), ("50_2", None), ("50_3", 7), ("50_2", 8), ("50_3", 9),
)
#: Most rows that are trained on.
SAMPLE = 200_000


def layers(inputs: int, scale: float = 1.0, order: tuple[tuple[str, int | None], ...] = PASS) -> list[tuple[str, int, int, int | None]]:
    """(name, inputs, outputs, place added) of every place in the pass. ``scale`` makes all widths smaller."""
    out, now = [], inputs
    for name, added in order:
        width = max(2, int(int(name.split("_")[0]) * scale))
        out.append((name, now, width, added))
        now = width
    return out


@dataclass
class Network:
    inputs: int
    scale: float = 1.0
    dropout: float = 0.3
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    running: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self):
        random = np.random.default_rng(self.seed)
        self.places = layers(self.inputs, self.scale)
        maps = [(f"{name}.{i}", n, b) for name, a, b, _ in self.places for i, n in ((1, a), (2, b))]
        for name, a, b in [*maps, ("out", self.places[-1][2], 1)]:
            if f"{name}.w" not in self.weights:
                self.weights[f"{name}.w"] = random.uniform(-1, 1, (a, b)) / np.sqrt(a)
                self.weights[f"{name}.b"] = random.uniform(-1, 1, b) / np.sqrt(a)

    def forward(self, x: np.ndarray, random: np.random.Generator | None = None) -> tuple[np.ndarray, list]:
        """Predictions and what backward needs; ``random`` is given in training."""
        kept, outputs = [], []
        for name, _, b, added in self.places:
            z = x @ self.weights[f"{name}.1.w"] + self.weights[f"{name}.1.b"]
            r = np.maximum(z, 0)
            old = self.running.get(name, (np.zeros(b), np.ones(b)))
            if random is not None:
                mean, var = r.mean(0), r.var(0)
                self.running[name] = (0.9 * old[0] + 0.1 * mean, 0.9 * old[1] + 0.1 * var * len(r) / max(len(r) - 1, 1))
            else:
                mean, var = old
            inverse = 1 / np.sqrt(var + 1e-5)
            normal = (r - mean) * inverse
            second = normal @ self.weights[f"{name}.2.w"] + self.weights[f"{name}.2.b"]
            mask = np.ones_like(second) if random is None else (random.random(second.shape) >= self.dropout) / (1 - self.dropout)
            kept.append((x, z, normal, inverse, second, mask))
            x = np.maximum(second, 0) * mask
            if added is not None:
                x = x + outputs[added]
            outputs.append(x)
        return (x @ self.weights["out.w"] + self.weights["out.b"])[:, 0], [*kept, x]

    def backward(self, kept: list, slope: np.ndarray) -> dict[str, np.ndarray]:
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        grads["out.w"] += kept[-1].T @ slope[:, None]
        grads["out.b"] += slope.sum(keepdims=True)
        back = [0.0] * len(self.places)  # by the place whose output it is
        back[-1] = slope[:, None] @ self.weights["out.w"].T
        for i in range(len(self.places) - 1, -1, -1):
            name, _, _, added = self.places[i]
            x, z, normal, inverse, second, mask = kept[i]
            if added is not None:
                back[added] = back[added] + back[i]
            d = back[i] * mask * (second > 0)
            grads[f"{name}.2.w"] += normal.T @ d
            grads[f"{name}.2.b"] += d.sum(0)
            d = d @ self.weights[f"{name}.2.w"].T
            d = inverse * (d - d.mean(0) - normal * (d * normal).mean(0)) * (z > 0)
            grads[f"{name}.1.w"] += x.T @ d
            grads[f"{name}.1.b"] += d.sum(0)
            if i:
                back[i - 1] = back[i - 1] + d @ self.weights[f"{name}.1.w"].T
        return grads

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 1000, rate: float = 1e-3, decay: float = 0.9, shrink: float = 0.01) -> list[float]:
        """Mean Huber loss of each pass."""
        random, step, losses = np.random.default_rng(self.seed), 0, []
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for _ in range(epochs):
            order, total = random.permutation(len(x)), []
            for s in range(0, len(x), batch):
                own = order[s : s + batch]
                if len(own) < 2:
                    continue
                p, kept = self.forward(x[own], random)
                e = p - y[own]
                total.append(np.where(np.abs(e) <= 1, 0.5 * e * e, np.abs(e) - 0.5).mean())
                grads = self.backward(kept, np.clip(e, -1, 1) / len(own))
                step += 1
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.weights[k] *= 1 - rate * shrink
                    self.weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
            rate *= decay
            losses.append(float(np.mean(total)) if total else 0.0)
        return losses


def fit(df: DataFrame, features: str, target: str, key: list[str], scale: float = 1.0, epochs: int = 10, sample: int = SAMPLE, seed: int = 7, **options) -> Network:
    """Of an array column and a target. At most ``sample`` rows, those of the least hash of their key, are trained on."""
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(target).cast("double").alias("y"), F.xxhash64(F.lit(seed), *key).alias("h"), *key)
    table = rows.where("x is not null and y is not null").orderBy("h", *key).limit(sample).select("x", "y").toArrow()
    y = table["y"].to_numpy()
    x = np.array(table["x"].to_pylist(), float).reshape(len(y), -1)
    net = Network(x.shape[1], scale, seed=seed)
    net.train(x, y, epochs, **options)
    return net


def predict(df: DataFrame, net: Network, features: str, keep: list[str], out: str = "p") -> DataFrame:
    """Kept columns and the prediction; null where there are no features. Repeated rows get equal results."""
    sent = df.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = batch.column(batch.num_columns - 1).to_pylist()
            good = [i for i, x in enumerate(xs) if x is not None]
            p = np.full(len(xs), np.nan)
            if good:
                p[good] = sent.value.forward(np.array([xs[i] for i in good], float))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p, mask=np.isnan(p))], [*batch.schema.names[:-1], out])

    chosen = df.select(*keep, F.col(features).cast("array<double>").alias("_x"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]) + f", `{out}` double"
    return chosen.mapInArrow(run, schema)


def save(net: Network, spark: SparkSession, path: str) -> None:
    """Weights and running statistics, a row each."""
    every = {**{f"weights/{k}": v for k, v in net.weights.items()}, **{f"running/{k}/{i}": v for k, x in net.running.items() for i, v in enumerate(x)}}
    rows = [(k, list(v.shape), bytearray(np.ascontiguousarray(v, "<f8").tobytes()), net.inputs, net.scale, net.dropout, net.seed) for k, v in every.items()]
    spark.createDataFrame(rows, "name string, shape array<int>, value binary, inputs int, scale double, dropout double, seed int").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Network:
    rows = spark.read.parquet(path).collect()  # a row per layer's array
    arrays = {r["name"]: np.frombuffer(bytes(r["value"]), "<f8").reshape(r["shape"]).copy() for r in rows}
    running = {k.split("/")[1]: (v, arrays[f"{k[:-1]}1"]) for k, v in arrays.items() if k.startswith("running/") and k.endswith("/0")}
    return Network(rows[0]["inputs"], rows[0]["scale"], rows[0]["dropout"], rows[0]["seed"], {k[len("weights/") :]: v for k, v in arrays.items() if k.startswith("weights/")}, running)
