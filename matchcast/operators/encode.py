"""Features: vocabularies, one-hot and multi-hot vectors, population z-scores, centred PCA, ordered target statistics."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, CountVectorizerModel, OneHotEncoder, PCAModel, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from matchcast.operators.rows import distinct_values
from matchcast.shared import kept as written, remove

#: Rows of a run of the target statistics.
SPAN = 500_000
#: First rows that tell which columns may part all rows alike.
FIRST = 5000


def vocabulary(df: DataFrame, columns: list[str]) -> list[str]:
    """Sorted distinct values over columns or lists: what an encoder is fit on, and so held by the driver."""
    return [r["value"] for r in distinct_values(df, columns).orderBy("value").toLocalIterator()]


def one_hot(df: DataFrame, columns: list[str], unknown: str = "error") -> PipelineModel:
    """A fitted encoder per column, each with its own sorted vocabulary, to ``<column>_hot``.

    ``unknown``: "error", or "zeros" for a vector without a one."""
    keep = unknown == "zeros"
    index = StringIndexer(inputCols=columns, outputCols=[f"{c}_index" for c in columns], stringOrderType="alphabetAsc", handleInvalid="keep" if keep else "error")
    hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_hot" for c in columns], dropLast=keep)
    return Pipeline(stages=[index, hot]).fit(df)


def multi_hot(words: list[str], column: str, out: str) -> CountVectorizerModel:
    """Counts of the vocabulary's words in a list, as a sparse vector; other words are left out."""
    return CountVectorizerModel.from_vocabulary(words, inputCol=column, outputCol=out)


def multi_hot_rows(df: DataFrame, column: str, key: list[str]) -> DataFrame:
    """The same in long form: (key, token, n)."""
    return df.select(*key, F.explode(column).alias("token")).groupBy(*key, "token").agg(F.count("*").alias("n"))


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """Blocks of features side by side."""
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="keep").transform(df)


def z_score(df: DataFrame, column: str, out: str, fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population standard deviation, 0 where all are alike; the statistics are one row."""
    stats = (df if fit_on is None else fit_on).agg(F.avg(column).alias("_mean"), F.stddev_pop(column).alias("_std"))
    scaled = F.when(F.col("_std") == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(column) - F.col("_mean"), F.col("_std")))
    return df.crossJoin(F.broadcast(stats)).withColumn(out, scaled).drop("_mean", "_std")  # one row


def network_layout(df: DataFrame, day: str, teams: list[str], sides: list[str], map_: str, ranks: list[str], out: str = "features") -> tuple[DataFrame, list[int]]:
    """Day as a z-score, each team column by its own vocabulary, both line-ups by the players of the first side, the map, the ranks, as
    one vector; and the widths of these blocks. All is fit on ``df``; players that the first side never has are left out."""
    hot = one_hot(df, [*teams, map_], "zeros")
    words = vocabulary(df, sides[:1])
    rows = hot.transform(z_score(df, day, "_z"))
    for s in sides:
        rows = multi_hot(words, s, f"{s}_hot").transform(rows)
    blocks = ["_z", *(f"{t}_hot" for t in teams), *(f"{s}_hot" for s in sides), f"{map_}_hot", *ranks]
    sizes = [len(x) for x in hot.stages[0].labelsArray]
    widths = [1, *sizes[:-1], *([len(words)] * len(sides)), sizes[-1], *([1] * len(ranks))]
    extra = ["_z", *(f"{c}_{k}" for c in (*teams, map_) for k in ("index", "hot")), *(f"{s}_hot" for s in sides)]
    return assemble(rows, blocks, out).drop(*extra), widths


def boosted_layout(df: DataFrame, columns: list[str], lists: list[tuple[str, str]], k: int = 50, more: tuple[str, ...] = ()) -> DataFrame:
    """The columns, ``more`` of them or none, and for each pair of lists (line-ups, or heroes, of both sides) ``k`` coordinates of either
    side, as columns ``<list>_pca``. Vocabulary and components are fit on the first side and applied to both."""
    kept = [*columns, *more]
    for first, second in lists:
        words = vocabulary(df, [first])
        for side in (first, second):
            df = multi_hot(words, side, f"{side}_hot").transform(df)
        model = CentredPCA.fit(df, f"{first}_hot", k)
        for side in (first, second):
            df = model.transform(df, f"{side}_hot", f"{side}_pca").drop(f"{side}_hot")
            kept.append(f"{side}_pca")
    return df.select(*kept)


class CentredPCA:
    """PCA of centred data whose vectors stay sparse: projections minus the mean's projection. Signs make each component's greatest
    loading positive."""

    def __init__(self, model: PCAModel, mean: np.ndarray):
        components = model.pc.toArray()
        greatest = components[np.abs(components).argmax(0), np.arange(components.shape[1])]
        self.model, self.sign = model, np.where(greatest < 0, -1.0, 1.0)
        self.offset = (mean @ components) * self.sign
        self.components, self.explained = components * self.sign, np.asarray(model.explainedVariance.toArray())

    @classmethod
    def fit(cls, df: DataFrame, column: str, k: int = 50) -> CentredPCA:
        from pyspark.ml.stat import Summarizer

        mean = df.select(Summarizer.mean(F.col(column))).first()[0].toArray()
        return cls(PCA(k=min(k, len(mean)), inputCol=column, outputCol="_pca").fit(df), mean)

    def transform(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """Adds an array of coordinates."""
        projected = self.model.copy({self.model.inputCol: column, self.model.outputCol: "_pca"}).transform(df)
        sign, offset = F.array(*map(F.lit, self.sign.tolist())), F.array(*map(F.lit, self.offset.tolist()))
        moved = F.zip_with(F.zip_with(vector_to_array("_pca"), sign, lambda x, s: x * s), offset, lambda x, o: x - o)
        return projected.withColumn(out, moved).drop("_pca")


def key_of(column: str) -> Column:
    """A value as a key that nulls have too."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def alike(df: DataFrame, columns: list[str]) -> list[list[int]]:
    """Sets of columns, by their places in the list: those are together that part the first rows in the same way."""
    first = df.select(*(key_of(c) for c in columns)).limit(FIRST).collect()
    found: dict[tuple[int, ...], list[int]] = {}
    for i in range(len(columns)):
        place: dict[str, int] = {}
        found.setdefault(tuple(place.setdefault(r[i], len(place)) for r in first), []).append(i)
    return list(found.values())


def sums_by_run(df: DataFrame, columns: list[str], target: str, sets: list[list[int]], seq: str = "seq", view: Callable[[DataFrame], DataFrame] | None = None, span: int = SPAN) -> DataFrame:
    """(_g, _k, _b, _n, _s): count and sum of the target by set of columns, values of all its columns, and run."""
    rows = df.withColumn("_b", F.floor(F.col(seq) / span))
    every = F.explode(F.array(*(F.struct(F.lit(g).alias("_g"), F.array(*(key_of(columns[i]) for i in places)).alias("_k")) for g, places in enumerate(sets))))
    long = (view(rows) if view else rows).select("_b", F.col(target).cast("double").alias("_v"), every.alias("_m"))
    return long.groupBy(F.col("_m._g").alias("_g"), F.col("_m._k").alias("_k"), "_b").agg(F.count("_v").alias("_n"), F.sum("_v").alias("_s"))


def alike_sums(df: DataFrame, columns: list[str], target: str, seq: str = "seq", view: Callable[[DataFrame], DataFrame] | None = None, span: int = SPAN) -> tuple[list[list[int]], DataFrame, str]:
    """Sets of columns that part all rows alike, their ``sums_by_run``, and the folder these are kept in.

    What the first rows suggest is checked over all rows: a set stays if each of its columns has as many values as the set has, else its
    columns stand alone."""
    sets = alike(view(df) if view else df, columns)
    while True:
        sums, folder = written(sums_by_run(df, columns, target, sets, seq, view, span), "sums")
        values = sums.select("_g", "_k").distinct().select("_g", F.posexplode("_k").alias("_p", "value"))
        counts = values.groupBy("_g", "_p").agg(F.count("*").alias("all"), F.count_distinct("value").alias("own")).collect()
        apart = {r["_g"] for r in counts if r["all"] != r["own"]}
        if not apart:
            return sets, sums, folder
        remove(df.sparkSession, folder)
        sets = [part for g, places in enumerate(sets) for part in ([[i] for i in places] if g in apart else [places])]


def target_statistics(
    df: DataFrame,
    columns: str | list[str],
    target: str,
    out: str | list[str],
    prior: float = 0.5,
    weight: float = 1.0,
    seq: str = "seq",
    view: Callable[[DataFrame], DataFrame] | None = None,
    kept: list[str] | None = None,
    span: int = SPAN,
    sums: tuple[list[list[int]], DataFrame] | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """(sum of the target over the value's earlier rows + weight prior) / (their count + weight): no row sees its own target.

    Rows are exchanged once, as they are: in runs of ``span`` numbers, each headed by what the values in it have from earlier runs, and read
    in order. ``view`` adds the columns, the target too if it lacks, after that exchange, where they follow from fewer; ``kept`` are the
    columns that go along, all if None. Rows without a number go; null targets add nothing.

    ``sums``: sets of columns that part the rows alike and their sums, from ``alike_sums``; a set has one statistic, and ``keep`` keeps rows
    that have it once. Else each column is a set of its own."""
    columns, outs = ([columns], [out]) if isinstance(columns, str) else (columns, out)
    view = view or (lambda d: d)
    names = view(df).columns if kept is None else kept
    sets, own = sums or ([[i] for i in range(len(columns))], None)
    numbered = df.where(F.col(seq).isNotNull())
    rows = numbered.withColumn("_b", F.floor(F.col(seq) / span))
    value = F.col(target).cast("double")
    own = (sums_by_run(numbered, columns, target, sets, seq, view, span) if own is None else own.where("_b is not null")).select("_b", "_g", F.get("_k", F.lit(0)).alias("_k"), "_n", "_s")
    earlier = Window.partitionBy("_g", "_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    heads = own.select("_b", F.col("_g").alias("_c"), "_k", F.sum("_n").over(earlier).alias("_n"), F.coalesce(F.sum("_s").over(earlier), F.lit(0.0)).alias("_s")).where("_n > 0")
    both = rows.unionByName(heads, allowMissingColumns=True)
    runs = both.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_b").sortWithinPartitions("_b", F.asc_nulls_last("_c"), seq)
    wide = view(runs)
    keys, found = [f"_k{g}" for g in range(len(sets))], [f"_t{g}" for g in range(len(sets))]
    given = wide.select(*names, "_b", "_c", "_k", "_n", "_s", value.alias("_v"), *(key_of(columns[places[0]]).alias(k) for places, k in zip(sets, keys, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state = None, []
        for batch in batches:
            b = batch.column("_b").to_numpy()
            edges = [0, *(np.flatnonzero(b[1:] != b[:-1]) + 1).tolist(), len(b)] if len(b) else []
            for low, high in pairwise(edges):
                if b[low] != block:
                    block, state = b[low], [Earlier(prior * weight, weight) for _ in keys]
                part = batch.slice(low, high - low)
                m = high - low - part.column("_c").null_count  # heads come first
                head = part.slice(0, m)
                for c, k, n, s in zip(*(head.column(x).to_pylist() for x in ("_c", "_k", "_n", "_s")), strict=True):
                    state[c].begin(k, n, s)
                part = part.slice(m)
                if part.num_rows:
                    v = part.column("_v").to_pylist()
                    read = [e.read(part.column(k), v) for e, k in zip(state, keys, strict=True)]
                    yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), *read], [*names, *found])

    schema = StructType([*wide.select(*names).schema.fields, *(StructField(f, DoubleType()) for f in found)])
    of = {i: f for places, f in zip(sets, found, strict=True) for i in places}
    return keep(given.mapInArrow(run, schema)).select(*names, *(F.col(of[i]).alias(o) for i, o in enumerate(outs)))


class Earlier:
    """Count and sum of the target by value, of the rows read so far."""

    def __init__(self, add: float, weight: float):
        self.add, self.weight = add, weight
        self.place: dict[str, int] = {}
        self.n: list[int] = []
        self.s: list[float] = []

    def begin(self, key: str, n: int, s: float) -> int:
        self.n.append(n)
        self.s.append(s)
        return self.place.setdefault(key, len(self.place))

    def read(self, keys: pa.Array, values: list[float | None]) -> pa.Array:
        """The statistic of each row, before its own value is added."""
        coded = keys.dictionary_encode()
        at = [self.place[k] if k in self.place else self.begin(k, 0, 0.0) for k in coded.dictionary.to_pylist()]
        n, s, add, weight, found = self.n, self.s, self.add, self.weight, []
        for code, v in zip(coded.indices.to_pylist(), values, strict=True):
            k = at[code]
            found.append((s[k] + add) / (n[k] + weight) if n[k] + weight else None)
            if v is not None:
                n[k] += 1
                s[k] += v
        return pa.array(found, pa.float64())


def full_statistics(sets: list[list[int]], sums: DataFrame, prior: float = 0.5, weight: float = 1.0) -> DataFrame:
    """(column, value, statistic) over all rows, columns by their place in the list, from ``alike_sums``: for new rows."""
    total = sums.groupBy("_g", "_k").agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    rows = total.select("_g", "_n", "_s", F.posexplode("_k").alias("_p", "value"))
    column = F.get(F.get(F.array(*(F.array(*map(F.lit, places)) for places in sets)), F.col("_g")), F.col("_p"))
    return rows.groupBy(column.alias("column"), "value").agg(((F.sum("_s") + weight * prior) / (F.sum("_n") + weight)).alias("statistic"))


def known_statistics(df: DataFrame, statistics: DataFrame, columns: list[str], outs: list[str], prior: float, small: Collection[int]) -> DataFrame:
    """Adds what ``full_statistics`` has for each column's value, and the prior for values that are new. ``small``: the places of columns
    whose values may be sent to every executor."""
    for i, (c, out) in enumerate(zip(columns, outs, strict=True)):
        own = statistics.where(F.col("column") == i).select(F.col("value").alias("_value"), F.col("statistic").alias(out))
        df = df.join(F.broadcast(own) if i in small else own, key_of(c) == own["_value"], "left").drop("_value").fillna({out: prior})
    return df


def entries(vector: str | Column) -> Column:
    """A vector's stored entries as an array of structs (at, x), by place from 0: as many as it has, not as it is wide. A dense vector
    stores all."""
    v = F.unwrap_udt(vector)
    sparse = F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.alias("at"), x.alias("x")))
    return F.coalesce(sparse, F.transform(v["values"], lambda x, i: F.struct(i.alias("at"), x.alias("x"))))


def width(vector: str | Column) -> Column:
    """The places of a vector, of which it need not store all."""
    v = F.unwrap_udt(vector)
    return F.coalesce(v["size"], F.size(v["values"])).cast("bigint")


def to_vector(xs: Column) -> Column:
    """An array of doubles as a vector."""
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(xs)


__all__ = ["CentredPCA", "VectorUDT", "Vectors", "alike_sums", "assemble", "boosted_layout", "entries", "full_statistics", "key_of", "known_statistics", "multi_hot", "multi_hot_rows", "network_layout", "one_hot", "target_statistics", "to_vector", "vocabulary", "width", "z_score"]
