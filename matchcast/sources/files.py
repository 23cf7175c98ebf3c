"""CSV tables: explicit schemas, a list of null tokens, and writes that replace a table only once they are complete."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from matchcast.shared import fresh_dir as scratch, remove

#: Tokens that some readers take for missing. Off by default: a name may be one of them.
NULL_TOKENS = ("", "NA", "N/A", "NaN", "nan", "null", "None", "<NA>")


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, null_tokens: tuple[str, ...] = (), separator: str = ",") -> DataFrame:
    """Rows of CSV files with a header. Types come from the schema alone, so that a time of day stays text."""
    df = spark.read.schema(schema).option("header", True).option("sep", separator).option("enforceSchema", False).csv(path)
    if not null_tokens:
        return df
    text = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*(F.when(~F.col(c).isin(*null_tokens), F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns))


def write_csv(df: DataFrame, path: str, index: bool = False) -> str:
    """Writes beside ``path`` and then puts the new files in place, so a table can replace what it was read from.

    Lists are written as their text. With ``index``, a first column ``seq`` numbers the rows from 0 in their order by all columns."""
    spark = df.sparkSession
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            df = df.withColumn(f.name, F.concat(F.lit("["), F.array_join(F.transform(f.name, lambda x: F.concat(F.lit("'"), x.cast("string"), F.lit("'"))), ", "), F.lit("]")))
    if index:
        from matchcast.operators.ordering import with_seq

        names = df.columns
        df = with_seq(df, names).select((F.col("seq") - 1).alias("seq"), *names)
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.option("header", True).csv(beside)
    swap(spark, beside, path)
    return path


def _at(spark: SparkSession, *paths: str):
    """The file system of the first path, and all paths."""
    found = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return found[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), *found


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder to a name that is free."""
    fs, a, b = _at(spark, source, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"could not put {source} in place of {target}")


def swap(spark: SparkSession, beside: str, path: str) -> None:
    """Puts a complete folder in place of ``path``. The old one stays aside until then, from where ``settle`` takes it back."""
    path = path.rstrip("/")
    settle(spark, path)
    old = f"{path}.old"
    if exists(spark, path):
        move(spark, path, old)
    try:
        move(spark, beside, path)
    except Exception:
        settle(spark, path)
        raise
    remove(spark, old)


def settle(spark: SparkSession, path: str) -> None:
    """Ends a swap that was broken off: the old folder comes back where the new one is not in place."""
    old = f"{path.rstrip('/')}.old"
    if exists(spark, old):
        if exists(spark, path):
            remove(spark, old)
        else:
            move(spark, old, path)


__all__ = ["NULL_TOKENS", "exists", "move", "read_csv", "scratch", "settle", "swap", "write_csv"]
