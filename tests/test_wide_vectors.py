import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from matchcast import queries
from matchcast.operators import encode
from tests.oracle import connect, normal


def test_entries_of_sparse_and_dense(spark):
    df = spark.createDataFrame([(Vectors.sparse(50_000_000, [3, 49_999_999], [1.0, 2.5]),), (Vectors.dense([0.0, 4.0]),), (Vectors.sparse(3, [], []),)], StructType([StructField("v", VectorUDT())]))
    got = df.select(encode.entries("v").alias("e"), encode.width("v").alias("w")).collect()
    assert [([(e["at"], e["x"]) for e in r.e], r.w) for r in got] == [([(3, 1.0), (49_999_999, 2.5)], 50_000_000), ([(0, 0.0), (1, 4.0)], 2), ([], 3)]


@pytest.mark.parametrize("name", ["q41_one_hot", "q57_network_layout"])
def test_vectors_are_not_made_dense(spark, sf, monkeypatch, name):
    """Equal to SQL without an array of all places for any row."""
    monkeypatch.setattr("pyspark.ml.functions.vector_to_array", lambda *_: pytest.fail("dense"))
    monkeypatch.setattr("matchcast.queries_layouts.vector_to_array", lambda *_: pytest.fail("dense"))
    got = queries.queries()[name](spark, sf)
    assert normal(got.toPandas()) == normal(connect(sf).execute(queries.oracle_sql()[name]).fetchdf())
