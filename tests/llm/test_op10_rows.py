from matchcast.llm import sigtree_join as op
from tests.llm.cases import SCHEMA


def test_rows_of_one_doc_id_are_judged_by_their_text(spark):
    one, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(1, one), (2, one), (2, other), (2, other), (3, None), (None, one)]
    df = spark.createDataFrame([(k, t, None, None, None, "x") for k, t in rows], SCHEMA)
    left = op.keep_one(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(1, one), (2, other), (3, None), (None, one)], key=str)
