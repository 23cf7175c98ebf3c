"""Rows that share a doc_id, have none, or are repeated: each is ranked and cut on its own."""

from matchcast.llm import unit_dedup as op
from tests.llm.cases import ROWS, SCHEMA, SHARED
from tests.llm.test_op5_passages import brute as passages
from tests.llm.test_op5_units import brute as units


def without(text, gone):
    return None if text is None else "".join(c for i, c in enumerate(text) if i not in gone)


def expected(rows):
    """Texts left, in the order of the rows, which is their rank within a doc_id."""
    rank = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    ranked = [(k, rows[i][1]) for k, i in enumerate(rank)]
    gone = {k: set().union(*(range(a, b) for a, b, _ in v)) for k, v in units(ranked).items()}
    for k, v in passages(ranked).items():
        text, found = ranked[k][1], v | gone.get(k, set())
        gone[k] = found | {i for i in range(len(text)) if text[i].isspace() and {i - 1, i + 1} <= found}
    return [without(rows[i][1], gone.get(rank.index(i), set())) for i in range(len(rows))]


def left(spark, rows):
    """Texts by the row's number, which a column named as one of the operator's own carries."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_rank_row int, {SCHEMA}")
    got = op.deduplicate(df)
    assert got.columns == df.columns
    return [r.text for r in sorted(got.collect(), key=lambda r: r._rank_row)]


def test_rows_of_one_doc_id(spark):
    want = expected(SHARED)
    assert left(spark, SHARED) == want
    assert want[1] == SHARED[1][1] and want[2] == "\nthis one is another text" and want[3] == "" and want[8] == SHARED[8][1]


def test_all_cases(spark):
    assert left(spark, ROWS) == expected(ROWS)


def test_columns_named_as_the_operators(spark):
    df = spark.createDataFrame([(1, "one two three four five six", 1, 2, "r", 3), (2, "one two three four five six", 1, 2, "r", 3)], "doc_id bigint, text string, _removed int, row int, removed string, document int")
    got = op.deduplicate(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(1, "one two three four five six", 1, 2, "r", 3), (2, "", 1, 2, "r", 3)]


def test_one_row_of_the_result_per_row(spark):
    got = op.by_document(op.everything(spark.createDataFrame(SHARED, SCHEMA))).collect()
    assert sorted(str(r.doc_id) for r in got) == ["2", "2", "3", "None", "None"]
    assert all(r.kept_doc_ids == [3] for r in got if r.doc_id == 3) and len({(r.doc_id, r.row) for r in got}) == 5
