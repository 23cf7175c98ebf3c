from matchcast.llm import secret_scan as op
from tests.llm.test_op3_secrets import HEX, LIVE, docs


def test_base_spans_are_redacted_even_if_copied(spark):
    got = {r.doc_id: r.text for r in op.redact(docs(spark, [f"text {i} password={HEX}" for i in range(4)])).collect()}
    assert got == {i: f"text {i} [assign]" for i in range(4)}


def test_copies_of_a_text_count_once(spark):
    got = {r.doc_id: r.text for r in op.redact(docs(spark, [f"id {LIVE} here"] * 4 + [f"{i} example {LIVE}Q" for i in range(4)])).collect()}
    assert got == {i: "id [live] here" for i in range(4)} | {4 + i: f"{i} example {LIVE}Q" for i in range(4)}
