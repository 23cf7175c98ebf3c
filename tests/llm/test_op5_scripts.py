from matchcast.llm import unit_dedup as op
from tests.llm.test_op5_passages import brute, closed, frame, removed


def test_long_lines_of_few_words(spark):
    line, url = "这一段没有空格的文字在两个文档里都出现过所以应当去重", "https://example.org/a/very/long/path?of=one&word=only"
    rows = [(1, f"甲\n{line}\n乙"), (2, f"丙\n{line}"), (3, f"see\n{url}"), (4, f"and\n{url}"), (5, "word"), (6, "word")]
    got = {r.doc_id: r.text for r in op.deduplicate(frame(spark, rows)).collect()}
    assert got == dict(rows) | {2: "丙\n", 4: "and\n"}


def test_passages_inside_a_line_without_spaces(spark):
    passage = "".join(chr(0x4E00 + 7 * i) for i in range(70))
    thai = "".join(chr(0x0E01 + i * i % 46) for i in range(90))
    rows = [(1, f"甲乙{passage}丙"), (2, f"丁{passage[5:]}戊己"), (3, f"ก {thai}ข"), (4, f"ab{thai}x"), (5, "Q" * 30 + "ab12" * 20), (6, "R" + "ab12" * 20)]
    got, want = removed(op.passages(frame(spark, rows)).collect()), brute(rows)
    assert {k: closed(dict(rows)[k], v) for k, v in got.items()} == {k: closed(dict(rows)[k], v) for k, v in want.items()} and {2, 4} <= set(want)
