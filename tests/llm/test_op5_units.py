import re

import numpy as np

from matchcast.llm import queries, unit_dedup as op
from matchcast.llm.vec import span_hashes
from tests.llm.cases import ROWS, SCHEMA, frame

WORD = re.compile(r"[^ \t\n\v\f\r]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ends_run(word):
    """Whether the word's hash ends a run."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]) % op.RUN_ENDS == 0


def brute(rows, line_words=3, sentence_words=5, run_words=7):
    """Removed (start, end, keeper) by doc_id, of (doc_id, text) with distinct keys."""
    seen, gone = {}, {}
    long = lambda ws, least, chars: len(ws) >= least or ws and ws[-1][1] - ws[0][0] >= chars
    for key, t in sorted(rows, key=lambda r: r[0]):
        at, units, run = 0, [], []
        for line in (t or "").split("\n"):
            words = [(m.start() + at, m.end() + at, m[0].translate(LOW)) for m in WORD.finditer(line)]
            if long(words, line_words, op.LINE_CHARS):
                units.append((0, words))
            own = []
            for w in words:
                own.append(w)
                if w[2][-1] in ".!?":
                    units += [(1, own)] if long(own, sentence_words, op.PART_CHARS) else []
                    own = []
            units += [(1, own)] if long(own, sentence_words, op.PART_CHARS) else []
            for w in words:
                run.append(w)
                if ends_run(w[2]):
                    units += [(2, run)] if long(run, run_words, op.PART_CHARS) else []
                    run = []
            at += len(line) + 1
        units += [(2, run)] if long(run, run_words, op.PART_CHARS) else []
        for level, ws in sorted(units, key=lambda u: u[1][0][0]):
            name = (level, tuple(w[2] for w in ws))
            if name in seen:
                gone.setdefault(key, []).append((ws[0][0], ws[-1][1], seen[name]))
            else:
                seen[name] = key
    return gone


def check(spark, rows):
    df = spark.createDataFrame([(k, t, None, None, None, "x") for k, t in rows], SCHEMA)
    got = {}
    for r in op.repeats(df).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.kept_doc_id))
    want = brute(rows)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return df, want


def test_equals_brute_force(spark):
    rows = [
        (1, "First line of it.\nA shared license line stands here\nlast"), (2, "a SHARED   license\tline stands here\nother"), (3, "Words before a passage. The very same five words or more stand here! And then others follow it."),
        (4, "é😀 x The very same five words or more stand here! End of the fourth text, and so on."), (5, "x. The very same five words or more stand here! x"), (6, "Same line three\nSame line three\nSame line three"), (7, ""), (8, None), (9, "Same line three"),
    ]
    check(spark, rows)


def test_passages_without_punctuation(spark):
    """Any run of 60 words that two documents share is found, wherever it stands."""
    random = np.random.default_rng(8)
    word = lambda: "".join(random.choice(list("abcdefghij"), 5))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(int(random.integers(0, 40)))] + passage + [word() for _ in range(20)])) for i in range(1, 8)]
    _, want = check(spark, rows + [(90, " ".join(word() for _ in range(200)))])
    assert set(want) == set(range(2, 8))


def test_removal_keeps_the_rest(spark):
    rows = [(1, "one two three four five. rest"), (2, "é head. One two three four five. tail\none two three\nx"), (3, "one two three"), (4, None)]
    df, want = check(spark, rows)
    got = {r.doc_id: r.text for r in op.deduplicate(df).collect()}
    assert got[1] == rows[0][1] and got[2] == "é head. " + " tail\none two three\nx" and got[3] == "" and got[4] is None and op.deduplicate(df).columns == df.columns


def test_cases(spark):
    got = op.by_document(op.repeats(frame(spark))).collect()
    assert sorted((r.doc_id, r.kept_doc_ids) for r in got) == [(4, [4]), (5, [4])]  # of two rows of doc_id 4, one loses its line
    assert op.deduplicate(frame(spark)).count() == len(ROWS) and op.repeats(frame(spark, [])).count() == 0 and op.deduplicate(frame(spark, [])).count() == 0


def test_query(spark, sf):
    """Units and passages of 50 words together: what is removed, how many units, and who keeps it."""
    from tests.llm.test_op5_passages import brute as passages, closed

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    text, want, long, got = dict(docs), brute(docs), passages(docs), {r.doc_id: r for r in queries.op5_substring_dedup(spark, sf).collect()}
    assert set(want) | set(long) == set(got)
    for k, r in got.items():
        own = want.get(k, [])
        assert r.n_units == len(own) and {x for *_, x in own} <= set(r.kept_doc_ids)
        covered = set().union(*(range(s, e) for s, e, _ in own)) | long.get(k, set())
        assert closed(text[k], covered) == closed(text[k], set().union(*(range(*map(int, p.split(":"))) for p in r.removed.split(","))))
        if k not in long:
            assert {x for *_, x in own} == set(r.kept_doc_ids)
