import numpy as np
import pyarrow as pa

from matchcast.llm import sigtree_join as op


def test_all_rows_of_a_large_token_are_passed_on():
    """Also those after the buffer was emptied; the next token is judged again."""
    rows = np.array([(7, -1, 10 + i, i, i) for i in range(11)] + [(8, -1, 5, 90, 90), (9, -1, 5, 91, 91), (9, -1, 5, 92, 92)], np.int64)
    names = ["token", "salt", "n", "nid", "comp"]
    for size in (1, 2, 5):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in rows[a : a + size].T], names) for a in range(0, len(rows), size)]
        got = [x for b in op.judged(iter(batches), 90, 100, most=4) for x in b["nid"].to_pylist()]
        assert sorted(got) == [*range(11), 91, 92]
