import re

import numpy as np
import pyarrow as pa
import pytest

from matchcast.llm import vec

TEXTS = ["", "one", "a b  c\td\ne", None, "é ü", "x " * 50, " lead", "trail ", "b c"]


def buffers(texts):
    return vec.utf8(pa.array(texts, pa.string()))


def test_words_and_hashes():
    data, offsets = buffers(TEXTS)
    starts, ends, rows = vec.words(data, offsets, ~vec.SPACE)
    got = [[] for _ in TEXTS]
    hashes = vec.span_hashes(data, starts, ends)
    by_word = {}
    for s, e, r, h in zip(starts, ends, rows, hashes):
        w = data[s:e].tobytes().decode()
        got[r].append(w)
        assert by_word.setdefault(w, h) == h
    assert got == [(t or "").split() for t in TEXTS] and len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_shingles(k):
    data, offsets = buffers(TEXTS)
    starts, ends, rows = vec.words(data, offsets, ~vec.SPACE)
    value, of, at = vec.shingles(vec.span_hashes(data, starts, ends), rows, k)
    want = []
    for r, t in enumerate(TEXTS):
        w = (t or "").split()
        want += [(r, tuple(w[j : j + k])) for j in range(len(w) - k + 1)] if len(w) >= k else ([(r, tuple(w))] if w else [])
    assert of.tolist() == [r for r, _ in want]
    seen = {}
    for (_, s), h in zip(want, value.tolist()):
        assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_and_chunks():
    column = pa.array(TEXTS, pa.string()).slice(2, 4)
    data, offsets = vec.utf8(column)
    assert data.tobytes().decode() == "".join(t or "" for t in TEXTS[2:6]) and len(offsets) == 5
    parts = list(vec.chunks(offsets, 10))
    assert parts[0][0] == 0 and parts[-1][1] == 4 and all(a < b for a, b in parts) and all(p[1] == q[0] for p, q in zip(parts, parts[1:]))
    assert list(vec.chunks(np.zeros(1, np.int64))) == []


def test_white_space_is_what_the_contract_says():
    assert re.findall(r"[^\x20\x09-\x0D]+", "a\x0bb\x1cc\xa0d e") == ["a", "b\x1cc\xa0d", "e"]
    data, offsets = buffers(["a\x0bb\x1cc\xa0d e"])
    assert len(vec.words(data, offsets, ~vec.SPACE)[0]) == 3


def test_ragged():
    assert vec.ragged(np.array([2, 0, 3])).tolist() == [0, 1, 0, 1, 2] and vec.ragged(np.zeros(0, int)).tolist() == []
