"""The numpy word finder against regular expressions."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from llm_cases import lower  # noqa: E402
from tidemark.llm import words as W  # noqa: E402

ALPHABET = st.text(alphabet="aB7 \t\n.,é漢\x1c\x80 ", max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | ALPHABET, max_size=8), st.integers(1, 40))
def test_words_and_shingles(texts, limit):
    column = pa.array(texts, pa.string())
    for separators, pattern, fold in ((W.SPACES, r"[^\x20\x09-\x0D]+", False), (W.SYMBOLS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        got, hashes, grams = [], {}, {}
        for row, end, data, offsets in W.slices(column, limit):
            found = W.find(data, offsets, separators, fold)
            assert len(found.counts) == end - row
            for a, b in zip(found.first[:-1], found.first[1:]):
                own = [data[i:j].tobytes().decode() for i, j in zip(found.starts[a:b], found.ends[a:b])]
                got.append([lower(w) if fold else w for w in own])
                for word, h in zip(got[-1], found.hashes[a:b]):
                    assert hashes.setdefault(word, h) == h
            three, inside = W.shingles(found, 3)
            listed = [tuple(got[row + k][i : i + 3]) for k in range(end - row) for i in range(len(got[row + k]) - 2)]
            assert int(inside.sum()) == len(listed)
            for gram, h in zip(listed, three[inside]):
                assert grams.setdefault(gram, h) == h
        assert got == [re.findall(pattern, lower(t) if fold else t or "") for t in texts]
        assert len(set(hashes.values())) == len(hashes) and len(set(grams.values())) == len(grams)


def test_long_word_and_long_text():
    data = np.frombuffer(("x" * 3_000_000 + " " + "y " * 700_000).encode(), np.uint8)
    found = W.find(data, np.array([0, len(data)]))
    assert len(found.hashes) == 700_001 and len(np.unique(found.hashes)) == 2


def test_sliced_columns_and_nulls():
    column = pa.array(["a b", None, "c", "", "d e f"])[1:]
    assert [n for _, _, data, offsets in W.slices(column, 2) for n in W.find(data, offsets).counts] == [0, 1, 0, 3]
    assert list(W.slices(pa.array([], pa.string()))) == []
