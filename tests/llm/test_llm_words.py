"""Word and n-gram arrays against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from postroad.llm.arrays import ALPHANUMERIC, LOWER, NOT_SPACE, Table, Words, chunks, framed, gram_keys

import brute

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .\n\té中😀", max_size=30)), max_size=8)


def parts(values, limit):
    return chunks(pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["t"]), 0, limit)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 40))
def test_words_are_those_of_the_pattern(values, limit):
    for members, pattern in ((NOT_SPACE, brute.SOLID), (ALPHANUMERIC, brute.PLAIN)):
        found, seen = [], {}
        for rows, data, offsets in parts(values, limit):
            words = Words(LOWER[data], offsets, members)
            hashes = words.hashes()
            for r in range(rows.num_rows):
                own = [words.text(k).decode() for k in range(words.first[r], words.first[r + 1])]
                found.append(own)
                for w, h in zip(own, hashes[words.first[r] : words.first[r + 1]], strict=True):
                    assert seen.setdefault(w, h) == h
        assert found == [pattern.findall((v or "").translate(brute.LOW)) for v in values]
        assert len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(1, 7))
def test_gram_keys(values, n):
    for rows, data, offsets in parts(values, 50):
        data, offsets = framed(data, offsets)
        keys = gram_keys(data, offsets, n)
        for r, value in enumerate(rows.column(0).to_pylist()):
            raw = bytes([255] * (n - 1)) + (value or "").encode() + b"\xff"
            assert keys[offsets[r] : offsets[r + 1]].tolist() == [int.from_bytes(raw[k : k + n], "big") for k in range(len(raw) - n + 1)]


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=200), st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_table(keys, others):
    table = Table(np.array(sorted(keys), np.uint64), np.arange(len(keys), dtype=float))
    asked = np.array([*keys, *others], np.uint64)
    places = table.find(asked)
    for key, at in zip(asked.tolist(), places.tolist(), strict=True):
        assert (at >= 0) == (key in keys)
        assert at < 0 or sorted(keys)[int(table.values[at])] == key
