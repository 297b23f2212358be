"""Texts of Arrow batches as byte arrays: chunks, words, hashes, n-gram keys and lookups.

Everything here works on a chunk of a few megabytes at a time, inside a task. A chunk holds
whole texts, so no text is ever cut; a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))


def _bytes_where(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], dtype=bool)


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Bytes of words without space characters, and of words of letters and digits (after lower-casing A-Z).
#: Every byte of a character beyond ASCII is a word byte, so words of bytes are words of characters.
NOT_SPACE = _bytes_where(lambda b: b != 32 and not 9 <= b <= 13)
ALPHANUMERIC = _bytes_where(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows with about `limit` bytes of text; null counts as empty."""
    texts = batch.column(column)
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """The words of a chunk: `start` and `end` in bytes, `row`, and `first`, each row's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, members: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = members[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        before[edges], after[edges - 1] = False, False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64 bits for each word, the same wherever the word stands."""
        up, down = powers(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        return mixed((sums[self.end] - sums[self.start]) * down[self.start])

    def text(self, word: int, n: int = 1) -> bytes:
        """`n` words from `word` on, joined by single spaces."""
        raw = self.data
        return b" ".join(raw[a:b].tobytes() for a, b in zip(self.start[word : word + n], self.end[word : word + n], strict=True))

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of `n` words within a row."""
        if len(self) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total, size = np.zeros(len(self) - n + 1, np.uint64), len(self) - n + 1
        for k in range(n):
            total = total * _PRIME + hashes[k : k + size]
        whole = self.row[:size] == self.row[n - 1 :]
        return np.flatnonzero(whole), mixed(total[whole])


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for base in (_PRIME, _INVERSE):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            np.multiply.accumulate(row, out=row)
            _POWERS.append(row)
        del _POWERS[:-2]
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value over all 64."""
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Table:
    """64-bit keys with a float each, for many lookups at once: about 20 bytes a key.

    Keys are dealt by their mixed bits to buckets and stand sorted by bucket; a lookup walks the few keys of its bucket.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(8, int(len(keys) * 2).bit_length()))
        bucket = (keys * _PRIME) >> self.shift
        order = np.argsort(bucket, kind="stable")
        self.keys, self.values = keys[order], values[order]
        sizes = np.bincount(bucket.astype(np.int64), minlength=1 << (64 - int(self.shift)))
        self.longest = int(sizes.max()) if len(keys) else 0
        self.first = np.zeros(len(sizes) + 1, np.int32 if len(keys) < 2**31 else np.int64)
        np.cumsum(sizes, out=self.first[1:])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in `self.keys`, or -1."""
        found = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return found
        bucket = ((keys * _PRIME) >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        at = at.astype(np.int64)
        same = (at < end) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys)
        found[same] = at[same]
        open_ = np.flatnonzero(~same & (at + 1 < end))
        for step in range(1, self.longest):
            if not len(open_):
                break
            place = at[open_] + step
            same = self.keys[place] == keys[open_]
            found[open_[same]] = place[same]
            open_ = open_[~same & (place + 1 < end[open_])]
        return found


def framed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a closing byte 255, which UTF-8 never has, after each."""
    rows = len(offsets) - 1
    out = np.full(len(data) + rows, 255, np.uint8)
    places = np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))
    out[places] = data
    return out, offsets + np.arange(rows + 1)


def gram_keys(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """For each byte, it and the n - 1 bytes before it in one number: the byte lowest, its nearest context next.

    Contexts reach back to the text's start, before which bytes 255 are taken.
    """
    keys = data.astype(np.uint64)
    reach = 1  # bytes in each key so far
    while reach < n:
        more = min(reach, n - reach)
        earlier = keys[:-reach] & np.uint64((1 << 8 * more) - 1)
        keys[reach:] |= earlier << np.uint64(8 * reach)
        reach += more
    for since in range(min(n - 1, int(np.diff(offsets).max(initial=0)))):
        at = offsets[:-1][np.diff(offsets) > since] + since
        own = np.uint64((1 << 8 * (since + 1)) - 1)
        keys[at] = keys[at] & own | ~own & np.uint64((1 << 8 * n) - 1)
    return keys


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.diff(np.append(heads, len(keys)))


def counted(keys: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the sum of each weight by key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], [np.add.reduceat(w[order], heads) if len(heads) else w[:0] for w in weights]
