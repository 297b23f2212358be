"""A scanner of JSON text: the byte ranges of list elements, and the little of an outsize text that its envelope needs.

Spark's own JSON functions write values anew (numbers change, keys are sorted) and refuse texts that are nested
deeper, or hold longer numbers, than their parser allows. Both ways here look at the received text itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The native parser refuses more levels, or more digits, than this; so no shorter text is refused for its size.
NATIVE_LIMIT = 1000

_SPACE = np.isin(np.arange(256), list(b" \t\r\n"))
_STEP = np.zeros(256, np.int64)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_MARKS = np.isin(np.arange(256), list(b"[]{},"))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, one after another, and where each begins; null is empty."""
    texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and len(texts) else np.zeros(0, np.uint8)
    if not len(texts):
        return whole, np.zeros(1, np.int64)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _marks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of brackets, braces and commas that are not inside a string."""
    row_start = np.repeat(offsets[:-1], np.diff(offsets))
    slashes = np.flatnonzero(data == 92)
    quotes = np.flatnonzero(data == 34)
    if len(slashes):
        new = np.concatenate([[True], np.diff(slashes) > 1]) | (slashes == row_start[slashes])
        first = np.maximum.accumulate(np.where(new, np.arange(len(slashes)), 0))
        length = np.zeros(len(data) + 1, np.int64)  # of the run of backslashes that ends at a place
        length[slashes] = np.arange(len(slashes)) - first + 1
        before = np.where(quotes > row_start[quotes], length[quotes - 1], 0)
        quotes = quotes[before % 2 == 0]
    marks = np.flatnonzero(_MARKS[data])
    at_start = np.searchsorted(quotes, row_start[marks])
    return marks[(np.searchsorted(quotes, marks) - at_start) % 2 == 0]


def list_elements(texts: pa.Array) -> pa.Array:
    """The received text of each element of valid JSON lists; null for null and for what is not a list."""
    data, offsets = _buffers(texts)
    marks = _marks(data, offsets)
    row = np.searchsorted(offsets, marks, "right") - 1
    depth = np.cumsum(_STEP[data[marks]])
    # Depth within the row: whatever earlier rows left open does not count.
    first = np.searchsorted(marks, offsets)
    base = np.concatenate([[0], depth])[first[:-1]]
    depth = depth - base[row]
    byte = data[marks]
    opens = (byte == 91) & (np.arange(len(marks)) == first[row]) if len(marks) else np.zeros(0, bool)
    closes = (byte == 93) & (depth == 0)
    cuts = opens | closes | ((byte == 44) & (depth == 1))
    rows = len(offsets) - 1
    listed = (np.bincount(row[opens], minlength=rows) == 1) & (np.bincount(row[closes], minlength=rows) == 1)
    keep = cuts & listed[row]
    at, of = marks[keep], row[keep]
    same = of[1:] == of[:-1]
    begin, end, owner = at[:-1][same] + 1, at[1:][same], of[:-1][same]
    solid = np.flatnonzero(~_SPACE[data])
    where = np.searchsorted(solid, begin)
    begin = np.minimum(solid[np.minimum(where, len(solid) - 1)], end) if len(solid) else begin
    last = np.searchsorted(solid, end) - 1
    end = np.maximum(solid[last] + 1, begin) if len(solid) else end
    full = end > begin  # an empty list has one empty range
    begin, end, owner = begin[full], end[full], owner[full]
    sizes = end - begin
    ends = np.concatenate([[0], np.cumsum(sizes)])
    taken = data[np.arange(int(ends[-1])) + np.repeat(begin - ends[:-1], sizes)] if len(sizes) else data[:0]
    strings = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(taken.tobytes())])
    counts = np.bincount(owner, minlength=rows)
    places = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.ListArray.from_arrays(places, strings.cast(pa.string()), mask=pa.array(~listed))


# The tokens of strict JSON.
_TOKEN = re.compile(
    r'[ \t\n\r]*(?:(?P<mark>[\[\]{},:])|(?P<string>"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*")'
    r"|(?P<number>-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(?P<word>true|false|null))"
)
_END = re.compile(r"[ \t\n\r]*\Z")


def events(text: str) -> Iterator[tuple[str, int, str, int, int]] | None:
    """(kind, level, key, begin, end) of each value of a strict JSON text, containers when they close.

    Works with a list of open containers, so any depth will do. Raises ValueError on anything that is not one value.
    """
    open_: list[tuple[str, int, str]] = []  # bracket, begin, key under which it stands
    at, expect, key = 0, "value", ""
    while True:
        if expect == "end":
            if not _END.match(text, at):
                raise ValueError("text after the value")
            return
        token = _TOKEN.match(text, at)
        if not token:
            raise ValueError("no JSON")
        kind, begin, at = token.lastgroup, token.start(token.lastgroup), token.end()
        mark = text[begin] if kind == "mark" else ""
        if expect in ("value", "value or ]") and mark and mark in "[{":
            open_.append((mark, begin, key))
            key, expect = "", "value or ]" if mark == "[" else "key or }"
            continue
        if expect in ("key", "key or }") and kind == "string":
            key, expect = json.loads(text[begin:at]), ":"
            continue
        if expect == ":" and mark == ":":
            expect = "value"
            continue
        if expect == "more" and mark == ",":
            expect = "value" if open_[-1][0] == "[" else "key"
            continue
        if mark and mark in "]}" and open_ and (open_[-1][0] + mark) in ("[]", "{}") and expect in ("more", "value or ]", "key or }"):
            bracket, begin, key = open_.pop()
            yield bracket, len(open_), key, begin, at
        elif expect in ("value", "value or ]") and not mark:
            yield kind, len(open_), key, begin, at
        else:
            raise ValueError("no JSON")
        expect = "more" if open_ else "end"


def envelope(text: str, required: tuple[str, ...], related: tuple[str, ...]) -> str | None:
    """A small JSON text with the same envelope: the required fields, and the ids of the related objects.

    Fields of a wrong type stay of a wrong type. Ids that are not strings become strings of their text, which is how
    they are read. Null if the text is not strict JSON.
    """
    lists = text.lstrip(" \t\r\n")[:1] == "["
    base = 1 if lists else 0  # level of an event
    elements, own, inner = [], {}, {}
    try:
        for kind, level, key, begin, end in events(text):
            value = json.loads(text[begin:end]) if kind in ("string", "word") else text[begin:end]
            if level == base + 2 and key == "id":
                inner = {"id": value if kind in ("string", "word") else str(value)}
            elif level == base + 1:
                if key in required:
                    own[key] = value if kind == "string" else 0
                elif key in related:
                    own[key] = inner if kind == "{" else 0
                inner = {}
            elif level == base:
                elements.append(own if kind == "{" else 0)
                own, inner = {}, {}
    except ValueError:
        return None
    return json.dumps(elements if lists else elements[0])


def elements_of(texts: Column) -> Column:
    """`list_elements` for a column."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(batch: pa.Array) -> pa.Array:
        return list_elements(batch)

    return run(texts)


def envelope_of(texts: Column, required: tuple[str, ...], related: tuple[str, ...]) -> Column:
    """`envelope` for a column of texts that the native parser refused; short ones it refused rightly."""

    @F.arrow_udf(T.StringType())
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([None if t is None else envelope(t, required, related) for t in batch.to_pylist()], pa.string())

    return run(texts)
