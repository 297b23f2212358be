"""SentencePiece encoding and decoding of a byte-fallback BPE model, by a table of prefixes.

A text is encoded without merging anything. For each prefix of a segment the table holds the last token of
that prefix's encoding. Of the vocabulary's tokens that end at the place (an Aho-Corasick automaton finds them
all in one walk) it is the one that is compatible with the last token of the prefix before it: two tokens are
compatible if merging their joint text gives just these two. Exactly one token fits, so one pass from left to
right fills the table, and the ids are read off backwards. Pair tests are remembered.

No piece holds a space mark after another character, so no token reaches over the start of a run of marks:
texts fall into segments there, and frequent segments are remembered too, in memories of fixed size. Between the tasks of a
worker they are packed as plain bytes, so that a worker that goes on with other work holds little.

Defined results: a null text counts as empty and has no ids; an empty text has no ids and decodes to the
empty text. Texts are read whole. Other columns than the kept ones and the text are not read, so their names
can't clash; repeated rows give a row each; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import marshal
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroad.llm.arrays import chunks

SPACE = "▁"
MEMORY = 400_000


class Vocabulary:
    """What encoding needs of a model: each id's text, its score, and which ids are plain pieces."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: str):
        self.pieces, self.scores, self.kinds = pieces, scores, kinds

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a model file on the driver; its size does not depend on the data."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kind = lambda i: "b" if model.is_byte(i) else "c" if model.is_control(i) else "u" if model.is_unknown(i) else "n"
        found = Vocabulary([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], "".join(map(kind, ids)))
        plain = [p for p, k in zip(found.pieces, found.kinds, strict=True) if k == "n"]
        if found.kinds.count("b") != 256 or any(SPACE in p.lstrip(SPACE) for p in plain):
            raise ValueError("a BPE model with byte fallback and pieces within words is needed")
        return found


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.pieces, self.scores = vocabulary.pieces, vocabulary.scores
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, vocabulary.kinds, strict=True)) if k == "n"}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.byte_ids = [i for i, k in enumerate(vocabulary.kinds) if k == "b"]
        newline = "" if any("\n" in p for p in self.ids) else "\n"
        self.segment = re.compile(f"{SPACE}*[^{SPACE}{newline}]+|{SPACE}+" + newline.replace("\n", "|\n"))
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.packed: list[bytes] = []
        surface = [bytes([self.byte_ids.index(i)]) if k == "b" else b"" if k == "c" else " ⁇ ".encode() if k == "u" else p.replace(SPACE, " ").encode() for i, (p, k) in enumerate(zip(self.pieces, vocabulary.kinds, strict=True))]
        self.sizes = np.array([len(s) for s in surface])
        self.places = np.concatenate([[0], np.cumsum(self.sizes)])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)

    def merged(self, text: str) -> list[str]:
        """Merge by definition: the best pair first, the leftmost of equals. Used on pairs of tokens only."""
        parts: list[str] = list(text)
        following, previous = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
        waiting: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and (right := following[left]) >= 0 and (i := self.ids.get(joint := parts[left] + parts[right])) is not None:
                heapq.heappush(waiting, (-self.scores[i], left, joint))

        for k in range(len(parts)):
            offer(k)
        while waiting:
            _, left, joint = heapq.heappop(waiting)
            right = following[left]
            if right < 0 or not parts[left] or parts[left] + parts[right] != joint:
                continue
            parts[left], parts[right], following[left] = joint, "", following[right]
            if following[right] >= 0:
                previous[following[right]] = left
            following[right] = -1
            offer(previous[left])
            offer(left)
        return [p for p in parts if p]

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        fits = self.fits.get(pair)
        if fits is None:
            if len(self.fits) >= 2 * MEMORY:
                self.fits.clear()
            fits = self.fits[pair] = self.merged(self.pieces[left] + self.pieces[right]) == [self.pieces[left], self.pieces[right]]
        return fits

    def encode_segment(self, segment: str) -> bytes:
        """The ids as 32-bit numbers."""
        n, fits = len(segment), self.fits
        last, size = [-1] * (n + 1), [1] * (n + 1)  # -1: a character without a piece, compatible with anything
        done = -1
        for end, (length, i) in self.automaton.iter(segment):
            if end == done:
                continue
            before = end + 1 - length
            if not before or (left := last[before]) < 0 or ((ok := fits.get(left << 32 | i)) is None and self.compatible(left, i)) or ok:
                last[end + 1], size[end + 1], done = i, length, end
        ids: list[int] = []
        while n:
            if last[n] >= 0:
                ids.append(last[n])
            else:
                ids.extend(self.byte_ids[b] for b in reversed(segment[n - 1].encode()))
            n -= size[n]
        return array("i", ids[::-1]).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        segments = self.segment.findall(SPACE + text.replace(" ", SPACE))
        found = list(map(self.known.get, segments))
        if None in found:
            missing = [k for k, ids in enumerate(found) if ids is None]
            for k in missing:
                found[k] = self.missed(segments[k])
        return b"".join(found)

    def missed(self, segment: str) -> bytes:
        """Segments of the older generation in use move to the newer one; the rest go when that is full."""
        ids = self.known.get(segment) or self.older.get(segment) or self.encode_segment(segment)
        if len(segment) <= 32:
            if len(self.known) >= MEMORY:
                self.older, self.known = self.known, {}
            self.known[segment] = ids
        return ids

    def batches(self, batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        """A task's rows: the other columns, the ids of the last one's texts, and the decoded texts."""
        self.unpack()
        for batch in batches:
            for rows, _, _ in chunks(batch, batch.num_columns - 1):
                yield self.rows(rows, names)
        self.pack()

    def rows(self, rows: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
        found = [self.encode(t or "") for t in rows.columns[-1].to_pylist()]
        flat = np.frombuffer(b"".join(found), np.int32)
        offsets = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])])
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
        return pa.RecordBatch.from_arrays([*rows.columns[:-1], lists, self.decode(flat, offsets)], names=names)

    def pack(self) -> None:
        """Hold what is remembered, but for the older segments, as bytes: 800,000 small objects are ten times as large."""
        self.older = {}
        for memory in (self.known, self.fits):
            self.packed.append(marshal.dumps(memory, 2))
            memory.clear()
        pa.default_memory_pool().release_unused()

    def unpack(self) -> None:
        if self.packed:
            self.known, self.fits = map(marshal.loads, self.packed)
            self.packed = []

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of runs of ids; the mark that encoding put before each text goes."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        data = self.surface[np.arange(total) + np.repeat(self.places[ids] - (ends - sizes), sizes)]
        places = np.concatenate([[0], ends])[offsets]
        keep = np.ones(total, bool)
        first = places[:-1][np.diff(places) > 0]
        keep[first[data[first] == 32]] = False
        places = np.concatenate([[0], np.cumsum(keep)])[places]
        data = data[keep].tobytes()
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)])
        try:
            return texts.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text has: each byte out of place becomes U+FFFD
            return pa.array([_mended(t) for t in texts.to_pylist()], pa.string())


def _mended(raw: bytes) -> str:
    return re.sub("[\udc80-\udcff]", "�", raw.decode("utf-8", "surrogateescape"))


_ENCODERS: dict[int, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One for each vocabulary and worker process."""
    key = hash((len(vocabulary.pieces), tuple(vocabulary.pieces[-200:]), tuple(vocabulary.scores[-200:])))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The kept columns, the text's ids, and the text that decoding these ids gives. One pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the model file
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoder(shared.value).batches(batches, schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)


def digests(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    return encoded.select(
        key,
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )
