"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of such a vocabulary reaches over the start of a marked word: the marker of a blank stands at the front of a
piece or fills it. So a text, with its blanks marked, falls into chunks, a run of markers and what follows it, that
are segmented each on its own, and copies of a chunk have the same ids. Every task keeps a table of the distinct
chunks it has met: a chunk that is new is segmented once by the library, and the ids of a text are its chunks' ids
laid down by position. The table is bounded (``CACHE_CHUNKS``) and starts afresh when it is full, which changes no
result. A vocabulary whose pieces do cross markers, or that normalises texts, is used on whole texts instead.

Rows: a NULL text counts as empty, an empty text has no tokens and decodes to the empty text; equal rows each get
their own result; texts of any length are taken in sections cut between chunks; an empty table gives an empty table.
Columns that are already called like a result are replaced, all others but the text stay.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wavemill.llm.shared import slices

#: The marker that stands for a blank.
MARK = "▁"
#: Distinct chunks that a worker remembers before it starts afresh, and the longest that it remembers.
CACHE_CHUNKS, CACHE_CHARS = 200_000, 64
#: Characters of one text that are taken at once; a longer text is cut between chunks.
SECTION_CHARS = 1 << 20

_CHUNK = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")
_START = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


class ChunkTable:
    """Distinct chunks and their ids, as bytes of int32, for one way to cut texts and one segmenter of chunks.

    ``chunk`` finds the chunks of a text one after another; ``start`` finds a character that begins a chunk;
    ``spelt`` has the bytes of every id, if it matters whether a chunk's tokens spell it.
    """

    def __init__(self, chunk: re.Pattern, start: re.Pattern, segment: Callable[[list[str]], list[list[int]]],
                 spelt: list[bytes] | None = None):
        self.chunk, self.start, self.segment, self.spelt = chunk, start, segment, spelt
        self.known: dict[str, bytes] = {}
        #: Chunks whose tokens spell something else.
        self.unlike: set[str] = set()

    def sections(self, text: str) -> Iterator[str]:
        """The text in parts of about ``SECTION_CHARS`` characters, cut where chunks begin."""
        at = 0
        while len(text) - at > SECTION_CHARS and (cut := self.start.search(text, at + SECTION_CHARS)):
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def ids(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids of every text, in order, and whether all its chunks are spelt by their tokens."""
        if all(len(t) <= SECTION_CHARS for t in texts):
            return self._ids(texts)
        ids, like = [], []
        for text in texts:
            parts = [self._ids([part]) for part in self.sections(text)]
            ids.append(b"".join(x for p, _ in parts for x in p))
            like.append(all(x for _, p in parts for x in p))
        return ids, like

    def _ids(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        split = list(map(self.chunk.findall, texts))
        known, unlike = self.known, self.unlike
        if len(known) > CACHE_CHUNKS:
            known.clear()
            unlike.clear()
        new = list(set().union(*split) - known.keys())
        for c, found in zip(new, self.segment(new), strict=True):
            known[c] = array("i", found).tobytes()
            if self.spelt is not None and b"".join(map(self.spelt.__getitem__, found)) != c.encode():
                unlike.add(c)
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        like = list(map(unlike.isdisjoint, split)) if unlike else [True] * len(texts)
        for c in new:
            if len(c) > CACHE_CHARS:
                del known[c]
                unlike.discard(c)
        return out, like


class Pieces:
    """One model file, opened."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.model = SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        rules = spec.normalizer_spec
        self.size = len(spec.pieces)
        plain = (rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
                 and not rules.precompiled_charsmap and not spec.trainer_spec.treat_whitespace_as_suffix)
        #: Whether marked words can be segmented apart from each other.
        self.separable = plain and not any(MARK in p.piece.lstrip(MARK) for p in spec.pieces)
        #: Whether pieces and bytes spell every text as it is, but for blanks.
        self.exact = plain and sum(map(self.model.is_byte, range(self.size))) == 256
        #: A marker alone, which is no text to the library: what a blank at the end adds.
        self.lone = self.model.encode("x ")[len(self.model.encode("x")):]
        #: The bytes of every piece.
        self.spelt = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(x.piece for x in spec.pieces)]
        self.table = ChunkTable(_CHUNK, _START, self.segment, self.spelt)

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks; the library puts back the blank that is taken from each."""
        found = self.whole([c[1:] for c in chunks])
        return [ids if len(c) > 1 else self.lone for c, ids in zip(chunks, found, strict=True)]

    def whole(self, texts: list[str]) -> list[list[int]]:
        """Ids by the library, which puts a marker before each text."""
        return self.model.encode(texts, num_threads=1) if texts else []

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each as bytes of int32."""
        if self.separable:
            return [x if t else b"" for t, x in zip(texts, self.table.ids([" " + t for t in texts])[0], strict=True)]
        return [np.array(x, np.int32).tobytes() for x in self.whole(texts)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def id_lists(ids: list[bytes]) -> pa.Array:
    """Bytes of int32 as one Arrow list each."""
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(df: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` with ``token_ids`` in place of its text column, and with their text ``decoded`` too if asked for."""
    added = ["token_ids"] + ["decoded"] * decoded
    kept = [f for f in df.schema if f.name != text and f.name not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in slices(batches, text):
            ids = model.encode([x or "" for x in batch.column(text).to_pylist()])
            columns = [id_lists(ids)]
            if decoded:
                columns.append(pa.array(model.decode([np.frombuffer(x, np.int32).tolist() for x in ids]), pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *columns],
                                             [*(f.name for f in kept), *added])

    types = {"token_ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}
    return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, types[n]) for n in added)]))


def decode(df: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded``, the text of its ids; NULL decodes to the empty text, unknown ids are left out."""
    kept = [f for f in df.schema if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = [[i for i in x or [] if i is not None and 0 <= i < model.size]
                         for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept), pa.array(model.decode(lists), pa.string())],
                    [*(f.name for f in kept), "decoded"])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField("decoded", T.StringType())]))
