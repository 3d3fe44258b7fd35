"""Alignment of two tokenizers over the same texts, by galloping intersection of token ends.

Both tokenizations of a text spell the same bytes, so each is an ascending list of byte ends. The shorter list drives:
every end of it starts at its text's proportional place in the longer list, doubles its step until it has passed the value and
then halves the bracket, all ends of a batch of texts in lockstep. Ends that both lists hold cut the texts into groups;
the differences of the ranks that the search leaves behind are the ranges of tokens that overlap.

A link is a token of either side that end together. Links of an id pair are counted over the whole corpus: texts are
packed (``PACK_BYTES``), each pack counts its distinct pairs, pairs meet once a pack in one aggregate, and the counts
come back to the packs by a join, so a pair that is everywhere is one row a pack and no document is shuffled by pair.

Rows: a NULL or empty text, and one whose tokens of either side do not spell a blank and the text, has no tokens at
all; strings of special tokens in a text are plain text; equal rows each get their own result and all count; texts of
any length are taken; an empty table gives an empty table. Columns called like a result are replaced, all others but
the text stay.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.piece_table import MARK, SECTION_CHARS, ChunkTable, pieces
from wavemill.llm.shared import shared_folder, slices

#: Bytes of text whose pairs are counted together before they meet those of others.
PACK_BYTES = 4 << 20
# White space of Unicode: Python's, but for four separators that it adds.
_BLANK = r"[^\S\x1c-\x1f]"
_CHUNK = re.compile(rf"{_BLANK}*(?:\S|[\x1c-\x1f])+|{_BLANK}+")
_START = re.compile(rf"(?<=[\S\x1c-\x1f]){_BLANK}")
# Characters beyond those that both libraries' tables have always agreed on, and long runs of blanks.
_ODD = re.compile("[^\x00-\u02ff\u0370-\u0377\u0400-\u0481\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa"
                  "\u4e00-\u9fa5\uac00-\ud7a3]|\\s{100}")
# The byte-level rule of division, a fixed pattern.
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE file: ids of texts that start with a blank, and the bytes of every id.

    Texts of common characters take the same merges through a second library, which is faster; all others, and all
    texts of files whose ids are not in the order of their merges, take the file's own, each distinct chunk once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        spec = json.loads(self.library.to_str())
        vocab = self.library.get_vocab(with_added_tokens=True)
        letters, added = byte_of_letters(), {t["content"] for t in spec["added_tokens"]}
        self.spelt = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.spelt[i] = token.encode() if token in added else bytes(letters[x] for x in token)
        # The file's rule puts a run of blanks into one pre-token with what follows, or apart: never before the run.
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        self.quick = None
        if plain and merged == list(range(256, 256 + len(merged))) and not spec["model"]["ignore_merges"]:
            import tiktoken

            ranks = {self.spelt[i]: i for i in range(256 + len(merged))}
            self.quick = tiktoken.Encoding("quick", pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        whole = re.compile(r"(?s).+")
        self.table = ChunkTable(_CHUNK if plain else whole, _START if plain else re.compile(r"(?!)"), self.segment,
                                self.spelt)

    def segment(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for at in range(0, len(chunks), 4096) for e in
                self.library.encode_batch_fast(chunks[at:at + 4096], add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids of a blank and each text, as bytes of int32, and whether they spell it."""
        marked = [" " + t for t in texts]
        slow = [self.quick is None or len(t) > SECTION_CHARS or bool(_ODD.search(t)) for t in marked]
        rest = iter(zip(*self.table.ids([t for t, odd in zip(marked, slow, strict=True) if odd]), strict=True))
        both = [next(rest) if odd else (array("i", self.quick.encode_ordinary(t)).tobytes(), True)
                for t, odd in zip(marked, slow, strict=True)]
        return [x for x, _ in both], [like for _, like in both]


class PieceLevel:
    """A SentencePiece file: ids of texts, which it puts a blank before, and the bytes of every id."""

    def __init__(self, path: str):
        self.pieces = pieces(path)
        self.spelt = self.pieces.spelt

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        ids = [array("i", x) for x in self.pieces.whole(texts)]
        # Without normalisation, and with bytes for what is in no piece, only a marker is spelt otherwise.
        like = [self.pieces.exact and MARK not in t or
                b"".join(map(self.spelt.__getitem__, x)) == b" " + t.encode() for x, t in zip(ids, texts, strict=True)]
        return [x.tobytes() for x in ids], like


@lru_cache(maxsize=4)
def opened(path: str) -> ByteLevel | PieceLevel:
    return ByteLevel(path) if path.endswith(".json") else PieceLevel(path)


def proportional(few_stops: np.ndarray, many_stops: np.ndarray) -> np.ndarray:
    """For each place of one list of texts' entries, the place as far into its text's entries in the other."""
    few, many = np.diff(few_stops, prepend=0), np.diff(many_stops, prepend=0)
    within = np.arange(few_stops[-1] if len(few_stops) else 0) - np.repeat(few_stops - few, few)
    return np.repeat(many_stops - many, few) + within * np.repeat(many, few) // np.repeat(few, few)


def gallop(few: np.ndarray, many: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each of ``few``, ascending, how many of ``many``, ascending, are smaller, sought from ``start`` on."""
    n = len(many)
    if not n or not len(few):
        return np.zeros(len(few), np.int64)
    up = many[start] < few  # the answer lies behind the start; else at it or before
    low, high = np.where(up, start + 1, 0), np.where(up, n, start)
    step, open_ = 1, np.arange(len(few))
    while len(open_):  # doubling steps away from the start until the value is bracketed
        ups = up[open_]
        at = np.where(ups, start[open_] + step, start[open_] - step)
        inside = (at >= 0) & (at < n)
        smaller = np.zeros(len(open_), bool)
        smaller[inside] = many[at[inside]] < few[open_[inside]]
        raised, lowered = inside & smaller, inside & ~smaller
        low[open_[raised]] = at[raised] + 1
        high[open_[lowered]] = at[lowered]
        open_ = open_[inside & (ups == smaller)]
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):  # halving the brackets
        middle = (low[open_] + high[open_]) // 2
        smaller = many[middle] < few[open_]
        low[open_[smaller]] = middle[smaller] + 1
        high[open_[~smaller]] = middle[~smaller]
        open_ = open_[low[open_] < high[open_]]
    return low


@dataclass
class Aligned:
    """Texts of one batch, side by side: ids, where each text's ids end, and the places of common ends."""

    a: np.ndarray
    b: np.ndarray
    a_stops: np.ndarray
    b_stops: np.ndarray
    a_cuts: np.ndarray  # the last token of each group, on either side
    b_cuts: np.ndarray
    group_stops: np.ndarray  # where each text's groups end
    below: np.ndarray  # for each token of a, how many tokens of b end before it does
    shared: np.ndarray  # and whether one ends with it


class Aligner:
    """Two tokenizer files."""

    def __init__(self, a: str, b: str):
        self.a, self.b = opened(a), opened(b)
        self.a_bytes, self.b_bytes = (np.array([len(x) for x in side.spelt]) for side in (self.a, self.b))
        self.words = [np.array([f"{i}{sep}" for sep in ",|;" for i in range(len(side.spelt))], object)
                      for side in (self.a, self.b)]

    def tokens(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of both sides; none for a text that either side spells otherwise."""
        plain = [t or "" for t in texts]
        (a, a_like), (b, b_like) = self.a.encode(plain), self.b.encode(plain)
        none = [not (t and x and y) for t, x, y in zip(plain, a_like, b_like, strict=True)]
        return tuple([b"" if gone else x for x, gone in zip(ids, none, strict=True)] for ids in (a, b))

    def align(self, texts: list[str | None]) -> Aligned:
        both = self.tokens(texts)
        (a, a_stops), (b, b_stops) = (
            (np.frombuffer(b"".join(x), np.int32), np.cumsum([len(i) // 4 for i in x], dtype=np.int64)) for x in both)
        a_ends, b_ends = np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b])
        if len(a) <= len(b):
            below = gallop(a_ends, b_ends, proportional(a_stops, b_stops))
            shared = b_ends[below] == a_ends if len(a) else np.zeros(0, bool)
            a_cuts = np.flatnonzero(shared)
            b_cuts = below[a_cuts]
        else:
            rank = gallop(b_ends, a_ends, proportional(b_stops, a_stops))
            b_cuts = np.flatnonzero(a_ends[rank] == b_ends)
            a_cuts = rank[b_cuts]
            shared = np.zeros(len(a), bool)
            shared[a_cuts] = True
            below = np.cumsum(np.bincount(rank, minlength=len(a)))[:len(a)] - shared
        group_stops = np.cumsum(np.concatenate([[0], shared]))[a_stops]
        return Aligned(a, b, a_stops, b_stops, a_cuts, b_cuts, group_stops, below, shared)

    def spelt_groups(self, x: Aligned) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2``."""
        out = np.empty(len(x.a) + len(x.b), object)
        for side, (ids, cuts, others, mark) in enumerate(((x.a, x.a_cuts, x.b_cuts, 1), (x.b, x.b_cuts, x.a_cuts, 2))):
            ends = np.zeros(len(ids), np.int64)
            ends[cuts] = 1
            group = np.cumsum(ends) - ends
            behind = np.concatenate([[0], others + 1])[group + side]  # tokens of the other side that stand before
            out[np.arange(len(ids)) + behind] = self.words[side][ids + ends * mark * len(self.words[side]) // 3]
        stops = [0, *(x.a_stops + x.b_stops).tolist()]
        return ["".join(out[i:j])[:-1] for i, j in zip(stops, stops[1:], strict=False)]


@lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def _lists(values: np.ndarray, stops: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], stops]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


_INTS = T.ArrayType(T.IntegerType())
_RESULTS = ("a_ids", "b_ids", "a_ends", "b_ends", "first_overlap", "last_overlap")


def align(df: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """``df`` with both tokenizations of its text and their alignment, in place of the text.

    ``a_ids``, ``b_ids``; ``a_ends``, ``b_ends``: for each group, the index of its last token on either side;
    ``first_overlap``, ``last_overlap``: for each token of ``a`` the range of tokens of ``b`` that share bytes with it.
    """
    kept = [f for f in df.schema if f.name != text and f.name not in _RESULTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a, b)
        for batch in slices(batches, text):
            x = both.align(batch.column(text).to_pylist())
            a_from, b_from = (np.concatenate([[0], s[:-1]]) for s in (x.a_stops, x.b_stops))
            of_token = np.repeat(np.arange(len(x.a_stops)), x.a_stops - a_from)
            of_group = np.repeat(np.arange(len(x.a_stops)), np.diff(x.group_stops, prepend=0))
            behind = x.below + x.shared  # tokens of b that end where this one does, or before
            first = np.concatenate([[0], behind[:-1]])[:len(behind)]
            columns = [_lists(x.a, x.a_stops), _lists(x.b, x.b_stops),
                       _lists(x.a_cuts - a_from[of_group], x.group_stops),
                       _lists(x.b_cuts - b_from[of_group], x.group_stops),
                       _lists(first - b_from[of_token], x.a_stops), _lists(x.below - b_from[of_token], x.a_stops)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *columns],
                                             [*(f.name for f in kept), *_RESULTS])

    return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, _INTS) for n in _RESULTS)]))


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_PACKED = "pack long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
          "links array<int>, pairs array<long>, times array<long>"
_PACKED_ARROW = pa.schema([("pack", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS),
                           ("groups_sha256", pa.string()), ("links", pa.list_(pa.int32())),
                           ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def _packs(df: DataFrame, a: str, b: str, doc_id: str, text: str, pack_bytes: int) -> DataFrame:
    """A row for each text, its links as places in its pack's list of pairs, and a row for each pack with that list."""
    def packed(number: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        counts = np.concatenate([h[1] for h in held])
        pairs, place, times = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True, return_counts=True)
        n = len(counts)
        none = pa.nulls(n, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), pa.concat_arrays([h[0] for h in held]),
             *(pa.array(counts[:, i]) for i in range(4)), pa.array([s for h in held for s in h[3]], pa.string()),
             _lists(place, np.cumsum(counts[:, 3])), none, none], schema=_PACKED_ARROW)
        yield pa.RecordBatch.from_pydict(
            {"pack": [number], **{f.name: [None] for f in _PACKED_ARROW if f.name not in ("pack", "pairs", "times")},
             "pairs": pa.array([pairs], pa.list_(pa.int64())), "times": pa.array([times], pa.list_(pa.int64()))},
            _PACKED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, held, size = aligner(a, b), [], 0
        number = TaskContext.get().partitionId() << 40  # the table is written once: its packs keep their numbers
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            x = both.align(texts)
            shas = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in both.spelt_groups(x)]
            groups = np.diff(x.group_stops, prepend=0)  # every token has bytes, so one link ends every group
            counts = np.stack([np.diff(x.a_stops, prepend=0), np.diff(x.b_stops, prepend=0), groups, groups], axis=1)
            pairs = x.a[x.a_cuts].astype(np.int64) << 32 | x.b[x.b_cuts]
            held.append((batch.column(doc_id).cast(pa.int64()), counts, pairs, shas))
            size += sum(map(len, filter(None, texts)))
            if size >= pack_bytes:
                yield from packed(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield from packed(number, held)

    return df.select(doc_id, text).mapInArrow(run, _PACKED)


def link_counts(df: DataFrame, a: str, b: str, doc_id: str = "doc_id", text: str = "text",
                pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(``doc_id``, counts of tokens, groups and links, ``n_best``, ``count_sum``, ``groups_sha256``) of every text.

    ``count_sum`` adds up, over a text's links, how many links of the corpus hold the same two ids; ``n_best`` counts
    links whose pair is the commonest of its ``b`` id, ties included. Packs are written to the shared folder.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    _packs(df, a, b, doc_id, text, pack_bytes).write.parquet(folder)
    table = spark.read.schema(_PACKED).parquet(folder)
    listed = table.where("pairs is not null").select("pack", F.posexplode(F.arrays_zip("pairs", "times")))
    listed = listed.select("pack", F.col("pos").alias("place"), "col.pairs", "col.times").withColumnRenamed("pairs", "pair")
    totals = listed.groupBy("pair").agg(F.sum("times").alias("total"))
    totals = totals.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    tops = totals.groupBy("b").agg(F.max("total").alias("top"))
    known = totals.join(tops, "b").select("pair", "total", (F.col("total") == F.col("top")).alias("best"))
    back = listed.select(F.col("pack").alias("home"), "place", "pair").join(known, "pair").drop("pair")
    rows = table.where("pairs is null").select("pack", "doc_id", *_COUNTS, "groups_sha256", "links")

    def meet(texts: pa.Table, values: pa.Table) -> pa.Table:
        place = values["place"].to_numpy()
        total, best = np.zeros((2, len(place)), np.int64)
        total[place], best[place] = values["total"].to_numpy(), values["best"].to_numpy()
        links = texts["links"].combine_chunks()
        flat = links.flatten().to_numpy()
        stops = np.cumsum(texts["n_links"].to_numpy())
        sums = [np.diff(np.concatenate([[0], np.cumsum(v[flat])])[stops], prepend=0) for v in (best, total)]
        kept = texts.select(["doc_id", *_COUNTS])
        return kept.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1])).append_column(
            "groups_sha256", texts["groups_sha256"])

    return rows.groupBy("pack").cogroup(back.groupBy("home")).applyInArrow(
        meet, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")
