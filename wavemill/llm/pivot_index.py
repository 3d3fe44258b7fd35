"""Approximate nearest neighbours with a permutation index.

Vectors are represented by the order of the pivots nearest to them. Pivots are rows of a bounded sample, about as
many as the square root of the rows (``PIVOTS``), so every task can hold them; every row is indexed. A row is posted
in the inverted file of its nearest pivot with the ranks of its ``POSTED`` nearest ones. Files that are neighbours in
number share a block until it is full, a file too large for one is dealt to several. A query is sent only to blocks
that hold a file of its own nearest pivots (``OPENED``), reads only those files, and ranks what it reads by the
footrule distance, the sum over pivots of how far the ranks lie apart; a pivot that one side lacks counts as if it
stood behind all that side keeps. The nearest share is ranked again by cosine, in double precision, and the best of
all blocks are the answer. Queries are dealt to parts, so that no task holds all of a block's queries.

Equal vectors are one entry of the index, with the few smallest ids that a result can show: ``k`` besides the
query's own. So a group of copies, however large, is met once, and its queries are answered once.

Rows: vectors that are NULL, all zero, of another length than most, or hold NULL, NaN or infinite components take
no part, neither do rows without an id; of rows that share an id the one with the smallest vector counts; an
empty table gives an empty result; queries with fewer than ``k`` others return them all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.shared import cut

#: Fewest and most pivots, and how many of the nearest ones a vector keeps in order.
PIVOTS, POSTED = (256, 1024), 128
#: Share of the pivots whose files a query opens.
OPENED = 7 / 8
#: Distinct vectors of a block, and queries of a part, for each pivot.
BLOCK_ROWS, PART_QUERIES = 32, 8
#: Share of what a query reads in a block that is ranked by cosine, and the least number.
RERANKED, LEAST_RERANKED = 1 / 8, 64
#: Rows that are compared at once.
_PIECE = 2048


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(``vec_id``, ``v``): vectors of doubles that have a direction."""
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~bad).where(
        F.exists("v", lambda x: x != 0))
    return good.groupBy("vec_id").agg(F.min("v").alias("v"))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(``cls``, ``v``, ``ids``): each distinct vector once, with the ``k`` + 1 smallest ids that have it."""
    few = rows.withColumn("mark", F.xxhash64("v")).withColumn("part", F.pmod("vec_id", F.lit(64)))
    nth = F.row_number().over(Window.partitionBy("mark", "v", "part").orderBy("vec_id"))
    some = few.withColumn("n", nth).where(F.col("n") <= k + 1)  # in parts first: copies may be a third of all rows
    ids = F.slice(F.array_sort(F.collect_set("vec_id")), 1, k + 1)
    return some.groupBy("mark", "v").agg(ids.alias("ids")).select(F.col("ids")[0].alias("cls"), "v", "ids")


def pivots(entries: DataFrame, count: int) -> np.ndarray:
    """Directions of the pivots, drawn from the entries by a hash; only those of the commonest length."""
    rows = [r["v"] for r in entries.orderBy(F.xxhash64("cls"), "cls").limit(count).select("v").collect()]
    lengths = Counter(map(len, rows))
    length = max(lengths, key=lambda n: (lengths[n], -n), default=1)
    return _directions(np.array([v for v in rows if len(v) == length], float).reshape(-1, length))


def _directions(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest_pivots(x: np.ndarray, directions: np.ndarray, posted: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    return np.argsort(-(_directions(x) @ directions.T), axis=1, kind="stable")[:, :posted]


class Block:
    """Some files of the index: their rows in the files' order, each with what its pivots are worth to a query.

    The footrule distance falls by twice ``posted`` less the greater rank for each pivot that both sides keep, so a
    row holds ``posted`` less its rank for each pivot, and 0 for those it does not keep.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, directions: np.ndarray, posted: int):
        self.posted = min(posted, len(directions))
        self.sums = np.int16 if self.posted < 256 else np.int32  # of posted, posted - 1, ... 1
        near = nearest_pivots(x, directions, self.posted)
        order = np.argsort(near[:, 0], kind="stable")
        self.ids, self.x, near = ids[order], _scaled(x[order]), near[order]
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        self.files, starts = np.unique(near[:, 0], return_index=True)
        self.ends = np.append(starts, len(ids))
        self.worth = np.zeros((len(directions), len(ids)), np.int16)
        self.worth[near, np.arange(len(ids))[:, None]] = self.posted - np.arange(self.posted)

    def read(self, near: np.ndarray, opened: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows in the files that a query opens, and how much nearer than none each is by footrule."""
        hit = np.isin(self.files, near[:opened])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        worth = (self.posted - np.arange(self.posted, dtype=np.int16))[:, None]
        places, saved = [], []
        for start, end in self.ends[edges].reshape(-1, 2):  # files side by side are read at once
            for a in range(start, end, _PIECE):
                both = self.worth[near[:self.posted], a:min(a + _PIECE, end)]
                saved.append(np.minimum(both, worth, out=both).sum(axis=0, dtype=self.sums))
            places.append(np.arange(start, end))
        return (np.concatenate(places), np.concatenate(saved)) if places else (np.zeros(0, int), np.zeros(0, self.sums))

    def best(self, query: np.ndarray, near: np.ndarray, opened: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the ``k`` best rows, best first, ties to the smaller id."""
        rows, saved = self.read(near, opened)
        n = max(LEAST_RERANKED, k, int(len(rows) * RERANKED))
        if n < len(rows):
            rows = rows[saved >= -np.partition(-saved, n - 1)[n - 1]]  # all that tie with the last
        y = _scaled(query[None])[0]
        score = (self.x[rows] @ y) / (self.norm[rows] * np.sqrt(y @ y))
        first = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows][first], score[first]


class Layout:
    """Which blocks hold the rows of which file."""

    def __init__(self, rows: dict[int, int], pivot_count: int, block_rows: int):
        self.first, self.parts = np.zeros(pivot_count, np.int64), np.ones(pivot_count, np.int64)
        block = held = 0
        for file in range(pivot_count):
            n = rows.get(file, 0)
            if held and held + n > block_rows:
                block, held = block + 1, 0
            self.first[file], self.parts[file] = block, max(1, -(-n // block_rows))
            held += n
            if n > block_rows:
                block, held = block + int(self.parts[file]), 0

    def of_rows(self, files: np.ndarray, ids: np.ndarray) -> np.ndarray:
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        return self.first[files] + (mixed % self.parts[files].astype(np.uint64)).astype(np.int64)

    def of_files(self, files: np.ndarray) -> np.ndarray:
        more = [np.arange(self.first[f], self.first[f] + self.parts[f]) for f in files[self.parts[files] > 1]]
        return np.unique(np.concatenate([self.first[files], *more]))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no cosine: squares neither vanish nor overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def search(df: DataFrame, is_query: Callable[[Column], Column], k: int = 5, vec_id: str = "vec_id",
           vector: str = "embedding", pivot_count: int | None = None, posted: int = POSTED,
           share: float = OPENED) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the nearest others found for each row where ``is_query(id)``."""
    rows = usable(df, vec_id, vector)
    entries = cut(classes(rows, k))
    if pivot_count is None:
        pivot_count = min(max(PIVOTS[0], 1 << round(entries.count() ** 0.5).bit_length()), PIVOTS[1])
    directions = pivots(entries, pivot_count)
    opened = max(-(-int(len(directions) * share * 1000) // 1000), 4 * (k + 1))
    asking = rows.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v")
    named = entries.select(F.col("v").alias("_v"), F.col("cls").alias("query"))
    asked = cut(asking.join(named, F.col("v") == F.col("_v")).select("query_id", "query"))
    distinct = asked.select(F.col("query").alias("cls")).distinct()
    queries = entries.join(distinct, "cls", "left_semi").select(F.col("cls").alias("query"), F.col("v").alias("w"))
    parts = max(1, -(-distinct.count() // (PART_QUERIES * pivot_count)))

    def posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _fitting(pa.table(batch), "cls", "v", directions)
            yield _batch(cls=ids, v=x, file=nearest_pivots(x, directions, 1).ravel())

    index = cut(entries.select("cls", "v").mapInArrow(posts, "cls long, v array<double>, file long"))
    counts = {r["file"]: r["count"] for r in index.groupBy("file").count().collect()}  # a row a pivot
    layout = Layout(counts, len(directions), BLOCK_ROWS * pivot_count)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _fitting(pa.table(batch), "cls", "v", directions)
            block = layout.of_rows(batch.column("file").to_numpy(), ids)
            for part in range(parts):
                yield _batch(block=block, part=np.full(len(ids), part), cls=ids, v=x)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _fitting(pa.table(batch), "query", "w", directions)
            for name, query, near in zip(ids, x, nearest_pivots(x, directions, opened), strict=True):
                block = layout.of_files(near)
                n = len(block)
                yield _batch(block=block, part=np.full(n, name * 2654435761 % 2**32 % parts), query=np.full(n, name),
                             w=np.repeat(query[None], n, axis=0))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        (ids, x), (names, y) = (_fitting(left, "cls", "v", directions), _fitting(right, "query", "w", directions))
        out: list[tuple] = []
        if len(ids) and len(names):
            block = Block(ids, x, directions, posted)
            for name, query, near in zip(names, y, nearest_pivots(y, directions, len(directions)), strict=True):
                found, score = block.best(query, near, opened, k + 1)
                out.append((np.full(len(found), name), found, score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(
            ("query", "cls", "score"), columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    blocks = index.mapInArrow(dealt, "block long, part long, cls long, v array<double>").groupBy("block", "part")
    asks = queries.mapInArrow(sent, "block long, part long, query long, w array<double>").groupBy("block", "part")
    found = blocks.cogroup(asks).applyInArrow(meet, "query long, cls long, score double")
    each = found.join(entries.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)  # one may be the query itself
    mine = asked.join(best, "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("n"))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    """A batch of whole numbers and, from matrices, of lists of doubles."""
    arrays = [pa.array(c, pa.int64()) if c.ndim == 1 else pa.ListArray.from_arrays(
        pa.array(np.arange(len(c) + 1) * c.shape[1], pa.int32()), pa.array(c.ravel(), pa.float64()))
        for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _fitting(rows: pa.Table, name: str, vector: str, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the rows that are as long as the pivots."""
    length = directions.shape[1]
    kept = rows.filter(pa.compute.equal(pa.compute.list_value_length(rows[vector]), length)).combine_chunks()
    values = pa.compute.list_flatten(kept[vector]).to_numpy()
    return kept[name].to_numpy(), np.asarray(values, float).reshape(-1, length)
