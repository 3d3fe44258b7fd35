"""Phrases of words that stand together more often than their parts suggest, by direct-address tiling.

Texts are packed by language (``PACK_BYTES``). Frequent words get ids by rank of frequency, and a pack's words become a
row of ids. Neighbouring ids are pairs: a pack's pairs are dealt to square tiles of ids (``TILE``). Tiles of frequent
words are dense and counted by address with ``bincount``; the rest is sorted and counted as coordinates. The packs'
sorted coordinates meet in slots of about ``SLOT_PAIRS``, dealt by hash, whose number follows the number of words; a
pair that is everywhere is one entry a pack, and beyond ``SLOT_PACKS`` packs a slot is divided again and its sums are
added. Frequent pairs are ranked again and become the ids of the next level, where two pairs that overlap in a word are
a phrase of three, then two of those a phrase of four: a phrase can only be frequent where both of its shorter parts
are. What a pack needs to know of the corpus, the ids of its own frequent words or pairs, comes back to it by key, so
no table of words is held whole anywhere.

Rows: a NULL text counts as empty, a NULL language as ``und``; equal rows all count; texts of any length are taken;
equal scores are ordered by count, then by the phrase's bytes; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.shared import cut, drop_folder, raw_texts, shared_folder, slices

#: Bytes of text whose words are counted together before they meet those of other packs.
PACK_BYTES = 8 << 20
#: Ids on each side of a tile, and the share of its cells from which on it is counted as a dense one.
TILE, DENSE = 512, 1 / 16
#: Entries of packs that meet in one slot, about, and the most packs that they come from.
SLOT_PAIRS, SLOT_PACKS = 1 << 20, 100_000
#: Bytes of a row group of the packs' files: rows are long, and what a task holds of them must not follow its share.
GROUP_BYTES = 16 << 20
#: The score of two parts that never stand apart.
SCALE = 1_000_000

_BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")


class _Places(dict):
    """Words by order of appearance; 0 is the break between pieces."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _fresh() -> tuple[_Places, list[np.ndarray]]:
    return _Places({b"\xff": 0}), []


_WORDS = "pack long, lang string, ids array<int>, words array<binary>, times array<long>"
# A row of ids for each pack, and a row for each of its slots: entries ``first``, ``first`` + 1, ... of the pack.
_PAIRS = "pack long, lang string, ids array<int>, slot int, first int, lefts array<{0}>, rights array<{0}>, " \
         "times array<int>"
# A row of pairs for each slot, and a row for each pack in it: the pack's entries, and which pairs of the slot they are.
_MERGED = "lang string, slot int, pack long, places array<int>, pairs array<int>, lefts array<long>, " \
          "rights array<long>, times array<long>"
_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())


def packed_words(df: DataFrame, lang: str, text: str, pack_bytes: int) -> DataFrame:
    """Words of many texts of one language a row: their places in the row's own list, -1 between pieces."""
    schema = pa.schema([("pack", pa.int64()), ("lang", pa.string()), ("ids", pa.list_(pa.int32())),
                        ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40  # the table is written once: its packs keep their numbers
        held: dict[str, tuple[_Places, list[np.ndarray]]] = {}
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for name, (places, parts) in held.items():
                ids = np.concatenate(parts) - 1
                times = np.bincount(ids[ids >= 0], minlength=len(places) - 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([number]), pa.array([name]), pa.array([ids], schema.field("ids").type),
                    pa.array([list(places)[1:]], schema.field("words").type),
                    pa.array([times], schema.field("times").type)], schema=schema)
                number += 1

        for batch in slices(batches, text):
            for name, raw in zip(batch.column(lang).to_pylist(), raw_texts(batch.column(text)), strict=True):
                places, parts = held.setdefault("und" if name is None else name, _fresh())
                found = _BREAK.sub(b" \xff ", raw.lower()).split()
                parts.append(np.fromiter(map(places.__getitem__, found), np.int32, len(found)))
                parts.append(np.zeros(1, np.int32))
                size += len(raw)
            if size >= pack_bytes:
                yield from packed()
                held, size = {}, 0
        yield from packed()

    return df.select(F.col(lang), F.col(text)).mapInArrow(run, _WORDS)


def tiled_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids, how often each occurs, and for every pair given its place among the distinct ones."""
    width = 1 + int(max(left.max(), right.max())) // TILE if len(left) else 1
    narrow = [np.int32 if n < 1 << 31 else np.int64 for n in (width * width, len(left))]
    tile = (left // TILE).astype(narrow[0]) * width + (right // TILE).astype(narrow[0])
    order = np.argsort(tile, kind="stable")
    tile = tile[order]
    starts = np.flatnonzero(np.diff(tile, prepend=-1))
    del tile
    stops = np.append(starts[1:], len(order))
    dense = stops - starts >= DENSE * TILE * TILE
    lefts, rights, times, place, base = [], [], [], np.empty(len(left), narrow[1]), 0
    for start, stop in zip(starts[dense], stops[dense], strict=True):
        at = order[start:stop]
        cell = left[at] % TILE * TILE + right[at] % TILE
        found = np.bincount(cell, minlength=TILE * TILE)
        used = np.flatnonzero(found)
        address = np.zeros(TILE * TILE, np.int64)
        address[used] = np.arange(len(used)) + base
        place[at] = address[cell]
        lefts.append(used // TILE + left[at[0]] // TILE * TILE)
        rights.append(used % TILE + right[at[0]] // TILE * TILE)
        times.append(found[used])
        base += len(used)
    rest = order[np.repeat(~dense, stops - starts)]
    del order
    code = left[rest].astype(np.int64)
    code <<= 32
    code |= right[rest]
    by = np.argsort(code)
    code = code[by]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    used, found = code[first], np.diff(first, append=len(code))
    del code
    place[rest[by]] = np.repeat(np.arange(len(first), dtype=narrow[1]) + base, found)
    lefts.append(used >> 32)
    rights.append(used & 0xFFFFFFFF)
    times.append(found)
    return np.concatenate(lefts), np.concatenate(rights), np.concatenate(times), place


def _ranked(rows: DataFrame, *ties: Column) -> DataFrame:
    """``rows`` with ``id``, 0 for a language's commonest: rows are sorted by ranges, no task sees a whole language."""
    order = [F.col("lang"), F.desc("a"), *ties]
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    parts = placed.groupBy("lang", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("lang", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(parts, ["lang", "part"]).withColumn("id", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as Parquet in a folder of the shared one.

    The size of pages and row groups is looked at from the first row on. By default it is after 100 rows, and 100 rows
    of packs are hundreds of megabytes, in the writer as in every reader and in the buffers that both compress with.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    df.write.options(**{"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1}).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def _lists(kind: pa.DataType, values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Values cut into lists at the starts, the first of which is 0."""
    offsets = np.append(starts, len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind.value_type))


def _slots(left: np.ndarray, right: np.ndarray, buckets: int, part: int) -> np.ndarray:
    """The slot of each pair: a hash of both ids, in the part of the slots that the pack belongs to."""
    mixed = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (right.astype(np.uint64) + np.uint64(1)) * np.uint64(
        0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(32)
    return (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % buckets + part * buckets


def _next_level(packs: DataFrame, values: DataFrame, buckets: int, parts: int, wide: bool = True) -> DataFrame:
    """Packs of pairs of neighbouring frequent phrases, from packs of phrases and the ids of the frequent ones.

    Unless ``wide``, the corpus has too few words for an id of more than 31 bits.
    """
    kind = _LONGS if wide else _INTS

    def pairs(rows: pa.Table, values: pa.Table) -> pa.Table:
        ids = rows["ids"].combine_chunks().flatten().to_numpy()
        rank = np.full(int(ids.max(initial=-1)) + 2, -1, np.int32)  # the last cell answers for -1
        places, found = (values[c].combine_chunks().flatten().to_numpy() for c in ("places", "ids"))
        frequent, rank[places] = np.unique(found, return_inverse=True)
        near = rank[ids]
        both = np.flatnonzero((near[:-1] >= 0) & (near[1:] >= 0))
        left, right = near[both], near[1:][both]
        del near, rank
        lefts, rights, times, place = tiled_counts(left, right)
        del left, right
        lefts, rights = frequent[lefts], frequent[rights]
        pack = rows["pack"][0].as_py()
        slot = _slots(lefts, rights, buckets, hash((pack, 7)) % parts)
        order = np.lexsort((rights, lefts, slot))
        moved = np.empty(len(order), np.int32)
        moved[order] = np.arange(len(order))
        out = np.full(len(ids), -1, np.int32)
        out[both] = moved[place]
        starts = np.flatnonzero(np.diff(slot[order], prepend=-1))
        n, lang = len(starts), rows["lang"][0].as_py()
        stream = pa.table({"pack": rows["pack"], "lang": rows["lang"], "ids": pa.array([out], _INTS),
                           "slot": pa.nulls(1, pa.int32()), "first": pa.nulls(1, pa.int32()),
                           "lefts": pa.nulls(1, kind), "rights": pa.nulls(1, kind), "times": pa.nulls(1, _INTS)})
        lists = pa.table({"pack": pa.array(np.full(n, pack)), "lang": pa.array([lang] * n, pa.string()),
                          "ids": pa.nulls(n, _INTS), "slot": pa.array(slot[order][starts], pa.int32()),
                          "first": pa.array(starts, pa.int32()),
                          **{name: _lists(of, x[order].astype(of.value_type.to_pandas_dtype()), starts)
                             for name, of, x in (("lefts", kind, lefts), ("rights", kind, rights),
                                                 ("times", _INTS, times))}})
        return pa.concat_tables([stream, lists])

    rows = packs.where("ids IS NOT NULL").select("pack", "lang", "ids")
    return rows.groupBy("pack").cogroup(values.groupBy("home")).applyInArrow(
        pairs, _PAIRS.format("long" if wide else "int"))


def _merged(packs: DataFrame, least: int) -> tuple[DataFrame, str]:
    """The pairs of every slot that occur ``least`` times or more in it, and which of its packs' entries they are."""
    def merge(rows: pa.Table) -> pa.Table:
        lefts, rights, times = (rows[c].combine_chunks().flatten().to_numpy() for c in ("lefts", "rights", "times"))
        sizes = np.diff(rows["lefts"].combine_chunks().offsets.to_numpy())
        own_left, left = np.unique(lefts, return_inverse=True)
        own_right, right = np.unique(rights, return_inverse=True)
        codes, which = np.unique(left * len(own_right) + right, return_inverse=True)
        total = np.zeros(len(codes), np.int64)
        np.add.at(total, which, times)
        kept = total >= least
        number = np.cumsum(kept) - 1
        here = kept[which]
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(lefts)) + np.repeat(rows["first"].to_numpy() - (np.cumsum(sizes) - sizes), sizes)
        starts = np.flatnonzero(np.diff(row[here], prepend=-1))
        used = row[here][starts]
        codes, n, lang, slot = codes[kept], len(starts), rows["lang"][0].as_py(), rows["slot"][0].as_py()

        def same(value: object, kind: pa.DataType, k: int) -> pa.Array:
            return pa.array([value] * k, kind)

        of_slot = pa.table({"lang": same(lang, pa.string(), 1), "slot": same(slot, pa.int32(), 1),
                            "pack": pa.nulls(1, pa.int64()), "places": pa.nulls(1, _INTS), "pairs": pa.nulls(1, _INTS),
                            "lefts": pa.array([own_left[codes // len(own_right)].astype(np.int64)], _LONGS),
                            "rights": pa.array([own_right[codes % len(own_right)].astype(np.int64)], _LONGS),
                            "times": pa.array([total[kept]], _LONGS)})
        of_packs = pa.table({"lang": same(lang, pa.string(), n), "slot": same(slot, pa.int32(), n),
                             "pack": rows["pack"].take(pa.array(used)).combine_chunks(),
                             "places": _lists(_INTS, place[here], starts),
                             "pairs": _lists(_INTS, number[which][here], starts),
                             **{c: pa.nulls(n, _LONGS) for c in ("lefts", "rights", "times")}})
        return pa.concat_tables([of_slot, of_packs])

    lists = packs.where("ids IS NULL").select("lang", "slot", "pack", "first", "lefts", "rights", "times")
    return _written(lists.groupBy("lang", "slot").applyInArrow(merge, _MERGED))


def _told(merged: DataFrame, known: DataFrame) -> DataFrame:
    """For each pack of each slot, its frequent entries' places and ids."""
    own = merged.where("pack IS NULL").select(
        "lang", "slot", F.posexplode(F.arrays_zip("lefts", "rights")).alias("number", "pair"))
    own = own.select(F.col("lang"), F.col("slot").alias("of"), "number", F.col("pair.lefts").alias("left"),
                     F.col("pair.rights").alias("right"))
    ids = own.join(known.select("lang", "left", "right", "id"), ["lang", "left", "right"]).select(
        F.col("lang").alias("in"), "of", "number", "id")

    def tell(rows: pa.Table, ids: pa.Table) -> pa.Table:
        if not len(rows):
            return rows.schema.empty_table().select([]).append_column("home", pa.array([], pa.int64())).append_column(
                "places", pa.array([], _INTS)).append_column("ids", pa.array([], _LONGS))
        number = ids["number"].to_numpy()
        of_pair = np.full(int(max(number.max(initial=-1), 0)) + 1, -1, np.int64)
        of_pair[number] = ids["id"].to_numpy()
        places, pairs = (rows[c].combine_chunks() for c in ("places", "pairs"))
        pairs_flat = pairs.flatten().to_numpy()
        found = np.where(pairs_flat < len(of_pair), of_pair[np.minimum(pairs_flat, len(of_pair) - 1)], -1)
        here = found >= 0
        row = np.repeat(np.arange(len(rows)), np.diff(pairs.offsets.to_numpy()))[here]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        return pa.table({"home": rows["pack"].take(pa.array(row[starts])).combine_chunks(),
                         "places": _lists(_INTS, places.flatten().to_numpy()[here], starts),
                         "ids": _lists(_LONGS, found[here], starts)})

    rows = merged.where("pack IS NOT NULL").select("lang", "slot", "pack", "places", "pairs")
    return rows.groupBy("lang", "slot").cogroup(ids.groupBy("in", "of")).applyInArrow(
        tell, "home long, places array<int>, ids array<long>")


def phrases(df: DataFrame, least: int = 30, longest: int = 4, lang: str = "lang", text: str = "text",
            pack_bytes: int = PACK_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """Phrases of 1, 2, ... words that occur ``least`` times or more in a language, and the words of each language.

    Each table has ``lang``, ``id`` (rank by frequency), ``phrase``, ``a`` (occurrences), ``heads`` and ``tails``
    (occurrences of its first and of its last 1, 2, ... words) and, from two words on, ``left`` and ``right`` (the ids
    of all words but the last, and but the first). A phrase stands within a piece between punctuation or line ends.
    """
    packs, stored = _written(packed_words(df, lang, text, pack_bytes))
    listed = packs.select("pack", "lang", F.posexplode(F.arrays_zip("words", "times")).alias("place", "entry")).select(
        F.col("pack").alias("home"), "lang", "place", F.col("entry.words").alias("word"), F.col("entry.times").alias("n"))
    size = F.sum(F.aggregate("times", F.lit(0).cast("long"), lambda s, x: s + x))
    totals = cut(packs.groupBy("lang").agg(size.alias("n"), F.count("*").alias("packs")))
    words, count = totals.agg(F.sum("n"), F.sum("packs")).first()
    buckets, parts = max(8, -(-(words or 0) // SLOT_PAIRS)), max(1, -(-(count or 0) // SLOT_PACKS))
    counts = listed.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    known = _ranked(counts, F.col("word"))
    level = cut(known.select("lang", "word", "id", "a", F.col("word").cast("string").alias("phrase"),
                             F.array("a").alias("heads"), F.array("a").alias("tails")))
    found = [level]
    values = listed.join(level.select("lang", "word", "id"), ["lang", "word"]).select(
        "home", F.array("place").alias("places"), F.array("id").alias("ids"))
    done = [stored]
    wide = (words or 0) // max(1, least) >= 1 << 31  # a frequent phrase has ``least`` of the words and more
    for _ in range(longest - 1):
        packs, stored = _written(_next_level(packs, values, buckets, parts, wide))
        for folder in done:  # the levels so far are checkpoints: no one reads these any more
            drop_folder(df.sparkSession, folder)
        merged, told = _merged(packs, least if parts == 1 else 1)
        done = [stored, told]
        own = merged.where("pack IS NULL").select("lang", F.inline(F.arrays_zip("lefts", "rights", "times")))
        counts = own.groupBy("lang", F.col("lefts").alias("left"), F.col("rights").alias("right")).agg(
            F.sum("times").alias("a")).where(F.col("a") >= least)
        known = _ranked(counts, F.col("left"), F.col("right"))
        first = level.select("lang", F.col("id").alias("left"), F.col("phrase").alias("_start"), "heads")
        rest = level.select("lang", F.col("id").alias("right"), F.col("phrase").alias("_end"), "tails")
        level = cut(known.join(first, ["lang", "left"]).join(rest, ["lang", "right"]).select(
            "lang", "left", "right", "id", "a",
            F.concat("_start", F.lit(" "), F.substring_index("_end", " ", -1)).alias("phrase"),
            F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails")))
        found.append(level)
        values = _told(merged, level)
    for folder in done:
        drop_folder(df.sparkSession, folder)
    return found, totals.drop("packs")


def weakest_cut(words: int) -> Column:
    """(``score``, ``k``, ``l``, ``r``) of the cut that a phrase of some words holds worst at; exact at any count."""
    cuts = []
    for k in range(1, words):
        left, right = F.col("heads")[k - 1], F.col("tails")[words - k - 1]
        score = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {2 * SCALE}) div (CAST(heads[{k - 1}] AS DECIMAL(20, 0))"
                       f" + CAST(tails[{words - k - 1}] AS DECIMAL(20, 0)))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(df: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, absorbed: int = 80,
                 lang: str = "lang", text: str = "text", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Each language's first ``top`` phrases by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase goes if a longer frequent one that contains it has ``absorbed`` percent of its occurrences or more: the
    longer by one word are enough to look at, as those that are longer still are no more frequent.
    """
    levels, totals = phrases(df, least, longest, lang, text, pack_bytes)
    kept = []
    for words, level in enumerate(levels[1:], 2):
        rows = level.select("lang", "id", "phrase", "a", weakest_cut(words).alias("cut"))
        if words < longest:
            longer = levels[words]
            over = longer.select("lang", F.explode(F.array("left", "right")).alias("id"), "a").groupBy("lang", "id").agg(
                F.max("a").alias("over"))
            rows = rows.join(over, ["lang", "id"], "left").where(
                F.expr(f"over IS NULL OR CAST(over AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {absorbed}"))
        kept.append(rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    every = kept[0]
    for rows in kept[1:]:
        every = every.unionByName(rows)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = every.withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
