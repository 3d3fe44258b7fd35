"""Substring deduplication with fixed-block anchors.

Any window of ``window`` words holds one block of half as many words that starts at a multiple of the block's
length, counted from its document's start. So non-overlapping blocks are the index, and every rolling window of a
block's length is a probe: a repeat of ``window`` words or more has a block of the one copy under a probe of the
other. Probes and blocks meet by hash; a hash that a block and a further place share is a hit. Hits go back to
their documents and are extended there: each window around a hit is hashed whole, and these hashes meet once more.
Of windows with equal words all but the earliest are repeats, and maximal repeats are the unions of these.

A row a probe would cost several times the text. So some hundred documents at a time send their distinct hashes in
one row for each part of the hash range: keys, counts, and an array of ``PROBE_BYTES`` bytes a hash. Probe hashes
may be short, as they only find what is compared by 80 bits and a part afterwards. The shuffle partitions' number,
which the user sets to fit the data, is the number of parts, so a part holds about what one task is meant to hold,
and hashes gain bits with the data; a window that a third of the documents share is one entry a document in a part.
Documents travel once, keyed by id, for both ways back.

Rows: NULL and empty texts have no words; rows that share an id are one document after another, in the order of a
hash of their text, and among equal rows one is the earlier; rows without an id are the last documents of all;
texts shorter than a window never repeat; an empty table gives an empty table. Columns called like a result are
replaced, all others but the text stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.shared import raw_texts, slices

#: Bytes of a probe's hash besides its part of the hash range; the lowest two bits tell whether it is a block too.
PROBE_BYTES = 4
#: Bytes of a whole window's hash, the lowest bit of the last two telling whether its document has it twice.
WINDOW_BYTES = 10
_KIND = np.uint64(3)
#: Least parts of the hash range: with fewer, small tables would not use all tasks.
LEAST_PARTS = 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64 bits for each word."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each number stirred, so that any part of them can stand for it."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words: a sum with a factor for each place, stirred."""
    count = max(0, len(hashes) - n + 1)
    places = np.random.default_rng(seed).integers(1, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out += hashes[i:i + count] * places[i]
    return _mixed(out)


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of the hash range that each hash lies in, by its upper 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _cuts(*keys: np.ndarray) -> np.ndarray:
    """Where rows that are sorted by ``keys`` begin to differ, with both ends."""
    n = len(keys[0])
    change = np.zeros(max(0, n - 1), bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]]) if n else np.zeros(1, np.int64)


def _packed(values: np.ndarray, cuts: np.ndarray, width: int) -> pa.Array:
    """Binary rows: ``values`` (rows of ``width`` bytes) between ``cuts``."""
    ends = pa.py_buffer((cuts * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, ends, pa.py_buffer(values.tobytes())])


def _low_bytes(hashes: np.ndarray, width: int) -> np.ndarray:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _numbers(packed: np.ndarray) -> np.ndarray:
    """Numbers of the rows' bytes, at most eight."""
    full = np.zeros((len(packed), 8), np.uint8)
    full[:, :packed.shape[1]] = packed
    return full.view("<u8").ravel()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, width)


def _short(hashes: np.ndarray) -> np.ndarray:
    """What a probe row holds of each hash: its lower bytes without the two bits of the kind."""
    return hashes & np.uint64((1 << 8 * PROBE_BYTES) - 1) & ~_KIND


def _whole(part: np.ndarray | int, short: np.ndarray) -> np.ndarray:
    """One number for a part and what a probe row of that part holds."""
    return (np.asarray(part).astype(np.uint64) << np.uint64(8 * PROBE_BYTES)) | short


def _sent(docs: list[np.ndarray], part_of: list[np.ndarray], keys: list[bytes], width: int) -> pa.RecordBatch:
    """Rows (``part``, ``keys``, ``counts``, ``hashes``) of several documents' packed hashes and their parts."""
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    packed = np.concatenate([*docs, np.zeros((0, width), np.uint8)])
    part = np.concatenate([*part_of, np.zeros(0, np.int32)])
    order = np.argsort(part, kind="stable")
    owner, packed, part = owner[order], packed[order], part[order]
    groups = _cuts(part, owner)  # a document's hashes in a part
    rows = _cuts(part[groups[:-1]])  # a part's documents
    at = groups[:-1][rows[:-1]]
    flat = np.frombuffer(b"".join(keys), np.uint8).reshape(len(keys), -1)[owner[groups[:-1]]]
    counts = np.diff(groups).astype("<u4").view(np.uint8).reshape(-1, 4)
    return pa.RecordBatch.from_arrays(
        [pa.array(part[at]), _packed(flat, rows, flat.shape[1]), _packed(counts, rows, 4),
         _packed(packed, groups[rows], width)], ["part", "keys", "counts", "hashes"])


_SENT = "part int, keys binary, counts binary, hashes binary"


def _received(rows: pa.Table, width: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All documents' keys in their order, each packed hash's document, and the packed hashes."""
    keys, counts = [], []
    for joined, numbers in zip(rows["keys"].to_pylist(), rows["counts"].to_pylist(), strict=True):
        n = len(numbers) // 4
        size = len(joined) // n
        keys += [joined[i * size:(i + 1) * size] for i in range(n)]
        counts.append(np.frombuffer(numbers, "<u4"))
    packed = np.frombuffer(b"".join(rows["hashes"].to_pylist()), np.uint8).reshape(-1, width)
    order = sorted(range(len(keys)), key=keys.__getitem__)
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    return [keys[i] for i in order], np.repeat(place, np.concatenate(counts)), packed


def _returned(keys: list[bytes], owner: np.ndarray, packed: np.ndarray, **same: object) -> pa.Table:
    """Rows (``key``, ``hashes``) of the documents that have any."""
    order = np.argsort(owner, kind="stable")
    cuts = _cuts(owner[order])
    at = owner[order][cuts[:-1]]
    columns = {n: pa.array([v] * len(at), pa.int32()) for n, v in same.items()}
    return pa.table({"key": pa.array([keys[i] for i in at], pa.binary()), **columns,
                     "hashes": _packed(packed[order], cuts, packed.shape[1])})


def _probes(rows: DataFrame, block: int, parts: int) -> DataFrame:
    """Each document's distinct probe hashes, with 0, 1 or 2 for their kind.

    1: a block of the document has that hash; 2: and the document has it twice, which makes it a hit by itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            docs, part_of = [], []
            for text in raw_texts(batch.column("text")):
                found = rolling(word_hashes(text.split()), block, 1)
                distinct, at, times = np.unique(found, return_inverse=True, return_counts=True)
                kind = np.zeros(len(distinct), np.uint64)
                kind[at[::block]] = 1
                docs.append(_low_bytes(_short(distinct) | np.where(times > 1, 2 * kind, kind), PROBE_BYTES))
                part_of.append(_part(distinct, parts))
            yield _sent(docs, part_of, batch.column("key").to_pylist(), PROBE_BYTES)

    return rows.select("key", "text").mapInArrow(run, _SENT)


def _hits(probes: DataFrame) -> DataFrame:
    """(``key``, ``part``, ``hashes``): the probe hashes of each document that a block and another place share."""
    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        keys, owner, packed = _received(rows, PROBE_BYTES)
        hashes = _numbers(packed)
        kind, hashes = hashes & _KIND, hashes & ~_KIND
        _, group = np.unique(hashes, return_inverse=True)
        anchored = np.bincount(group, kind > 0) > 0
        places = np.bincount(group, np.where(kind == 2, 2, 1))
        hit = (anchored & (places > 1))[group]
        return _returned(keys, owner[hit], _low_bytes(hashes[hit], PROBE_BYTES), part=key[0].as_py())

    return probes.groupBy("part").applyInArrow(meet, "key binary, part int, hashes binary")


def _listed(rows: DataFrame, *columns: str) -> DataFrame:
    """One row a document, with all its rows' ``columns``: no more than the document's own words."""
    return rows.groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct(*columns)).alias("_found"))


def _windows(joined: DataFrame, window: int, block: int, parts: int) -> DataFrame:
    """The distinct whole windows around each document's hits, extended by its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, docs, part_of = [], [], []
            for key, text, found in zip(batch.column("key").to_pylist(), raw_texts(batch.column("text")),
                                        batch.column("_found").to_pylist(), strict=True):
                if not found:
                    continue
                words = word_hashes(text.split())
                probes = rolling(words, block, 1)
                hit = np.isin(_whole(_part(probes, parts), _short(probes)), np.concatenate(
                    [_whole(f["part"], _numbers(_unpacked(f["hashes"], PROBE_BYTES))) for f in found]))
                # A window at p holds the probes at p .. p + window - block.
                sums = np.concatenate([[0], np.cumsum(hit)])
                starts = np.arange(max(0, len(words) - window + 1))
                starts = starts[sums[starts + window - block + 1] > sums[starts]]
                one, first, times = np.unique(rolling(words, window, 2)[starts], return_index=True, return_counts=True)
                two = rolling(words, window, 3)[starts][first] & ~np.uint64(1) | (times > 1).astype(np.uint64)
                keys.append(key)
                docs.append(np.concatenate([_low_bytes(one, 8), _low_bytes(two, WINDOW_BYTES - 8)], axis=1))
                part_of.append(_part(one, parts))
            if keys:
                yield _sent(docs, part_of, keys, WINDOW_BYTES)

    return joined.mapInArrow(run, _SENT)


def _repeats(windows: DataFrame) -> DataFrame:
    """(``key``, ``hashes``): each document's windows that start earlier too, and a last byte: 1 if all its places do.

    Else the document is the first that has the window, and all its places but the first are repeats.
    """
    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        keys, owner, packed = _received(rows, WINDOW_BYTES)  # keys sort as documents do
        one, two = _numbers(packed[:, :8]), _numbers(packed[:, 8:])
        twice, two = two & np.uint64(1), two & ~np.uint64(1)
        order = np.lexsort((owner, two, one))
        same = np.zeros(len(order), bool)
        same[1:] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        later = np.zeros(len(order), bool)
        later[order] = same
        repeat = later | (twice == 1)
        out = np.concatenate([packed[repeat, :8], later[repeat].astype(np.uint8)[:, None]], axis=1)
        return _returned(keys, owner[repeat], out)

    return windows.groupBy("part").applyInArrow(meet, "key binary, hashes binary")


def _repeated_places(words: list[bytes], window: int, found: list[dict]) -> np.ndarray:
    """Which starts of windows are repeats, given the document's repeated windows."""
    packed = np.concatenate([_unpacked(f["hashes"], 9) for f in found])
    hashes = rolling(word_hashes(words), window, 2)
    everywhere = np.isin(hashes, _numbers(packed[packed[:, 8] == 1, :8]))
    but_first = np.isin(hashes, _numbers(packed[packed[:, 8] == 0, :8]))
    _, first = np.unique(hashes, return_index=True)
    but_first[first] = False
    return np.flatnonzero(everywhere | but_first)


def _without_repeats(joined: DataFrame, kept: list[T.StructField], window: int) -> DataFrame:
    """Each document's words that no repeat covers."""
    added = [T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()),
             T.StructField("n_removed", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, sizes, gone = [], [], []
            for text, found in zip(raw_texts(batch.column("text")), batch.column("_found").to_pylist(), strict=True):
                words = text.split()
                sizes.append(len(words))
                gone.append(0)
                if found:
                    step = np.zeros(len(words) + 1, np.int64)
                    starts = _repeated_places(words, window, found)
                    step[starts] += 1
                    step[starts + window] -= 1
                    free = np.cumsum(step[:-1]) == 0
                    gone[-1] = len(words) - int(free.sum())
                    words = [words[i] for i in np.flatnonzero(free)]
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(gone, pa.int64())], [f.name for f in [*kept, *added]])

    return joined.mapInArrow(run, T.StructType([*kept, *added]))


def order_key(doc_id: Column, *more: Column) -> Column:
    """Bytes that sort as documents do: by id, none last, then by further numbers."""
    def sortable(number: Column) -> Column:
        return F.unhex(F.lpad(F.hex(number.cast("long").bitwiseXOR(F.lit(-2 ** 63))), 16, "0"))

    return F.concat(F.unhex(F.when(doc_id.isNull(), F.lit("01")).otherwise(F.lit("00"))),
                    sortable(F.coalesce(doc_id, F.lit(0))), *map(sortable, more))


def drop_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """``df`` with ``kept`` (its text's words that no earlier repeat covers), ``n_words`` and ``n_removed``."""
    if window < 2 or window % 2:
        raise ValueError("the window must be an even number of words")
    block = window // 2
    parts = max(LEAST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fresh = {"kept", "n_words", "n_removed", "key", "text", "_found", "_key"}
    kept = [f for f in df.schema if f.name != text and f.name not in fresh]
    more = []
    if _has_repeated_ids(df, doc_id):
        same = Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.lit(0))
        more = [F.xxhash64(text), F.row_number().over(same)]
    docs = df.select(*(f.name for f in kept), F.col(text).alias("text"), order_key(F.col(doc_id), *more).alias("key"))
    hits = _listed(_hits(_probes(docs, block, parts)), "part", "hashes")
    joined = docs.join(hits.hint("merge"), F.col("key") == F.col("_key"), "left").drop("_key")
    found = _listed(_repeats(_windows(joined, window, block, parts)), "hashes")
    return _without_repeats(docs.join(found.hint("merge"), F.col("key") == F.col("_key"), "left").drop("_key"), kept,
                            window)


def _has_repeated_ids(df: DataFrame, doc_id: str) -> bool:
    """Whether an id occurs twice, so that keys need more than the id."""
    return not df.groupBy(doc_id).count().where("count > 1").isEmpty()
