"""Near-duplicates by SimHash: meet-in-the-middle ball hashing and connected components.

Two fingerprints within ``radius`` bits have a common variant within half of it of each. So every distinct
fingerprint emits all variants in that ball, variants are shuffled, and what meets on a variant is linked.
Fingerprints that share a variant are within the radius of each other, so a chain through a variant's
fingerprints, in order, links them all with no pair besides; a variant has at most 65 of them at radius 2.
Copies share one fingerprint and are emitted once, however many there are.

Rows: a NULL text counts as empty, a text without words has fingerprint zero and is linked like any other;
equal rows share a component; rows without an id take part, but never name a component; an empty table
gives an empty table. All columns but the text stay; those called like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.components import roots
from wavemill.llm.shared import cut, fresh, raw_texts, slices

#: Seed of the shingle hash, Spark's own ``xxhash64`` of one string.
SEED = 42
#: Shingles whose bits are counted at once.
_PART = 1 << 16


def simhash(text: bytes, words: int = 3) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text's word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    found = text.lower().split()  # of bytes: A-Z, and blank and the controls from tab to carriage return
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = list(map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False)))
    hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PART):
        part = hashes[at:at + _PART].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", words: int = 3) -> DataFrame:
    """``df`` with the text's ``fingerprint``, a signed 64-bit number, in place of the text."""
    kept = [f for f in df.schema if f.name not in (text, "fingerprint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            marks = pa.array([simhash(x, words) for x in raw_texts(batch.column(text))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), marks],
                                             [*(f.name for f in kept), "fingerprint"])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField("fingerprint", T.LongType())]))


def ball(fingerprint: str, radius: int) -> str:
    """SQL for all variants of a fingerprint within ``radius`` (0 or 1) bits."""
    if radius not in (0, 1):
        raise ValueError("variants are emitted within 0 or 1 bits: the radius of links is 0 to 3")
    own = f"array({fingerprint})"
    return own if radius == 0 else f"concat({own}, transform(sequence(0, 63), b -> {fingerprint} ^ shiftleft(1L, b)))"


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``a`` - ``b`` that join all distinct fingerprints within ``radius`` bits into the same components.

    A radius of 2 needs variants within 1 bit. (An odd radius is covered by the ball of the next even one and
    the bits counted for each neighbour; chains are only sound for an even radius, so others are refused.)
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    variants = distinct.select("fingerprint", F.explode(F.expr(ball("fingerprint", radius // 2))).alias("variant"))
    near = Window.partitionBy("variant").orderBy("fingerprint")
    return (variants.select(F.col("fingerprint").alias("a"), F.lag("fingerprint").over(near).alias("b"))
            .where("b is not null").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct())


def components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, words: int = 3) -> DataFrame:
    """One row for each row of ``df``: its columns but the text, ``fingerprint`` and ``component_id``."""
    marked = cut(with_fingerprint(df.drop("component_id"), text, words))
    distinct = marked.groupBy("fingerprint").agg(F.min(doc_id).alias("_first"))
    reached = roots(links(distinct.select("fingerprint"), radius))
    rooted = distinct.join(reached, distinct["fingerprint"] == reached["node"], "left").select(
        "fingerprint", "_first", F.coalesce("root", "fingerprint").alias("_root"))
    named = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    names = rooted.join(named, "_root").select("fingerprint", "component_id")
    return marked.join(names, "fingerprint").select(*(c for c in marked.columns), "component_id")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, words: int = 3) -> DataFrame:
    """One row of ``df`` of each component, the one with the smallest id; rows without an id come last, equal ids by text.

    Rows are joined by id and text only, never by fingerprint or component, so no group of copies meets in one task.
    """
    none, number, mark = fresh(df, "none", "number", "mark")
    keys = [F.isnull(doc_id).alias(none), F.xxhash64(doc_id).alias(number),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias(mark)]
    rows = df.select(*[k.alias(n) for k, n in zip(keys, ("none", "number", "mark"), strict=True)],
                     F.col(doc_id).alias("id"), F.col(text).alias("text"))
    marked = cut(with_fingerprint(rows, "text", words))
    each = marked.groupBy("none", "number", "mark", "id", "fingerprint").agg(F.count("*").alias("n"))
    first = F.min(F.struct("none", "id", "mark", "number", "n")).alias("first")
    prints = cut(each.groupBy("fingerprint").agg(first))
    reached = roots(links(prints.select("fingerprint"), radius))
    rooted = prints.join(reached, prints["fingerprint"] == reached["node"], "left").select(
        F.coalesce("root", "fingerprint").alias("root"), "first")
    stays = cut(rooted.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.none").alias(none), F.col("first.number").alias(number), F.col("first.mark").alias(mark), "first.n"))
    keyed, names = df.select("*", *keys), [none, number, mark]
    single = keyed.join(stays.where("n = 1").select(*names), names, "left_semi").select(*df.columns)
    equal = keyed.join(stays.where("n > 1").select(*names), names, "left_semi")
    one = equal.groupBy(*names).agg(F.min(F.struct(*df.columns)).alias("row")).select("row.*")
    return single.unionByName(one)
