"""Mixing sources to target weights: packed blocks, drawn counts, permuted indexes.

Each source's documents, in the order of a hash of their id, are one long row of words, packed into blocks of
``block_words``. A source's quota is the blocks that its target holds. Every output shard draws how many of its
slots go to each source, a multinomial draw by quota; what a source's shards have drawn above its quota is taken
away, what they lack is added, evenly over the shards. A source's slots are numbered through its shards, the
number runs through a pseudorandom permutation of the source's blocks, another one each time the source starts
over, and blocks are joined by that index. No quota is above twice the source's blocks, hence no block and no
document is taken more than twice.

Everything is DataFrame code. Prefix sums over a source run within buckets of its documents and over the buckets'
sums, so that no task holds a whole source, however large.

Targets: sources in order of code points, NULL last, weigh 5, 2, 1, repeating, and share 150 % of all words;
a target stops at twice the source, and what is above goes to the others by weight.

Rows: a NULL text has no words; documents without words are taken no times; every row is a document of its own,
also among equal ones; a table without any words has targets of zero; an empty table gives an empty table. Other
columns are left out by ``mix`` and carried by ``mixed_documents``, where rows equal in id, source and text carry
those of one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.shared import cut, fresh

#: Words of a block, the unit that is drawn.
BLOCK_WORDS = 64
#: Slots that an output shard draws; the last one draws what is left.
SHARD_SLOTS = 4096
#: Weights of the sources, in turn, and the mix's size as a share of all words.
WEIGHTS, TOTAL, MOST = (5, 2, 1), 1.5, 2
#: Documents of a bucket, on average: prefix sums of a source run within its buckets and over the buckets' sums.
BUCKET_ROWS = 16384
#: Shards, copies or added slots that one row stands for until they get rows of their own.
_CHUNK = 1024
#: Rounds of the permutations.
ROUNDS = 24

#: What tells documents apart.
DOCUMENT = ["doc_id", "mark", "source", "copy"]

_WORD, _WORD_AND_SPACE = r"[^\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def words_of(text: Column | str, pattern: str = _WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def sized(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(``doc_id``, ``source``, ``mark``, ``copy``, ``size``) of each document.

    ``mark`` tells texts of one id apart. Equal rows are counted before any of them meet and numbered as ``copy``
    afterwards, in steps, so that no task holds all rows that are equal.
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("mark"),
                     F.coalesce(F.size(words_of(text)), F.lit(0)).cast("long").alias("size"))
    key = ["doc_id", "source", "mark", "size"]
    steps = rows.groupBy(*key).agg(F.count("*").alias("n")).select(
        *key, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_CHUNK}"))).alias("step"))
    first = F.col("step") * _CHUNK
    copies = F.sequence(first, F.least(first + _CHUNK, F.col("n")) - 1)
    return cut(steps.repartition(*key, "step").select("doc_id", "source", "mark", F.explode(copies).alias("copy"),
                                                      "size"))


def targets(sizes: DataFrame) -> DataFrame:
    """(``source``, ``src``, ``source_size``, ``buckets``, ``weight``, ``target``): a row a source, numbered from 0."""
    each = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.expr(f"(count(*) - 1) div {BUCKET_ROWS} + 1").alias("buckets"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    rows = each.withColumn("src", number).withColumn("weight", F.get(weights, F.col("src") % len(WEIGHTS)))
    rows = rows.withColumn("cap", MOST * F.col("source_size").cast("double"))
    # The level at which a share of the weight stops: each source in turn is the first that isn't full, in order
    # of the level that fills it, and the level sought is the highest of all these.
    everything, order = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(
        F.col("cap") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    total = TOTAL * F.sum("source_size").over(everything)
    full = F.coalesce(F.sum("cap").over(order), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    rows = rows.withColumn("_level", (total - full) / left)
    level = F.max("_level").over(everything)
    return rows.withColumn("target", F.least("cap", F.col("weight") * level)).select(
        "source", "src", "source_size", "buckets", "weight", "target")


def numbered(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document of some words with ``src`` and ``start``, its first word's place in its source's row."""
    rows = sizes.where("size > 0").join(sources.select("source", "src", "buckets"),
                                        sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "mark", "copy"), F.col("buckets")))
    sums = rows.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("src", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("src", "bucket").orderBy(
        F.xxhash64("mark", "doc_id", "copy"), "doc_id", "mark", "copy").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return rows.join(sums, ["src", "bucket"]).select(
        *DOCUMENT, "src", "size", (F.col("before") + F.col("inside")).alias("start"))


def pieces(documents: DataFrame, block_words: int) -> DataFrame:
    """Blocks' shares of documents: (``src``, ``block``, ``DOCUMENT``, ``first``, ``n_words``)."""
    at = F.sequence(F.floor(F.col("start") / block_words),
                    F.floor((F.col("start") + F.col("size") - 1) / block_words))
    rows = documents.withColumn("block", F.explode(at))
    first = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return rows.select("src", "block", *DOCUMENT, (first - F.col("start")).alias("first"),
                       (end - first).alias("n_words"))


def quotas(sources: DataFrame, block_words: int) -> DataFrame:
    """(``src``, ``blocks``, ``quota``): a source's blocks, and how many slots of the mix are its own."""
    rows = sources.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block_words))
    share = F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")
    return rows.select("src", "blocks", F.least(share, MOST * F.col("blocks")).alias("quota"))


def _spread(df: DataFrame, last: Column, name: str) -> DataFrame:
    """Rows of ``df`` for each number ``name`` from 0 to ``last``, made in many tasks however few rows there are."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = df.where(last >= 0).withColumn("_last", last.cast("long")).withColumn(
        "_step", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"_last div {_CHUNK}"))))
    first = F.col("_step") * _CHUNK
    return steps.repartition(parts, "_step").withColumn(name, F.explode(F.sequence(
        first, F.least(first + _CHUNK - 1, F.col("_last"))))).drop("_step", "_last")


def drawn_counts(quota: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(``shard``, ``src``, ``n_slots``): how many of a shard's slots go to each source, a multinomial draw."""
    total = quota.agg(F.sum("quota").alias("total"), F.sort_array(F.collect_list(F.struct("src", "quota"))).alias("q"))
    # One row: the sources and, in their order, the sums of quotas up to and with each.
    upto = F.transform("q", lambda x, i: F.aggregate(
        F.slice("q", 1, i + 1), F.lit(0).cast("long"), lambda n, y: n + y["quota"]))
    total = total.where("total > 0").select("total", F.col("q.src").alias("srcs"), upto.alias("upto"))
    shards = _spread(total, F.expr(f"(total - 1) div {shard_slots}"), "shard")
    slots = F.least(F.lit(shard_slots).cast("long"), F.col("total") - F.col("shard") * shard_slots)
    draws = shards.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), slots)))
    draws = draws.withColumn("u", F.pmod(F.xxhash64(F.lit(seed), "shard", "i"), F.col("total")))
    source = F.get("srcs", F.size(F.filter("upto", lambda n: n <= F.col("u"))))
    return draws.select("shard", source.alias("src")).groupBy("shard", "src").agg(F.count("*").alias("n_slots"))


def slots(sources: DataFrame, block_words: int, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix: (``src``, ``slot``, ``shard``, ``epoch``, ``block``), one row for each block that is taken."""
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows now, many soon
    quota = quotas(sources, block_words)
    counts = cut(drawn_counts(quota, seed, shard_slots))
    # Where a shard's slots begin among all that its source has drawn: sums within groups of shards and over them.
    counts = counts.withColumn("group", F.expr(f"shard div {_CHUNK}"))
    sums = counts.groupBy("src", "group").agg(F.sum("n_slots").alias("n"))
    before = Window.partitionBy("src").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("src", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("src", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("n_slots").over(within), F.lit(0))).join(
        sums, ["src", "group"])
    whole = counts.groupBy("src").agg(F.sum("n_slots").alias("drawn"))
    quota = quota.join(whole, "src", "left").na.fill(0, ["drawn"])
    first = F.col("before") + F.col("inside")
    # A shard's row learns about its source before it becomes slots: a join of slots with the few sources would pass
    # for one of few rows with few rows, the slots be broadcast and a single task go through them.
    shares = counts.select("src", "shard", "n_slots", first.alias("first")).join(quota, "src").repartition(
        parts, "src", "shard")
    numbers = shares.select("src", "blocks", "quota", "drawn", "shard", F.explode(
        F.sequence(F.col("first"), F.col("first") + F.col("n_slots") - 1)).alias("number"))
    # Of ``drawn`` slots ``above`` are taken away, at equal distances; the others close up.
    kept = numbers.withColumn("above", F.greatest(F.col("drawn") - F.col("quota"), F.lit(0)))
    gone = F.expr("number * above div drawn")
    kept = kept.where(F.expr("(number + 1) * above div drawn") == gone).select(
        "src", "blocks", "shard", (F.col("number") - gone).alias("slot"))
    shards = F.expr(f"(total - 1) div {shard_slots} + 1")
    lacking = quota.withColumn("total", F.sum("quota").over(Window.partitionBy(F.lit(0)))).withColumn(
        "lack", F.col("quota") - F.col("drawn"))
    added = _spread(lacking, F.col("lack") - 1, "extra").withColumn("shards", shards).select(
        "src", "blocks", F.expr("extra * shards div lack").alias("shard"), (F.col("drawn") + F.col("extra")).alias("slot"))
    every = kept.unionByName(added).withColumn("epoch", F.expr("slot div blocks").cast("int"))
    return every.select("src", "slot", "shard", "epoch", _permuted(
        F.col("slot") % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), "src", "epoch")).alias("block"))


def _permuted(i: Column, n: Column, key: Column) -> Column:
    """Place of ``i`` in a pseudorandom permutation of 0 .. n - 1, for any n, by swap-or-not rounds.

    A round pairs each place with the one as far below the round's number as it is above 0 (modulo n), and a bit
    hashed from the larger of both tells whether the two change places (Hoang, Morris and Rogaway, 2012).
    """
    def turn(at: Column, number: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, number), n) - at, n)
        swap = F.xxhash64(key, number, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i.cast("long"), turn)


def shard_counts(drawn: DataFrame) -> DataFrame:
    """(``shard``, ``src``, ``n_blocks``): how many blocks of each source a shard holds."""
    return drawn.groupBy("shard", "src").agg(F.count("*").alias("n_blocks"))


def mixed_pieces(sizes: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """All pieces of documents in the mix: ``pieces`` with ``epoch``, the time the source is gone through."""
    rows = pieces(numbered(sizes, sources), block_words)
    drawn = slots(sources, block_words, seed).select("src", "block", "epoch", "shard")
    return rows.join(drawn.hint("merge"), ["src", "block"])  # else few sources would pass for few slots


def mix(df: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 0, doc_id: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """(``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``, ``shard``) of each document.

    ``shard`` is the first output shard that holds words of it, NULL where nothing is taken.
    """
    sizes = sized(df, doc_id, source, text)
    sources = cut(targets(sizes))
    times = slots(sources, block_words, seed).groupBy("src", "block").agg(
        F.count("*").alias("times"), F.min("shard").alias("shard"))
    # The planner takes slots, made from few sources, for few rows: without the hint it would broadcast them all.
    rows = pieces(numbered(sizes, sources), block_words).join(times.hint("merge"), ["src", "block"])
    taken = rows.groupBy(*DOCUMENT).agg(F.sum(F.col("n_words") * F.col("times")).alias("taken"),
                                        F.min("shard").alias("shard"))
    left, right = sizes.alias("a"), taken.hint("merge").alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in DOCUMENT]
    each = left.join(right, same, "left").select("a.*", F.coalesce("b.taken", F.lit(0)).alias("taken"), "b.shard")
    each, about = each.alias("a"), sources.alias("s")
    return each.join(about, F.col("a.source").eqNullSafe(F.col("s.source"))).select(
        "a.doc_id", "a.source", "a.size", "s.source_size", "s.target", "a.taken", "a.shard")


def _keys(names: list[str], doc_id: str, mark: Column, source: str) -> list[Column]:
    return [c.alias(n) for c, n in zip((F.coalesce(F.col(doc_id), F.lit(0)).cast("long"), mark,
                                        F.xxhash64(source, F.isnull(doc_id))), names, strict=True)]


def mixed_documents(df: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 0, doc_id: str = "doc_id",
                    source: str = "source", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The mix as rows of ``df``: for each time that a source is gone through, a document's words that are taken.

    Words keep the white space behind them; ``n_chars`` is counted anew. What is not taken has no row.
    """
    sizes = sized(df, doc_id, source, text)
    sources = cut(targets(sizes))
    taken = mixed_pieces(sizes, sources, block_words, seed)
    spans = taken.groupBy(*DOCUMENT, "epoch").agg(
        F.sort_array(F.collect_list(F.struct("first", "n_words"))).alias("spans"))
    # One key without NULLs for both steps, so that texts are shuffled once.
    *key, parts, words = fresh(df, "_id", "_mark", "_of", "_spans", "_words")
    spans = spans.select(F.col("spans").alias(parts), *_keys(key, "doc_id", F.col("mark"), "source"))
    marked = df.select("*", *_keys(key, doc_id, F.xxhash64(text), source)).dropDuplicates(key)
    # As a generated column the words are found once a row; as a projected one they would be once a span.
    rows = marked.join(spans.hint("merge"), key).select(
        "*", F.explode(F.array(words_of(text, _WORD_AND_SPACE))).alias(words))
    whole = F.array_join(F.transform(parts, lambda s: F.array_join(
        F.slice(words, (s["first"] + 1).cast("int"), s["n_words"].cast("int")), "")), "")
    rows = rows.withColumn(text, whole)
    if n_chars in df.columns:
        rows = rows.withColumn(n_chars, F.length(text).cast(df.schema[n_chars].dataType))
    return rows.select(*df.columns)
