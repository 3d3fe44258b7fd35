"""BPE encoding and decoding with a public tokenizer, by tree concatenation.

A text falls apart into pre-tokens, and most of them are short: those are encoded where their document
lies, each distinct one once per batch. What has no place to split, a run of thousands of letters, is cut
in halves until each is short enough, the halves are rows that any task may encode, and neighbours are
concatenated again as a tree. At each join a window of tokens around it is encoded anew; it grows until
its first token is the left side's own and its last token the right side's own. Merges run in order of
rank, so a row of tokens is the encoding of its text exactly if every two neighbours are the encoding of
theirs: agreement at both ends of the window makes the joined row exact.

Rows: a NULL text counts as empty, an empty text has no tokens and decodes to the empty text; equal rows
each get their own result; an empty table gives an empty table. Columns that are already called like a
result are replaced, all others but the text stay.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.shared import fresh, slices

#: Longest piece of unsplit text that one task encodes as a whole, in characters of the text.
LEAF_CHARS = 16_384
#: Tokens on either side of a join that the first window covers; it doubles until both sides agree.
WINDOW = 4
#: Distinct pieces between white space that a Python worker remembers before it starts afresh, and their length.
CACHE_CHUNKS, CACHE_CHARS = 200_000, 64

#: Letters, digits, an apostrophe with its ending, other signs: the tokenizer's own alternatives, which differ in
#: their first character, in the order that is met most.
_PIECES = regex.compile(r"\p{L}+|\p{N}|'(?:s|t|re|ve|m|ll|d)|[^\s\p{L}\p{N}]+")
_KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: All but characters on which Python's Unicode tables and white space agree with the tokenizer's; other texts
#: take its own rules.
_COMMON = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u0557\u2010-\u2027\u2030-\u205e\u3001-\u9fbf\uac00-\ud7a3]")
_WORD_END = "</w>"


class Codec:
    """One tokenizer file, opened: pre-tokens, their ids, joins of encoded halves, decoding."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer, models, pre_tokenizers

        whole = Tokenizer.from_file(path)
        spec = json.loads(whole.to_str())
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != _KNOWN_PATTERN:
            raise ValueError(f"{path} divides texts in another way than this operator knows")
        vocab = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        bytelevel = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.ending, self.open = (
            Tokenizer(models.BPE(vocab=vocab, merges=merges, **suffix))
            for suffix in ({"end_of_word_suffix": _WORD_END}, {}))
        self.ending.pre_tokenizer = self.open.pre_tokenizer = bytelevel
        self.token = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for text, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = text
        self.cache: dict[str, bytes] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """Normalised pre-tokens of a text without special tokens."""
        if _COMMON.search(text):
            normal = self.normalizer.normalize_str(text)
            return [normal[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(normal)]
        return _PIECES.findall(unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower())

    def parts(self, text: str) -> list[str]:
        """Special tokens, and the texts between them."""
        return [p for p in self.special_parts.split(text) if p] if "<|" in text else [text] if text else []

    def chunks(self, part: str) -> list[str]:
        """What a text without special tokens can be cut into without a change: at white space, else not at all."""
        return [part] if _COMMON.search(part) else part.split()

    def words_ids(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens, as bytes of int32."""
        out: list[bytes] = []
        for at in range(0, len(words), 4096):
            found = self.ending.encode_batch_fast(words[at:at + 4096], add_special_tokens=False)
            out += [np.array(e.ids, np.int32).tobytes() for e in found]
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each as bytes of int32."""
        split = [[[p] if p in self.special else self.chunks(p) for p in self.parts(t)] for t in texts]
        if len(self.cache) > CACHE_CHUNKS:
            self.cache.clear()
        if not self.cache:
            self.cache.update({content: np.int32(i).tobytes() for content, i in self.special.items()})
        new = {c for parts in split for chunks in parts for c in chunks if c not in self.cache}
        cut = {c: self.pre_tokens(c) for c in new}
        words = list({w for ws in cut.values() for w in ws})
        ids = dict(zip(words, self.words_ids(words), strict=True))
        known = self.cache
        for c, ws in cut.items():
            known[c] = ids[ws[0]] if len(ws) == 1 else b"".join(map(ids.__getitem__, ws))
        out = [b"".join(known[c] for chunks in parts for c in chunks) for parts in split]
        for c in [c for c in new if len(c) > CACHE_CHARS]:
            del known[c]
        return out

    def leaf(self, piece: str, last: bool) -> list[int]:
        """Ids of a piece of one pre-token; only its last piece ends a word."""
        return (self.ending if last else self.open).encode(piece, add_special_tokens=False).ids

    def again(self, ids: list[int]) -> list[int]:
        """The encoding of the text that these neighbouring tokens of one pre-token spell."""
        spelt = "".join(map(self.token.__getitem__, ids))
        last = spelt.endswith(_WORD_END)
        model = (self.ending if last else self.open).model
        return [t.id for t in model.tokenize(spelt.removesuffix(_WORD_END) if last else spelt)]

    def join(self, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
        """The encoding of two neighbouring pieces from the encodings of both."""
        while left and right:
            a, b = left[-window:], right[:window]
            middle = self.again(a + b)
            if (len(a) == len(left) or middle[0] == a[0]) and (len(b) == len(right) or middle[-1] == b[-1]):
                return left[:len(left) - len(a)] + middle + right[len(b):]
            window *= 2
        return left + right

    def tree(self, pieces: list[list[int]]) -> list[int]:
        """All pieces of one pre-token, concatenated pair by pair and level by level."""
        while len(pieces) > 1:
            pairs = [self.join(*pieces[i:i + 2]) if i + 1 < len(pieces) else pieces[i]
                     for i in range(0, len(pieces), 2)]
            pieces = pairs
        return pieces[0] if pieces else []

    def decode(self, ids: list[int]) -> str:
        """The tokens' texts, special ones too, joined by one blank."""
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def halves(piece: str, leaf_chars: int) -> list[str]:
    """A piece cut in halves, and those again, until none is longer than ``leaf_chars``."""
    if len(piece) <= leaf_chars:
        return [piece]
    middle = len(piece) // 2
    return halves(piece[:middle], leaf_chars) + halves(piece[middle:], leaf_chars)


def _id_lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _with(batch: pa.RecordBatch, drop: str, **columns: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != drop and n not in columns]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *columns.values()], [*kept, *columns])


def _fields(df: DataFrame, drop: str, *added: T.StructField) -> T.StructType:
    names = {f.name for f in added}
    return T.StructType([f for f in df.schema if f.name != drop and f.name not in names] + list(added))


_IDS, _DECODED = T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())


def encode(df: DataFrame, path: str, text: str = "text", leaf_chars: int = LEAF_CHARS,
           decoded: bool = False) -> DataFrame:
    """``df`` with ``token_ids`` in place of its text column, and with their text ``decoded`` too if asked for."""
    # The longest piece between white space decides, found in one pass over the few texts that are long at all.
    pieces = F.split(F.when(F.length(text) > leaf_chars, F.col(text)), r"\s+")
    lengthy = F.coalesce(F.array_max(F.transform(pieces, F.length)) > leaf_chars, F.lit(False))
    long = _encode_long(df.where(lengthy), path, text, leaf_chars)
    return _encode_short(df.where(~lengthy), path, text, decoded).unionByName(decode(long, path) if decoded else long)


def _encode_short(df: DataFrame, path: str, text: str, decoded: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in slices(batches, text):
            ids = code.encode_many([x or "" for x in batch.column(text).to_pylist()])
            new = {"token_ids": _id_lists(ids)}
            if decoded:
                new["decoded"] = pa.array([code.decode(np.frombuffer(x, np.int32).tolist()) for x in ids], pa.string())
            yield _with(batch, text, **new)

    return df.mapInArrow(run, _fields(df, text, _IDS, *[_DECODED] * decoded))


def _encode_long(df: DataFrame, path: str, text: str, leaf_chars: int) -> DataFrame:
    """Texts that hold long unsplit runs: cut, encoded leaf by leaf in any task, joined by text."""
    key, = fresh(df, "key")
    keyed = df.withColumn(key, F.sha2(F.col(text), 256))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in slices(batches, "text"):
            for key, whole in zip(*(batch.column(c).to_pylist() for c in ("_key", "text")), strict=True):
                rows: list[tuple] = []
                for part in code.parts(whole):
                    if part in code.special:
                        rows.append((len(rows), [code.special[part]], None, True))
                        continue
                    short: list[str] = []
                    for w in [*code.pre_tokens(part), None]:
                        if w is not None and len(w) <= leaf_chars:
                            short.append(w)
                            continue
                        ids = b"".join(code.words_ids(short))
                        rows.append((len(rows), np.frombuffer(ids, np.int32).tolist(), None, True))
                        short = []
                        cuts = halves(w, leaf_chars) if w is not None else []
                        for i, piece in enumerate(cuts):
                            rows.append((len(rows), None, piece, i + 1 == len(cuts)))
                yield pa.RecordBatch.from_pydict(
                    {"_key": [key] * len(rows), "seq": [r[0] for r in rows], "ids": [r[1] for r in rows],
                     "leaf": [r[2] for r in rows], "last": [r[3] for r in rows]},
                    pa.schema([("_key", pa.string()), ("seq", pa.int32()), ("ids", pa.list_(pa.int32())),
                               ("leaf", pa.string()), ("last", pa.bool_())]))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            texts, lasts = batch.column("leaf").to_pylist(), batch.column("last").to_pylist()
            ids = [known if leaf is None else code.leaf(leaf, last) for leaf, last, known in
                   zip(texts, lasts, batch.column("ids").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"_key": batch.column("_key"), "seq": batch.column("seq"), "ids": pa.array(ids, pa.list_(pa.int32())),
                 "piece": pa.array([t is not None for t in texts]), "last": batch.column("last")})

    def joined(key: tuple, rows: pa.Table) -> pa.Table:
        code, out, pieces = codec(path), [], []
        for r in rows.sort_by("seq").to_pylist():
            if r["piece"]:
                pieces.append(r["ids"])
                if r["last"]:
                    out += code.tree(pieces)
                    pieces = []
            else:
                out += r["ids"]
        return pa.table({"_key": [key[0].as_py()], "token_ids": pa.array([out], pa.list_(pa.int32()))})

    cuts = (keyed.select(F.col(key).alias("_key"), F.col(text).alias("text")).dropDuplicates(["_key"])
            .mapInArrow(cut_up, "_key string, seq int, ids array<int>, leaf string, last boolean")
            .repartition("_key", "seq")
            .mapInArrow(leaves, "_key string, seq int, ids array<int>, piece boolean, last boolean"))
    ids = cuts.groupBy("_key").applyInArrow(joined, "_key string, token_ids array<int>")
    rows = keyed.drop(text, "token_ids")
    return rows.join(ids.withColumnRenamed("_key", key), key).drop(key)


def decode(df: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded``, the text of its ids; NULL decodes to the empty text, unknown ids are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            lists = batch.column(ids)
            for at in range(0, batch.num_rows, 256):
                part = lists.slice(at, 256)
                flat = pa.compute.list_flatten(part)
                least, most = pa.compute.min_max(flat).as_py().values()
                part = part.to_pylist()
                if flat.null_count or len(flat) and not 0 <= least <= most < len(code.token):
                    part = [[i for i in x or [] if i is not None and 0 <= i < len(code.token)] for x in part]
                texts = pa.array([code.decode(x or []) for x in part], pa.string())
                yield _with(batch.slice(at, 256), "", decoded=texts)

    return df.mapInArrow(run, _fields(df, "", _DECODED))
