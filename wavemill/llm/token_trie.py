"""Token counts by trie-shared dynamic programming.

A text's words, each with the word mark in front, are segmented into the pieces of a public vocabulary so that
the sum of the pieces' log-probabilities is largest (a unigram model). The best score of a prefix does not depend
on what follows, so the distinct words of a batch form a trie and a forward score is computed once for each of
its nodes, however many words share it. The trie is gone through in order of its words: what is held is the path
to the current word. At a node the pieces that end there are found by going back along the path for as long as what
was gone back over ends some piece. A terminal node stores its word's number of tokens and score, and texts add these up.

Log-probabilities: the vocabulary file has merge ranks, not frequencies; a piece of rank r is taken to be as
frequent as Zipf's law has it. A character without a piece is as many tokens as it has bytes.

Rows: NULL and empty texts count no words and no tokens; equal rows have equal counts; an empty table gives an
empty table. Columns called like a result are replaced, all others but the text stay.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wavemill.llm.shared import raw_texts, slices

MARK = "▁"
#: Words that a Python worker remembers before it starts afresh, and the length up to which it does.
CACHE_WORDS, CACHE_CHARS = 200_000, 64
#: Log-probability of a byte of a character that no piece has.
BYTE_SCORE = -20.0


class Unigram:
    """Pieces with log-probabilities, and the distinct words that have been segmented."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces = [i for i in range(model.get_piece_size()) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces.sort(key=lambda i: (-model.get_score(i), i))
        total = log(sum(1 / r for r in range(1, len(pieces) + 1)))
        self.pieces = {model.id_to_piece(i): -log(r) - total for r, i in enumerate(pieces, 1)}
        #: Whatever ends a piece; the score is None where it is no piece itself.
        self.endings: dict[str, float | None] = {p[i:]: None for p in self.pieces for i in range(1, len(p))} | self.pieces
        self.tokens: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    def segment(self, words: Iterable[str]) -> dict[str, tuple[int, float]]:
        """Tokens and score of each distinct word; forward scores are shared along the trie of the words."""
        ending = self.endings.get
        score, count, found = [0.0], [0], {}
        before = ""
        for word in sorted(words):
            marked = MARK + word
            shared = 0
            for a, b in zip(marked, before, strict=False):
                if a != b:
                    break
                shared += 1
            del score[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(marked) + 1):
                char = marked[end - 1]
                size = 1 if char < "\x80" else len(char.encode())
                best, tokens = score[-1] + BYTE_SCORE * size, count[-1] + size
                for start in range(end - 1, -1, -1):
                    p = ending(marked[start:end], 1.0)
                    if p is None:
                        continue
                    if p > 0:  # no piece ends so, nor with more in front
                        break
                    p += score[start]
                    if p > best or (p == best and count[start] + 1 < tokens):
                        best, tokens = p, count[start] + 1
                score.append(best)
                count.append(tokens)
            found[word] = (count[-1], score[-1])
            before = marked
        return found

    def learn(self, words: set[str]) -> None:
        """Take the results of these words into ``tokens`` and ``scores``; those that are new are segmented together."""
        if len(self.tokens) > CACHE_WORDS:
            self.tokens.clear()
            self.scores.clear()
        new = self.segment(words.difference(self.tokens))
        self.tokens.update({w: r[0] for w, r in new.items()})
        self.scores.update({w: r[1] for w, r in new.items()})

    def forget_long(self, words: set[str]) -> None:
        """Drop those of the words that are too long to be remembered."""
        for w in words:
            if len(w) > CACHE_CHARS:
                del self.tokens[w], self.scores[w]


@lru_cache(maxsize=1)
def unigram(path: str) -> Unigram:
    return Unigram(path)


def token_counts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_tokens`` and ``log_prob`` in place of its text."""
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType()),
             T.StructField("log_prob", T.DoubleType())]
    kept = [f for f in df.schema if f.name != text and f.name not in {a.name for a in added}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        for batch in slices(batches, text):
            texts = [[w.decode() for w in t.split()] for t in raw_texts(batch.column(text))]
            distinct = set().union(*texts)
            model.learn(distinct)
            tokens = [sum(map(model.tokens.__getitem__, words)) for words in texts]
            scores = [sum(map(model.scores.__getitem__, words)) for words in texts]
            model.forget_long(distinct)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(map(len, texts), pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())], [f.name for f in [*kept, *added]])

    return df.mapInArrow(run, T.StructType([*kept, *added]))
