"""Quality rules under weak supervision.

Rules look at a text's words, lines and signs and vote for good or bad, or abstain. Some only ever vote bad: that
a text shouts not is no sign that it is good, as there are many ways to be bad. Nobody says how far a rule is to
be trusted: expectation-maximisation finds for each rule how often it votes good, votes bad and abstains on good
texts and on bad ones, and the share of good texts, from how the rules agree over all rows. It works on the counts
of vote patterns, of which there are at most three to the power of the rules, and its result is a sum of log-odds,
one for each rule's vote.
A text is kept if its posterior probability to be good reaches a threshold and it does not fail the base rules.

Rows: NULL and empty texts have no words and fail the base rules; equal texts get equal verdicts; an empty table
gives an empty table. Columns called like a result are replaced, all others but the text stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.shared import cut, fresh, slices

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_NO_LETTER = bytes(b for b in range(128) if b not in _LETTERS and chr(b) not in _SPACES)
_ENDS = frozenset(".!?:;\"'»”)]")
#: The commonest words of the corpus' four languages (fixed values).
STOPWORDS = frozenset(w.encode() for w in (
    "the of and to in is that it for was on are as with be this from at by not or an "
    "der die und das den von zu mit ist des im für nicht ein eine sich auf dem als auch "
    "le la les des et du que un une dans est pour pas au par sur il qui en "
    "el los las de y del se por con para una no lo su al es").split())

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SHARES = ["upper", "with_letter", "stops", "distinct", "ended", "dup_lines", "loud"]

#: Rules: a measure, and what it has to reach or stay below to be good or bad; between the two a rule abstains.
RULES: dict[str, tuple[str, str, str]] = {
    "word_length": ("word_chars / n_words", "x between 3.5 and 7", "x < 2.5 or x > 8"),
    "stopwords": ("stops", "x >= 0.08", "x < 0.03"),
    "vocabulary": ("distinct * sqrt(n_words)", "x >= 6", "x < 3"),
    "line_ends": ("ended", "x >= 0.5", "x < 0.1"),
    "symbols": ("n_symbols / n_words", "false", "x > 0.1"),
    "repeats": ("n_repeat_words / n_words", "false", "x > 0.45"),
    "lines": ("dup_lines", "false", "x > 0.4"),
    "upper_case": ("upper", "false", "x > 0.3"),
    "letters": ("with_letter", "false", "x < 0.8"),
    "exclamation": ("loud", "false", "x > 0.3"),
}


def measures(text: str) -> tuple[list[int], list[float]]:
    """The counts and shares of one text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = text.split("\n")
    worded = [line for line in lines if line.strip(_SPACES)]
    dup = len(worded) - len(set(worded))
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    spelt = raw.translate(None, _NO_LETTER).split()
    stops = sum(map(STOPWORDS.__contains__, raw.translate(None, b".,;:!?").lower().split()))
    ended = sum(1 for line in worded if line.rstrip()[-1:] in _ENDS)
    of = max(1, n)
    shares = [(len(raw) - len(raw.translate(None, _UPPER))) / max(1, letters), len(spelt) / of, stops / of,
              len(set(words)) / of, ended / max(1, len(worded)), dup / max(1, len(worded)), text.count("!") / of]
    return [n, chars, symbols, dup, repeated_words(words)], shares


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which is found twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = 0
    until = 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 3 - max(i, until)
            until = i + 3
    return covered


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts and shares of its text in place of it."""
    added = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.DoubleType()) for c in _SHARES]
    kept = [f for f in df.schema if f.name != text and f.name not in {a.name for a in added}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = [measures(t or "") for t in batch.column(text).to_pylist()]
            columns = [pa.array([f[0][i] for f in found], pa.int64()) for i in range(len(COUNTS))]
            columns += [pa.array([f[1][i] for f in found], pa.float64()) for i in range(len(_SHARES))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *columns],
                                             [f.name for f in [*kept, *added]])

    return df.mapInArrow(run, T.StructType([*kept, *added]))


def vote(rule: str) -> Column:
    """1: good, -1: bad, 0: abstains; all rules abstain on a text without words."""
    measure, good, bad = (re.sub(r"\bx\b", f"({RULES[rule][0]})", part) for part in ("x", *RULES[rule][1:]))
    return F.expr(f"case when n_words = 0 then 0 when {good} then 1 when {bad} then -1 else 0 end")


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 500) -> tuple[float, list[dict[int, float]]]:
    """Log-odds of good before any vote, and what each rule's vote (1, -1 or 0) adds, from counted vote patterns.

    Texts start as good or bad by their votes, bad ones counting more. A vote for good never speaks for bad.
    """
    if not patterns:
        return 0.0, []
    votes = np.array([p for p, _ in patterns], int).reshape(len(patterns), -1)
    n = np.array([c for _, c in patterns], float)
    good = 1 / (1 + np.exp(-((votes == 1).sum(axis=1) - 3.0 * (votes == -1).sum(axis=1))))
    sides = (1, 0, -1)
    for _ in range(rounds):
        share = np.clip((n @ good + 1) / (n.sum() + 2), 1e-9, 1 - 1e-9)
        odds = {}
        for v in sides:
            a, b = (((weight @ (votes == v)) + 1) / (weight.sum() + 3) for weight in (n * good, n * (1 - good)))
            odds[v] = np.log(a / b)
        odds[1], odds[-1] = np.maximum(odds[1], 0), np.minimum(odds[-1], 0)
        gain = sum(np.where(votes == v, odds[v], 0).sum(axis=1) for v in sides)
        before, good = good, 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + gain, -50, 50)))
        if np.abs(good - before).max() < 1e-9:
            break
    return float(np.log(share / (1 - share))), [{v: float(odds[v][r]) for v in sides} for r in range(votes.shape[1])]


def judged(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``df`` with the counts, ``base_failed``, ``quality`` (the posterior) and ``kept`` in place of its text."""
    df = df.drop("base_failed", "quality", "kept")
    internal = {*_SHARES, *(f"_{r}" for r in RULES)}
    clashing = [c for c in df.columns if c != text and c.lower() in internal]
    aside = dict(zip(clashing, fresh(df, *(f"{c}_aside" for c in clashing)), strict=True))
    rows = cut(measured(df.withColumnsRenamed(aside), text))
    voted = rows.select("*", *(vote(r).alias(f"_{r}") for r in RULES))
    names = [f"_{r}" for r in RULES]
    counted = voted.groupBy(*names).count().collect()  # 3 ** len(RULES) rows at most
    prior, weights = estimate([(tuple(r[c] for c in names), r["count"]) for r in counted])
    odds = F.lit(prior)
    for name, w in zip(names, weights, strict=False):
        odds = odds + F.when(F.col(name) == 1, w[1]).when(F.col(name) == -1, w[-1]).otherwise(w[0])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged_rows = voted.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-odds)))
    rows = judged_rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).drop(*names, *_SHARES)
    return rows.withColumnsRenamed({new: old for old, new in aside.items()})
