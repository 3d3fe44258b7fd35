"""Toxicity scores: a learned lexicon trie met by Levenshtein automata, and context windows around its hits.

Fitting. From labelled rows (a bounded sample of either label, ``MAX_ROWS``) Spark counts in how many toxic and
clean texts every word and word beginning occurs once, twice and more. What is all but confined to toxic texts,
at one of these counts, is a term: a whole word, or a stem if its endings vary. Terms are few (``MAX_TERMS``)
and go to every task.

Scoring. The terms form a trie, and a word is read against all of them at once: a state is the set of trie nodes
that are within reach with the edits spent so far, the product of the trie and one Levenshtein automaton a term,
made into a deterministic automaton as words need it. Edits allowed grow with the term; stems, whose endings are
free, allow none. What stands between white space is also read whole if digits or signs replace
letters in it. A word that is not the term itself counts less, and not at all if the sample has it in clean
texts. Every hit is weighed by the words
around it: a hit between quotation marks or behind a word of reporting is quoted, one near a second person is
aimed at somebody. A logistic model over the sums, fitted on the sample, gives the score.

Rows: NULL counts as empty; a text without hits has the model's lowest score; rows with equal text have equal
scores, and a fit gives the same model however rows are dealt; without labels of both kinds the lexicon is empty and every score is that of a toxic share of zero; an
empty table gives an empty table. Columns called like a result are replaced, all others but the text stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.shared import cut, slices

#: Labelled texts of either label that the model is fitted on, at most, and terms of the lexicon.
MAX_ROWS, MAX_TERMS = 6_000, 2_000
#: A term occurs in this share of toxic texts at least, and in so few clean ones for each toxic one.
LEAST_SHARE, CLEAN_PER_TOXIC = 0.01, 0.05
#: Chance that a word without a meaning is found in that many toxic texts and no clean one, at most.
CHANCE = 1e-7
#: Shortest stem, and longest.
STEMS = range(4, 11)
#: Occurrences in a text that are told apart: one, two, and so on up to this many or more.
LEVELS = 3
#: What a hit is worth for each edit that it takes.
PER_EDIT = 0.35
#: Words on either side of a hit that tell how it is meant.
WINDOW = 5
#: Words a Python worker remembers, and states of the automaton, before it starts afresh.
_CACHE, _STATES = 300_000, 50_000

_LETTERS = re.compile(r"[^\W\d_]+")
#: Around a token, and a token with letters first or last and a few digits or signs among them, as in "w0rd", "w*rd".
_OUTER = re.compile(r"^[^\w*@$!]+|[^\w*@$]+$")
_MIXED = re.compile(r"(?=.*[^\W\d_].*[^\W\d_])\w*(?:[\d*@$!#_]\w*){1,3}")
_LONGEST = 40
_QUOTES = frozenset("\"“”„‟«»‹›")
#: Words of reporting and of address, in the four languages of the corpus (fixed values).
REPORTING = frozenset("said says say wrote called calls quote quoted term word words reported dit disait écrit mot "
                      "mots sagte sagt schrieb wort worte nannte dijo dice escribió palabra llamó".split())
SECOND_PERSON = frozenset("you your yours yourself u ur tu toi vous ton votre du dich dir dein ihr euch sie tú usted "
                          "ustedes vos eres".split())


@dataclass
class Lexicon:
    """Terms with their weights at one hit, two, ...; a stem ends in ``*``. ``plain``: near misses of clean texts."""

    terms: dict[str, tuple[float, ...]] = field(default_factory=dict)
    plain: frozenset[str] = frozenset()
    model: tuple[float, ...] = (-6.0, 0.0, 0.0, 0.0, 0.0)


def edits(term: str) -> int:
    """Edits that a misspelling of a term may have."""
    return 0 if term.endswith("*") or len(term) < 4 else 1 if len(term) < 9 else 2


def spelt(token: str) -> Iterator[str]:
    """The words of what stands between white space, and all of it if signs or digits replace letters inside."""
    yield from _LETTERS.findall(token)
    whole = "" if token.isalpha() else _OUTER.sub("", token)
    if len(whole) <= _LONGEST and not whole.isalpha() and _MIXED.fullmatch(whole):
        yield whole


class Automaton:
    """Words read against all terms at once; states are made when a word first needs them."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[str, int]]] = [[]]
        self.stems: list[list[tuple[str, int]]] = [[]]
        reach = [0]
        for term in terms:
            node = 0
            for c in term.removesuffix("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.stems.append([])
                    reach.append(0)
                reach[node] = max(reach[node], edits(term))
                node = self.children[node][c]
            reach[node] = max(reach[node], edits(term))
            (self.stems if term.endswith("*") else self.ends)[node].append((term, edits(term)))
        self.reach = reach
        self.start = self._closed({0: 0})
        self.steps: dict[tuple, dict[str, tuple]] = {}

    def _closed(self, state: dict[int, int]) -> tuple:
        """A state with all nodes that are reached by leaving out letters of a term."""
        todo = list(state.items())
        while todo:
            node, spent = todo.pop()
            for child in self.children[node].values():
                if spent + 1 <= self.reach[child] and spent + 1 < state.get(child, 99):
                    state[child] = spent + 1
                    todo.append((child, spent + 1))
        return tuple(sorted(state.items()))

    def _step(self, state: tuple, c: str) -> tuple:
        known = self.steps.setdefault(state, {})
        if c in known:
            return known[c]
        found: dict[int, int] = {}

        def reach(node: int, spent: int) -> None:
            if spent <= self.reach[node] and spent < found.get(node, 99):
                found[node] = spent

        for node, spent in state:
            reach(node, spent + 1)  # a letter too many
            for letter, child in self.children[node].items():
                reach(child, spent + (letter != c))
        if len(self.steps) > _STATES:
            self.steps.clear()
            known = self.steps.setdefault(state, {})
        known[c] = self._closed(found)
        return known[c]

    def match(self, word: str) -> tuple[str, int] | None:
        """The term that needs fewest edits to become ``word``, or its beginning in the case of a stem."""
        best: tuple[int, str] | None = None
        state = self.start
        for i, c in enumerate(word):
            state = self._step(state, c)
            if not state:
                break
            last = i + 1 == len(word)
            for node, spent in state:
                for term, allowed in self.stems[node] + (self.ends[node] if last else []):
                    if spent <= allowed and (best is None or (spent, term) < best):
                        best = (spent, term)
        return (best[1], best[0]) if best else None


class Scorer:
    """A lexicon ready to read texts."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, Automaton(sorted(lexicon.terms))
        self.known: dict[str, list[tuple[str, int]] | None] = {}

    def token(self, token: str) -> list[tuple[str, int]] | None:
        """Terms, with the edits they take, that the words of what stands between white space hit."""
        hits = [(m, w) for w in spelt(token.lower()) if (m := self.automaton.match(w))]
        return [m for m, w in hits if not m[1] or w not in self.lexicon.plain] or None

    def weight(self, hits: dict[str, list[int]], term: str) -> float:
        """What a term's hits are worth, given the edits of each."""
        exact = hits[term].count(0)
        levels = self.lexicon.terms[term]
        return levels[min(exact, LEVELS) - 1] if exact else levels[0] * PER_EDIT ** min(hits[term])

    def features(self, text: str) -> tuple[list[float], list[str]]:
        """Of one text: weights of plain terms, of quoted ones, of aimed ones, the heaviest plain one; its terms."""
        tokens = text.split()
        found = set(tokens)
        if len(self.known) > _CACHE:
            self.known = {t: h for t, h in self.known.items() if h}
        known = self.known
        for t in found:
            if t not in known:
                known[t] = self.token(t)
        if not any(map(known.__getitem__, found)):
            return [0.0, 0.0, 0.0, 0.0], []
        plain: dict[str, list[int]] = {}
        quoted: dict[str, list[int]] = {}
        aimed: dict[str, list[int]] = {}
        for i, t in enumerate(tokens):
            if (hits := known[t]) is None:
                continue
            before, after = tokens[max(0, i - WINDOW):i], tokens[i + 1:i + 1 + WINDOW]
            told = self.is_quoted(before, t, after)
            personal = not told and any(w.strip(".,;:!?").lower() in SECOND_PERSON for w in before + after)
            for term, spent in hits:
                (quoted if told else plain).setdefault(term, []).append(spent)
                if personal:
                    aimed.setdefault(term, []).append(spent)
        sums = [sum(self.weight(h, t) for t in h) for h in (plain, quoted, aimed)]
        return [*sums, max((self.weight(plain, t) for t in plain), default=0.0)], sorted({*plain, *quoted})

    @staticmethod
    def is_quoted(before: list[str], token: str, after: list[str]) -> bool:
        """Whether quotation marks stand on both sides of a hit, or a word of reporting close before it."""
        opened = any(c in _QUOTES for w in before for c in w) or token[0] in _QUOTES
        closed = any(c in _QUOTES for w in after for c in w) or token[-1] in _QUOTES
        told = any(w.strip(".,;:!?\"“”«»").lower() in REPORTING for w in before[-3:])
        return opened and closed or told

    def score(self, features: list[float]) -> float:
        z = self.lexicon.model[0] + float(np.dot(self.lexicon.model[1:], _scaled(features)))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def _scaled(features: list[float]) -> np.ndarray:
    return np.log1p(np.asarray(features, float))


def is_held_out(doc_id: str) -> Column:
    """Rows whose CRC-32 of the id as text leaves 1 when divided by 3; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, max_rows: int) -> DataFrame:
    """(``text``, ``toxic``): labelled texts that may be learned from, copies once, at most ``max_rows`` of a label."""
    rows = (labels.where(F.col("toxic").isNotNull() & F.col(doc_id).isNotNull() & ~is_held_out(doc_id))
            .groupBy(doc_id).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    picked = [rows.where(F.col("toxic") == label).orderBy(F.xxhash64(doc_id), doc_id).limit(max_rows)
              for label in (0, 1)]
    few = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * max_rows rows of two numbers
    texts = docs.select(F.col(doc_id), F.coalesce(text, F.lit("")).alias("text")).join(few, doc_id)
    marked = texts.select(F.col(doc_id).alias("id"), "text", "toxic").mapInArrow(
        _marked, T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("text", T.StringType()),
                               T.StructField("toxic", T.IntegerType()), T.StructField("mark", T.LongType())]))
    # Which of a group stays hangs on its rows alone, so that a fit gives the same model however rows are dealt.
    least = F.min(F.struct("id", F.xxhash64("text").alias("hash"), "text")).alias("row")
    return marked.groupBy("mark", "toxic").agg(least).select("row.text", "toxic")


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the smallest hash of their word triples, which most near copies share: those count once."""
    from xxhash import xxh3_64_intdigest

    for batch in batches:
        marks = []
        for words in (t.split() for t in batch.column("text").to_pylist()):
            triples = zip(words, words[1:], words[2:], strict=False)
            marks.append(min((xxh3_64_intdigest(" ".join(t)) >> 1 for t in triples),
                             default=xxh3_64_intdigest(" ".join(words)) >> 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("text"), batch.column("toxic"), pa.array(marks, pa.int64())],
            ["id", "text", "toxic", "mark"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS) -> Lexicon:
    """Terms, near misses and weights from the labelled rows that are not held out."""
    texts = cut(sample(docs, labels, doc_id, text, max_rows))
    counts = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return Lexicon()
    terms = _terms(texts, toxic, clean, max_terms)
    lexicon = Lexicon(terms, _near_misses(texts, terms))
    rows = sorted((r["toxic"], r["f"]) for r in
                  texts.mapInArrow(_featured(lexicon), "toxic int, f array<double>").collect())  # max_rows bounds it
    lexicon.model = _logistic([f for _, f in rows], [label for label, _ in rows])  # sums in one order in every run
    return lexicon


def _terms(texts: DataFrame, toxic: int, clean: int, max_terms: int) -> dict[str, tuple[float, ...]]:
    """What all but never occurs so often in clean texts: words, or stems if that gathers many endings."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            seen: Counter[tuple[str, int, int]] = Counter()
            for whole, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = Counter(_LETTERS.findall(whole.lower()))
                stems: Counter[str] = Counter()
                for w, n in words.items():
                    for k in STEMS:
                        if len(w) >= k:
                            stems[w[:k] + "*"] += n
                for times in (words, stems):
                    for w, n in times.items():
                        for level in range(1, min(n, LEVELS) + 1):
                            seen[w, label, level] += 1
            yield pa.RecordBatch.from_pydict(
                {"term": [k[0] for k in seen], "toxic": pa.array([k[1] for k in seen], pa.int32()),
                 "level": pa.array([k[2] for k in seen], pa.int32()), "n": pa.array(list(seen.values()), pa.int64())})

    counted = texts.mapInArrow(count, "term string, toxic int, level int, n long").groupBy("term").agg(
        *(F.sum(F.when((F.col("toxic") == t) & (F.col("level") == k), F.col("n")).otherwise(0)).alias(f"{a}{k}")
          for a, t in (("a", 1), ("b", 0)) for k in range(1, LEVELS + 1)))
    least = float(max(LEAST_SHARE * toxic, np.log(CHANCE) / np.log(toxic / (toxic + clean))))
    rare = [(F.col(f"a{k}") >= least) & (F.col(f"b{k}") / clean <= CLEAN_PER_TOXIC * F.col(f"a{k}") / toxic)
            for k in range(1, LEVELS + 1)]
    found = {r["term"]: r for r in counted.where(reduce(Column.__or__, rare)).orderBy(
        F.desc("a1"), "term").limit(max_terms).collect()}
    kept: dict[str, tuple[float, ...]] = {}
    for term in sorted(found, key=lambda t: (len(t.removesuffix("*")), t.endswith("*"))):
        stem, n = term.removesuffix("*"), found[term]["a1"]
        longer = [t for t in found if t != term and t.startswith(stem) and found[t]["a1"] >= 0.9 * n]
        within = [k for k in kept if k.endswith("*") and stem.startswith(k[:-1]) or k == stem]
        if within or term.endswith("*") and longer:
            continue
        row = found[term]
        levels = [float(np.log((row[f"a{k}"] + 0.5) / (toxic + 1)) - np.log((row[f"b{k}"] + 0.5) / (clean + 1)))
                  for k in range(1, LEVELS + 1)]
        kept[term] = tuple(max(0.0, *levels[:k + 1]) if k else max(0.0, levels[0]) for k in range(LEVELS))
    return kept


def _near_misses(texts: DataFrame, terms: dict[str, tuple[float, ...]]) -> frozenset[str]:
    """Words of clean texts that the automaton takes for a misspelt term."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sorted(terms))
        for batch in slices(batches, "text"):
            words = {w for whole in batch.column("text").to_pylist() for t in set(whole.lower().split()) for w in spelt(t)}
            near = [w for w in words if (m := automaton.match(w)) and m[1]]
            yield pa.RecordBatch.from_pydict({"word": pa.array(near, pa.string())})

    rows = texts.where("toxic = 0").select("text").mapInArrow(find, "word string").distinct()
    return frozenset(r["word"] for r in rows.collect())  # words of max_rows texts at most


def _featured(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in slices(batches, "text"):
            rows = [scorer.features(t)[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"),
                                              "f": pa.array(rows, pa.list_(pa.float64()))})

    return run


def _logistic(rows: list[list[float]], labels: list[int], ridge: float = 1e-2) -> tuple[float, ...]:
    """Weights of a logistic model over the scaled sums, by Newton's method; both labels count alike."""
    x = np.column_stack([np.ones(len(rows)), np.array([_scaled(r) for r in rows])])
    y = np.asarray(labels, float)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1e-3, *[1.0] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + penalty @ w
        hessian = x.T @ (x * (share * p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return tuple(float(v) for v in w)


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``df`` with ``score``, ``predicted`` (1 from ``threshold`` on) and ``toxic_terms`` in place of the text."""
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
             T.StructField("toxic_terms", T.ArrayType(T.StringType()))]
    kept = [f for f in df.schema if f.name != text and f.name not in {a.name for a in added}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in slices(batches, text):
            found = [scorer.features(t or "") for t in batch.column(text).to_pylist()]
            scores = [scorer.score(f) for f, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()),
                 pa.array([t for _, t in found], pa.list_(pa.string()))],
                [f.name for f in [*kept, *added]])

    return df.mapInArrow(run, T.StructType([*kept, *added]))


def clean_rows(df: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``df`` whose text scores below ``threshold``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in slices(batches, text):
            keep = [scorer.score(scorer.features(t or "")[0]) < threshold for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)
