"""Toxicity scores from a learned lexicon that also catches misspelled terms.

The lexicon is learned from labelled texts: words and word stems that occur almost only in toxic ones. It is kept as
a trie; a Levenshtein automaton is run along it, so a word is looked up in all entries at once and within one edit of
long words. The states of that intersection are made when first met and remembered. Each hit is then judged in a window
of words: whether it stands between quotation marks, and how many other hits are near. A logistic regression over these
figures, fitted on the same labelled texts, gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import add_text_columns, id_crc32, utf8, written

FOLDS, HELD_OUT = 5, 0
SAMPLE_EACH = 6000  # labelled documents of each label that are learned from
STEM = range(4, 8)  # lengths of stems
FUZZY_FROM = 6  # words of so many letters are also found within one edit
CHANCE = 1e-4  # of an entry of that frequency having met toxic texts alone by luck
WINDOW = 6
_WORD = re.compile(r"\w+")
_PART = re.compile(r"\w+|[\"“”„«»]")
_MARKS = frozenset("\"“”„«»")


class Lexicon:
    """Entries ``(text, is_stem, weight)`` as a trie, intersected with the automaton of one edit as words come."""

    def __init__(self, entries: tuple[tuple[str, bool, float], ...], clean: frozenset[str] = frozenset()):
        self.clean = clean  # known harmless words, which are no misspellings
        self.children: list[dict[str, int]] = [{}]
        self.word: list[float] = [0.0]
        self.stem: list[float] = [0.0]
        self.depth = [0]
        for text, is_stem, weight in entries:
            node = 0
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.word.append(0.0)
                    self.stem.append(0.0)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[node][letter]
            (self.stem if is_stem else self.word)[node] = weight
        self.deepest = [0] * len(self.children)
        for node in range(len(self.children) - 1, -1, -1):
            own = self.depth[node] if self.word[node] else 0
            self.deepest[node] = max([own, *(self.deepest[c] for c in self.children[node].values())])
        start = self._closed({(0, 0)})
        self.sets = [start]
        self.numbers = {start: 0}
        self.moves: list[dict[str, int]] = [{}]
        self.ends = [self._end(start)]
        self.begun = [self._begun(start)]

    def _closed(self, states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """With the letters that the word may lack; an edit is only spent where a long word can still end."""
        out = set(states)
        for node, edits in states:
            if edits == 0:
                out |= {(c, 1) for c in self.children[node].values() if self.deepest[c] >= FUZZY_FROM}
        return frozenset(out)

    def _end(self, states: frozenset) -> tuple[float, bool]:
        exact = max((self.word[n] for n, e in states if e == 0), default=0.0)
        near = max((self.word[n] for n, e in states if e == 1 and self.depth[n] >= FUZZY_FROM), default=0.0)
        return (exact, False) if exact else (near, near > 0)

    def _begun(self, states: frozenset) -> float:
        return max((self.stem[n] for n, e in states if e == 0), default=0.0)

    def _step(self, state: int, letter: str) -> int:
        out = set()
        for node, edits in self.sets[state]:
            if letter in self.children[node]:
                out.add((self.children[node][letter], edits))
            if edits == 0 and self.deepest[node] >= FUZZY_FROM:
                out.add((node, 1))
                out |= {(c, 1) for c in self.children[node].values() if self.deepest[c] >= FUZZY_FROM}
        states = self._closed(out)
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            self.ends.append(self._end(states))
            self.begun.append(self._begun(states))
        self.moves[state][letter] = self.numbers[states]
        return self.numbers[states]

    def find(self, word: str) -> tuple[float, bool]:
        """Weight of the best entry (0: none), and whether the word is only near it."""
        state, begun = 0, 0.0
        for letter in word:
            to = self.moves[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if not self.sets[state]:
                return begun, False
            begun = max(begun, self.begun[state])
        weight, near = self.ends[state]
        if begun >= weight or near and (begun or word in self.clean):
            return begun, False
        return weight, near


FEATURES = 7


def features(text: str, lexicon: Lexicon, memo: dict[str, tuple[float, bool]]) -> list[float]:
    """Constant, plain weight, quoted weight, misspelled weight, most hits in a window, share of hits, length."""
    lower = text.lower()
    words = _WORD.findall(lower)
    hit = False
    for word in set(words):
        found = memo.get(word)
        if found is None:
            if len(memo) > 400_000:
                memo.clear()
            found = memo[word] = lexicon.find(word)
        hit = hit or found[0] > 0
    length = log(1 + len(words)) / 10
    if not hit:
        return [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, length]
    plain = quoted = near = 0.0
    places, at, marks, hits = [], 0, [], []
    for part in _PART.findall(lower):
        if part in _MARKS:
            marks.append(at)
            continue
        weight, fuzzy = memo.get(part) or lexicon.find(part)
        if weight:
            places.append(at)
            hits.append((weight, fuzzy))
        at += 1
    # A hit is quoted if marks stand within the window on either side; both lists are in order.
    marks_, places_ = np.array(marks, np.int64), np.array(places)
    here = np.searchsorted(marks_, places_, side="right")
    before = here > np.searchsorted(marks_, places_ - WINDOW)
    after = here < np.searchsorted(marks_, places_ + WINDOW + 1, side="right")
    for (weight, fuzzy), between in zip(hits, (before & after).tolist(), strict=True):
        if between:
            quoted += weight
        elif fuzzy:
            near += weight
        else:
            plain += weight
    close = int((np.searchsorted(places_, places_ + WINDOW, side="right") - np.searchsorted(places_, places_ - WINDOW)).max())
    return [1.0, log(1 + plain), log(1 + quoted), log(1 + near), log(1 + close), log(1 + 100 * len(hits) / len(words)), length]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(y) + penalty * 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty * 0.1 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@lru_cache(maxsize=2)
def _lexicon(entries: tuple, clean: frozenset) -> tuple[Lexicon, dict]:
    return Lexicon(entries, clean), {}


def _decoded(texts: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace") for t in texts]


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str, each: int = SAMPLE_EACH) -> DataFrame:
    """``id, text, toxic`` of up to ``each`` documents a label, picked by a hash of the id. The bound makes all that is learned from small.

    An id with several labels counts as toxic if one says so; of several texts with one id, the first in order is taken.
    Each task leaves out the ids whose hash is surely too high, so only about the bound is ranked in one place.
    """
    known = labels.where(F.col(toxic).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(toxic).alias("toxic"))
    known = known.withColumn("hash", F.xxhash64(F.lit("toxic"), F.col("id")))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {x: min(1.0, (each + 10 * each**0.5 + 10) / n) for x, n in sizes.items()}
    below = F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    low = known.where(F.col("hash") / float(1 << 64) + 0.5 <= below)
    lot = Window.partitionBy("toxic").orderBy("hash", "id")
    chosen = low.withColumn("n", F.row_number().over(lot)).where(F.col("n") <= each).select("id", "toxic")
    chosen = written(chosen, "chosen")
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(chosen, "id")
    return written(rows.groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "sample")


def _term_counts(sample: DataFrame) -> DataFrame:
    """``term, stem, bad, good``: in how many texts of either label a word, or a stem, occurs."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text, toxic in zip(_decoded(utf8(batch.column("text"))), batch.column("toxic").to_pylist(), strict=True):
                words = set(_WORD.findall(text.lower()))
                counts.update((w, False, toxic) for w in words)
                counts.update((s, True, toxic) for s in {w[:n] for w in words for n in STEM if len(w) >= n})
            keys = list(counts)
            number = np.array([counts[k] for k in keys], np.int64)
            bad = np.array([k[2] for k in keys], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array(number * bad), pa.array(number * (1 - bad))],
                names=["term", "stem", "bad", "good"],
            )

    rows = sample.select("text", F.col("toxic").cast("bigint").alias("toxic")).mapInArrow(step, "term STRING, stem BOOLEAN, bad BIGINT, good BIGINT")
    return rows.groupBy("term", "stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _without_longer_stems(terms: DataFrame) -> DataFrame:
    """``terms`` without stems that begin with another of its stems."""
    stems = terms.where("stem")
    begins = F.explode(F.array(*[F.when(F.length("term") > n, F.substring("term", 1, n)) for n in STEM]))
    longer = stems.select("term", begins.alias("begin")).join(stems.select(F.col("term").alias("begin")), "begin")
    return terms.join(longer.select("term", F.lit(True).alias("stem")), ["term", "stem"], "left_anti").select(*terms.columns)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> dict:
    """The model: lexicon, harmless near-misses and regression weights. All terms that pass the test are entries; the sample bounds
    them and all else that comes to the driver."""
    sample = labelled_sample(docs, labels, doc_id, text, toxic)
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {"entries": (), "clean": frozenset(), "weights": [20.0 if bad else -20.0] + [0.0] * (FEATURES - 1)}
    least = max(3, int(np.ceil(log(CHANCE) / log(bad / (bad + good)))))
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    counts = written(_term_counts(sample).withColumn("weight", weight), "terms")
    fit_for = counts.where((F.col("bad") >= least) & (F.col("weight") >= 4))
    rows = _without_longer_stems(fit_for).collect()
    stems = {r.term: r.weight for r in sorted((r for r in rows if r.stem), key=lambda r: (len(r.term), r.term))}
    entries = tuple((t, True, w) for t, w in stems.items()) + tuple((r.term, False, r.weight) for r in sorted(rows) if not r.stem)
    model = {"entries": entries, "clean": frozenset(), "weights": []}
    met = counts.where("not stem and good > 0 and length(term) >= 4").select("term")
    near = met.mapInArrow(lambda batches: (_near(b, entries) for b in batches), "term STRING").collect()
    model["clean"] = frozenset(r.term for r in near)
    figures = add_text_columns(sample.select("toxic", "text"), "text", "x ARRAY<DOUBLE>", lambda texts: [pa.array(_all_features(texts, model), pa.list_(pa.float64()))])
    rows = figures.collect()
    model["weights"] = fit(np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)).tolist()
    return model


def _near(batch: pa.RecordBatch, entries: tuple) -> pa.RecordBatch:
    lexicon, _ = _lexicon(entries, frozenset())
    return pa.RecordBatch.from_arrays([pa.array([w for w in batch.column(0).to_pylist() if lexicon.find(w)[1]], pa.string())], names=["term"])


def _all_features(texts: list[bytes], model: dict) -> list[list[float]]:
    lexicon, memo = _lexicon(model["entries"], model["clean"])
    return [features(t, lexicon, memo) for t in _decoded(texts)]


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id>, score, predicted`` for every row: score 0 to 1, and 1 where it is at least 0.5.

    A null text is scored as an empty one. Rows and ids may repeat or be null; other columns are not looked at; an
    empty table gives an empty result. Only the text bears on a score.
    """

    def values(texts: list[bytes]) -> list[pa.Array]:
        x = np.array(_all_features(texts, model)).reshape(-1, FEATURES) @ np.array(model["weights"])
        return [pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))]

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    scored = add_text_columns(rows, "body", "score DOUBLE", values)
    return scored.select(F.col("id").alias(doc_id), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out(doc_id: str):
    return F.coalesce(F.pmod(id_crc32(doc_id), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def with_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """Learn from the labels of the training folds and score all rows: ``<doc_id>, held_out, score, predicted``.

    Rows without an id are held out. Without labels of both kinds every score is that of the only kind, or near 0.
    """
    model = learn(docs.where(~held_out(doc_id)), labels.where(~held_out(doc_id)), doc_id, text, toxic)
    return score(docs, model, doc_id, text).select(doc_id, held_out(doc_id).alias("held_out"), "score", "predicted")
