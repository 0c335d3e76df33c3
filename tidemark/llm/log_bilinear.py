"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

Words fall into classes: the most frequent words are classes of their own, more of them the larger the vocabulary is,
the rest go by their ending, and the end of a text is a class. The model predicts a class from the two before it: the
context is a sum of their vectors, each scaled by its position, and a class scores by its product with the context plus
a bias. A word has the probability of its class times its smoothed share of that class, so all words together, one never
seen included, have probability 1.

Counts of words and of class triples are taken over all training text by Spark. Training runs in rounds on the table
of triples, which is dealt out and written once: steps are taken over each part of it, every triple with its whole
count, and the parameters are averaged; parts and steps grow with the table. A score is a sum of two parts, one for each
word of the context, so products of matrices, a block of rows at a time, give the normalisers of all contexts once in a
worker; they are the only table of pairs of classes. Tokens are split, numbered and classed by Arrow, a batch at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_text_columns, id_crc32, runs_of, utf8, written

FOLDS, HELD_OUT = 10, 0
SMOOTHING = 0.1
TOP_WORDS, ENDINGS, ENDING = 120, 128, 2  # of top words at least so many, and the square root of the number of words
FREQUENT = 400_000  # a word with this share of all tokens or more is kept by the workers: there are no more such words
WIDTH, NOISE, BATCH, STEPS, ROUNDS, PARTS = 24, 64, 2048, 250, 3, 6  # steps and parts at least; both grow with the triples
PART_TRIPLES = 1 << 20  # different triples in a part
END = b" "  # the end of a text; no word holds a blank
FLUSH = 200_000  # distinct words that a task counts before it passes them on
HELD_TRIPLES = 1 << 21  # triples that a task holds before it brings equal ones together and passes them on
ROWS, TOKENS = 256, 8192  # of the normalisers and of a text, worked out at a time


@dataclass(frozen=True)
class Classes:
    """Numbers of the classes: top words, endings, all other words, the end, and the start (a context only)."""

    words: tuple[bytes, ...]
    endings: tuple[bytes, ...]

    @property
    def other(self) -> int:
        return len(self.words) + len(self.endings)

    @property
    def end(self) -> int:
        return self.other + 1

    @property
    def start(self) -> int:
        return self.other + 2

    @property
    def size(self) -> int:
        return self.other + 3


@lru_cache(maxsize=2)
def _lookup(classes: Classes) -> tuple[pa.Array, pa.Array]:
    return pa.array(classes.words, pa.binary()), pa.array(classes.endings, pa.binary())


def tokens_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Tokens of all texts as numbers of distinct words, the place where each text begins, and the words. The last word is the end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).cast(pa.string())))
    flat = lists.flatten()
    real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # blanks at the ends leave empty ones
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())[real]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    sizes = np.bincount(owner, minlength=len(texts)) + 1
    begins = np.cumsum(sizes) - sizes
    codes = np.full(int(sizes.sum()), len(coded.dictionary), np.int64)
    codes[np.arange(len(owner)) + owner] = coded.indices.to_numpy()
    return codes, begins, pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])


def _own_classes(words: pa.Array, classes: Classes) -> np.ndarray:
    """The class of each of ``words``, the last of which is the end."""
    top, endings = _lookup(classes)
    tails = pc.binary_slice(words, -ENDING, None)
    by_word, by_ending = (pc.fill_null(pc.index_in(x, value_set=y), -1).to_numpy() for x, y in ((words, top), (tails, endings)))
    own = np.where(by_word >= 0, by_word, np.where(by_ending >= 0, by_ending + len(top), classes.other)).astype(np.int64)
    own[-1] = classes.end
    return own


def class_triples(codes: np.ndarray, begins: np.ndarray, words: pa.Array, classes: Classes) -> np.ndarray:
    """Per token the number of its triple: the classes of the two tokens before it and its own."""
    own = _own_classes(words, classes)[codes]
    first, second = np.roll(own, 2), np.roll(own, 1)
    first[begins] = second[begins] = classes.start
    after = begins + 1
    is_begin = np.zeros(len(own) + 1, bool)
    is_begin[begins] = True
    after = after[(after < len(own)) & ~is_begin[after]]
    first[after] = classes.start
    return (first * classes.size + second) * classes.size + own


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over the column ``text``; each task counts before anything is shuffled."""

    def flushed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in utf8(batch.column(0)):
                counts.update(tokens_of(text))
                if len(counts) > FLUSH:
                    yield flushed(counts)
                    counts = Counter()
        yield flushed(counts)

    return texts.select("text").mapInArrow(step, "word BINARY, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    triples, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(triples)
    triples, n = triples[order], n[order]
    begin = np.flatnonzero(np.r_[True, triples[1:] != triples[:-1]])
    return pa.RecordBatch.from_arrays([pa.array(triples[begin]), pa.array(np.add.reduceat(n, begin))], names=["triple", "n"])


def triple_counts(texts: DataFrame, classes: Classes) -> DataFrame:
    """``triple, n`` over the column ``text``: at most the cube of the number of classes."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            bodies = utf8(batch.column(0))
            for begin, end in runs_of(bodies):
                found, n = np.unique(class_triples(*numbered(bodies[begin:end]), classes), return_counts=True)
                held.append((found, n.astype(np.int64)))
                size += len(found)
                if size > HELD_TRIPLES:
                    yield _summed(held)
                    held, size = [], 0
        if held:
            yield _summed(held)

    return texts.select("text").mapInArrow(step, "triple BIGINT, n BIGINT").groupBy("triple").agg(F.sum("n").alias("n"))


def initial(classes: Classes, mass: np.ndarray) -> np.ndarray:
    """Parameters as one vector: context vectors, target vectors, two position scales, biases (log of each class's share)."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.1, 2 * classes.size * WIDTH)
    share = np.r_[mass, np.full(classes.size - len(mass), 1e-3)]
    return np.r_[vectors, np.ones(2 * WIDTH), np.log(share / share.sum())]


def _parts(params: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    cut = size * WIDTH
    return params[:cut].reshape(size, WIDTH), params[cut : 2 * cut].reshape(size, WIDTH), params[2 * cut : 2 * cut + 2 * WIDTH].reshape(2, WIDTH), params[2 * cut + 2 * WIDTH :]


def shares_of(n: np.ndarray, entries: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``n`` in random order, each at least once, and their weights, which add up to the counts.

    A count above the ``entries``-th part of all is dealt over several entries, so there are at most ``len(n) + entries``.
    """
    pieces = np.maximum(1, np.ceil(n * (entries / n.sum()) - 1e-9)).astype(np.int64)
    order = rng.permutation(np.repeat(np.arange(len(n)), pieces))
    return order, (n / pieces)[order]


def nce_steps(params: np.ndarray, size: int, triples: np.ndarray, n: np.ndarray, noise: np.ndarray, steps: int, seed: int, rate: float = 0.1) -> np.ndarray:
    """One pass of noise-contrastive steps (Adagrad): tell the class that came from ``NOISE`` classes drawn from ``noise``, shared by a batch.

    Every triple takes part with its whole count. There are ``steps`` steps for the mass and more by the number of triples.
    """
    rng = np.random.default_rng(seed)
    # Steps are worked out in single precision and added up in double: the least of them leaves its mark.
    params, current, squares = params.copy(), params.astype(np.float32), np.full(len(params), 1e-2, np.float32)
    context, target, scale, bias = _parts(current, size)
    slope, square = np.zeros_like(params), np.empty_like(params)
    to_context, to_target, to_scale, to_bias = _parts(slope, size)
    entries, weights = shares_of(n, BATCH * steps, rng)
    weights = (weights / weights.mean()).astype(np.float32)
    log_noise, noise_sum, columns = np.log(NOISE * noise).astype(np.float32), np.cumsum(noise), np.arange(WIDTH)

    def summed(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bincount((rows[:, None] * WIDTH + columns).ravel(), values.ravel(), size * WIDTH).reshape(size, WIDTH)

    with np.errstate(over="ignore"):
        for at in range(0, len(entries), BATCH):
            pick, weight = triples[entries[at : at + BATCH]], weights[at : at + BATCH, None]
            pair, own = np.divmod(pick, size)
            first, second = np.divmod(pair, size)
            drawn = np.searchsorted(noise_sum, rng.random(NOISE)).clip(max=size - 1)
            a, b, near, level = context[first], context[second], target[own], bias - log_noise
            h = a * scale[0] + b * scale[1]
            up = weight / (1 + np.exp(np.einsum("nd,nd->n", h, near) + level[own]))[:, None]
            down = h @ target[drawn].T
            down += level[drawn]
            np.exp(np.negative(down, out=down), out=down)
            down += 1
            np.divide(-weight, down, out=down)
            to_h = up * near
            to_h += down @ target[drawn]
            to_target[:] = summed(own, up * h)
            np.add.at(to_target, drawn, down.T @ h)
            to_bias[:] = np.bincount(own, up[:, 0], size)
            np.add.at(to_bias, drawn, down.sum(axis=0))
            to_context[:] = summed(np.r_[first, second], np.concatenate([to_h * scale[0], to_h * scale[1]]))
            to_scale[0], to_scale[1] = np.einsum("nd,nd->d", to_h, a), np.einsum("nd,nd->d", to_h, b)
            slope /= BATCH
            squares += np.multiply(slope, slope, out=square)
            slope *= rate
            slope /= np.sqrt(squares, out=square)
            params += slope
            current[:] = params
    return params


def trained(triples: DataFrame, classes: Classes, mass: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters after some rounds; a round's parameters are averaged by weight in Spark, and one vector comes back."""
    params = initial(classes, mass)
    noise = np.exp(_parts(params, classes.size)[3])
    size = classes.size
    parts = max(PARTS, -(-triples.count() // PART_TRIPLES))
    dealt = written(triples.repartition(parts).sortWithinPartitions("triple"), "dealt")

    for turn in range(rounds):

        def passed(held: list[pa.RecordBatch], start: np.ndarray, turn: int) -> pa.RecordBatch:
            triple, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
            new = nce_steps(start, size, triple, n, noise, STEPS, turn * 1000 + int(triple[0] % 997), 0.1 / (1 + turn))
            weight = float(n.sum())
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(new))), pa.array(new * weight), pa.array(np.full(len(new), weight))], names=["at", "v", "w"])

        def step(batches: Iterator[pa.RecordBatch], start: np.ndarray = params, turn: int = turn) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows >= PART_TRIPLES:
                    yield passed(held, start, turn)
                    held, rows = [], 0
            if rows:
                yield passed(held, start, turn)

        moved = dealt.mapInArrow(step, "at BIGINT, v DOUBLE, w DOUBLE")
        rows = moved.groupBy("at").agg((F.sum("v") / F.sum("w")).alias("v")).collect()
        if rows:
            params = params.copy()
            params[[r["at"] for r in rows]] = [r.v for r in rows]
    return params


def scorer(params: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of the first and of the second class of a context, of the class that follows with its bias, and the logarithms
    of the normalisers by context, which are the only table of pairs."""
    context, target, scale, bias = (x.astype(np.float32) for x in _parts(params, size))
    far, near = context * scale[0], np.c_[context * scale[1], np.ones(size, np.float32)]
    to = np.c_[target, bias]
    # A start is never predicted.
    second = near @ to[: size - 1].T
    low = second.max(axis=1)
    second = np.exp(np.subtract(second, low[:, None], out=second), out=second)
    total = np.empty((size, size), np.float32)
    for at in range(0, size, ROWS):
        first = far[at : at + ROWS] @ target[: size - 1].T
        high = first.max(axis=1, keepdims=True)
        total[at : at + ROWS] = np.log(np.maximum(np.exp(first - high) @ second.T, np.finfo(np.float32).tiny)) + high + low
    return np.c_[far, np.zeros(size, np.float32)], near, to, total


def log_probability(model: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], triples: np.ndarray) -> np.ndarray:
    """log10 probability of the last class of each triple after the two before it; normalised over the classes."""
    far, near, to, total = model
    pair, own = np.divmod(triples, len(total))
    first, second = np.divmod(pair, len(total))
    found = -total.ravel()[pair]
    for at in range(0, len(found), TOKENS):
        part = slice(at, at + TOKENS)
        h = far[first[part]]
        h += near[second[part]]
        found[part] += np.einsum("nd,nd->n", h, to[own[part]])
    return found * np.float32(1 / np.log(10))


def log_probabilities(params: np.ndarray, size: int) -> np.ndarray:
    """log10 probability of each class after each pair of classes, by number of triple; that of a start is left at any value."""
    found = log_probability(scorer(params, size), np.arange(size**3))
    found[size - 1 :: size] = -np.inf
    return found


@dataclass(frozen=True)
class Model:
    classes: Classes
    params: bytes
    shares: tuple[float, ...]  # log10 of the smoothed share of each class
    frequent: bytes  # words with their counts, one to a line
    tokens: int
    distinct: int

    @property
    def log_total(self) -> float:
        return float(np.log10(self.tokens + SMOOTHING * (self.distinct + 1)))


@lru_cache(maxsize=1)
def _ready(model: Model) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray, pa.Array, np.ndarray]:
    lines = [line.rpartition(b"\t") for line in model.frequent.split(b"\n")[:-1]]
    words, counts = pa.array([w for w, _, _ in lines], pa.binary()), np.array([*[int(n) for _, _, n in lines], 0], np.int64)
    return scorer(np.frombuffer(model.params), model.classes.size), np.r_[model.shares, 0], words, counts


def learn(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the column ``text``, and the table of all word counts, which stays with Spark."""
    counts = written(word_counts(texts), "words")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words = counts.where(F.col("word") != F.lit(END))
    top = tuple(bytes(r.word) for r in words.orderBy(F.col("n").desc(), "word").limit(max(TOP_WORDS, isqrt(distinct))).collect())
    # Words and endings are compared in hexadecimal: a tail of bytes need not be text.
    code = F.hex("word")
    is_top = code.isin([w.hex().upper() for w in top]) if top else F.lit(False)
    ending = F.when(F.length("word") > ENDING, F.substring(code, -2 * ENDING, 2 * ENDING)).otherwise(code)
    rest = words.where(~is_top).groupBy(ending.alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    tails = rest.orderBy(F.col("n").desc(), "ending").limit(ENDINGS).collect()
    classes = Classes(top, tuple(bytes.fromhex(r.ending) for r in tails))
    chosen = {bytes(r.word): r.n for r in counts.where(is_top | (F.col("word") == F.lit(END))).collect()}
    all_rest = rest.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    mass = [chosen[w] + SMOOTHING for w in top] + [r.n + SMOOTHING * (r.words + 1) for r in tails]
    mass.append(all_rest.n - sum(r.n for r in tails) + SMOOTHING * (all_rest.words - sum(r.words for r in tails) + 1))
    mass.append(chosen.get(END, 0) + SMOOTHING)
    mass = np.array(mass, float)
    triples = written(triple_counts(texts, classes), "triples")
    params = trained(triples, classes, mass)
    often = counts.where((F.col("n") * FREQUENT >= tokens) | (F.col("word") == F.lit(END))).orderBy("word").collect()
    frequent = b"".join(bytes(r.word) + b"\t" + str(r.n).encode() + b"\n" for r in often)
    shares = np.log10(mass / (tokens + SMOOTHING * (distinct + 1)))
    return Model(classes, params.tobytes(), tuple(shares.tolist()), frequent, tokens, distinct), counts


_PARTS = "n_tokens BIGINT, known BIGINT, base DOUBLE, gain DOUBLE, rare ARRAY<STRUCT<word: BINARY, times: INT>>"


def scored_parts(docs: DataFrame, model: Model) -> DataFrame:
    """``id`` with its tokens, what frequent words give, the model's gain over the base, and its other words with how often they occur."""

    def values(texts: list[bytes]) -> list[pa.Array]:
        ready, shares, frequent, counts = _ready(model)
        parts = []
        for begin, end in runs_of(texts):
            codes, begins, words = numbered(texts[begin:end])
            n = counts[pc.fill_null(pc.index_in(words, value_set=frequent), -1).to_numpy()]
            each = np.where(n > 0, np.log10(n + SMOOTHING), 0.0)[codes]
            known = (n > 0)[codes]
            sizes = np.diff(np.r_[begins, len(codes)])
            triples = class_triples(codes, begins, words, model.classes)
            better = log_probability(ready, triples).astype(np.float64) - shares[triples % len(shares)]
            at = np.flatnonzero(~known)
            owner = np.repeat(np.arange(len(begins)), sizes)[at]
            pairs, times = np.unique(owner * len(words) + codes[at], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(begins) + 1) * len(words)).astype(np.int32)
            entries = pa.StructArray.from_arrays([words.take(pa.array(pairs % len(words))), pa.array(times.astype(np.int32))], names=["word", "times"])
            parts.append((sizes, np.add.reduceat(known.astype(np.int64), begins), np.add.reduceat(each, begins), np.add.reduceat(better, begins), pa.ListArray.from_arrays(pa.array(ends), entries)))
        if not parts:
            return [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64()), pa.array([], pa.float64()), pa.array([], pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())])))]
        return [pa.array(np.concatenate(x)) for x in list(zip(*parts, strict=True))[:4]] + [pa.concat_arrays([p[4] for p in parts])]

    return add_text_columns(docs, "text", _PARTS, values)


def score(docs: DataFrame, model: Model, counts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id>, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    A null text is an empty one, whose only token is its end. Frequent words are counted where the text is; the
    others are joined with the table of counts, of which no part is broadcast unless it is small. Rows and ids may
    repeat or be null; other columns are not looked at; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    parts = written(scored_parts(rows, model).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = parts.select("row", F.inline("rare"))
    table = counts.where(F.col("n") * FREQUENT < model.tokens)
    joined = rare.join(table, "word", "left")
    n = F.coalesce("n", F.lit(0))
    sums = joined.groupBy("row").agg(F.sum(F.col("times") * F.log10(n + SMOOTHING)).alias("rare_base"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    found = parts.select("row", "id", "n_tokens", "known", "base", "gain").join(sums, "row", "left")
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(model.log_total)
    return found.select(
        F.col("id").alias(doc_id), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"),
    )


def held_out(doc_id: str):
    return F.coalesce(F.pmod(id_crc32(doc_id), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def with_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the training folds of ``docs`` and score all rows; rows without an id are held out."""
    model, counts = learn(docs.where(~held_out(doc_id)).select(F.col(text).alias("text")))
    found = score(docs, model, counts, doc_id, text)
    return found.withColumn("held_out", held_out(doc_id)).select(doc_id, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
