"""Language identification by cross-parsing.

For each language a bounded sample of labelled text is made into a suffix automaton, which follows any text as long
as it occurs in the sample. A text is parsed greedily into longest matches; the language that needs the fewest
phrases, times the bits that name a place in its sample, explains the text best. Texts are cut into lanes that step
through an automaton side by side, one byte at a time, so the work is array arithmetic and the same for every byte.
Lanes are taken in blocks, so a text of any length needs little more memory than its own.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import add_text_columns, free_name, id_crc32, runs_of

FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS, SAMPLE_CHARS = 64, 768  # per language: the bound of what is learned from
LANE, LANES = 512, 4096  # bytes of a lane, lanes that are held at once
UNKNOWN = "und"

# Letters in lower case, all other ASCII signs as blanks; other bytes stay.
_FOLD = bytes(x if x >= 128 else ord(chr(x).lower()) if chr(x).isalpha() else 32 for x in range(256))
_END = 0  # a byte that stands between samples; folded texts don't hold it


def folded(text: bytes) -> bytes:
    """Letters in lower case, with single blanks for all between them."""
    signs = np.frombuffer(text.translate(_FOLD), np.uint8)
    blank = signs == 32
    kept = ~blank
    kept[1:] |= ~blank[:-1]  # a blank after a letter
    return signs[kept].tobytes().strip()


def suffix_automaton(codes: bytes, width: int) -> np.ndarray:
    """Moves by state and code (below ``width``), -1 for none; state 0 is the start. A string can be followed from it if and
    only if it occurs in ``codes``."""
    none = array("i", [-1]) * width
    moves, link, length, last = array("i", none), [-1], [0], 0
    for code in codes:
        new = len(link)
        moves.extend(none)
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and moves[p * width + code] < 0:
            moves[p * width + code] = new
            p = link[p]
        if p >= 0:
            q = moves[p * width + code]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(link)
                moves.extend(moves[q * width : (q + 1) * width])
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p * width + code] == q:
                    moves[p * width + code] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return np.frombuffer(moves, np.int32).reshape(-1, width)


class Parser:
    """A table for each language: a step gives four times the place of the next row, plus the phrases that end there (0 to 2)."""

    def __init__(self, samples: tuple[tuple[str, tuple[bytes, ...]], ...]):
        self.names = [name for name, _ in samples]
        data = [bytes([_END]).join(map(folded, texts)) for _, texts in samples]
        used = sorted(set().union(*data) - {_END})
        self.codes = np.zeros(256, np.uint8)  # 0: in no sample
        self.codes[used] = np.arange(1, len(used) + 1)
        self.pad, self.width = len(used) + 1, len(used) + 2
        self.bits = np.array([np.log2(max(2, len(x))) for x in data])
        # Between samples stands the code that fills up lanes: it is no move of a text.
        codes = bytes(self.pad if x == _END else int(self.codes[x]) for x in range(256))
        self.tables = [self._table(suffix_automaton(x.translate(codes), self.width)) for x in data]

    def _table(self, moves: np.ndarray) -> np.ndarray:
        row = self.width * 4
        table = moves * row if moves.size < 1 << 29 else moves.astype(np.int64) * row
        unknown = moves[0] < 0
        start = np.where(unknown, 0, table[0]) + 1
        np.copyto(table[0], start, where=unknown)
        # An open phrase ends, and a strange byte is one of its own.
        np.copyto(table[1:], start + unknown, where=moves[1:] < 0)
        table[:, self.pad] = np.arange(len(table)) * row
        return table.ravel()

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases by folded text and language; lanes start a phrase of their own."""
        lanes = np.array([max(1, -(-len(t) // LANE)) for t in texts])
        first = np.cumsum(lanes) - lanes
        found = np.zeros((len(texts), len(self.tables)), np.int64)
        for begin in range(0, int(lanes.sum()), LANES):
            end = min(begin + LANES, int(lanes.sum()))
            own = range(int(np.searchsorted(first, begin, side="right")) - 1, int(np.searchsorted(first, end)))
            grid = np.full((end - begin, LANE), self.pad, np.uint8)
            flat = grid.ravel()
            for t in own:
                at = max(begin, first[t])
                part = np.frombuffer(texts[t], np.uint8)[(at - first[t]) * LANE : (end - first[t]) * LANE]
                flat[(at - begin) * LANE : (at - begin) * LANE + len(part)] = self.codes[part]
            grid = np.ascontiguousarray(grid.T)
            starts = np.maximum(first[own.start : own.stop] - begin, 0)
            for i, table in enumerate(self.tables):
                found[own.start : own.stop, i] += np.add.reduceat(self._ended(table, grid), starts)
        return found

    @staticmethod
    def _ended(table: np.ndarray, grid: np.ndarray) -> np.ndarray:
        """Phrases that end in each lane of ``grid``, which has a lane per column."""
        state = np.zeros(grid.shape[1], table.dtype)
        ended = np.zeros(grid.shape[1], np.int64)
        for signs in grid:
            step = table.take(state + signs)
            ended += step & 3
            state = step >> 2
        return ended + (state != 0)

    def costs(self, texts: list[bytes]) -> np.ndarray:
        """Bits a byte, by text and language."""
        texts = [folded(t) for t in texts]
        size = np.array([max(1, len(t)) for t in texts])
        return self.phrases(texts) * self.bits / size[:, None]


@lru_cache(maxsize=1)
def _parser(samples: tuple) -> Parser:
    return Parser(samples)


def has_letter(text: bytes) -> bool:
    return bool(re.search(rb"[A-Za-z]", text)) or (not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace")))


def predict(texts: list[bytes], samples: tuple) -> tuple[list[str], list[float]]:
    """Language and score by text: the score is how far the cost is below the next language's, 0 to 1."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if samples and has_letter(t)]
    parser = _parser(samples)
    for begin, end in runs_of([texts[i] for i in known]):
        own = known[begin:end]
        costs = parser.costs([texts[i] for i in own])
        order = np.argsort(costs, axis=1, kind="stable")
        for i, cost, best in zip(own, costs, order, strict=True):
            names[i] = parser.names[best[0]]
            scores[i] = float(1 - cost[best[0]] / cost[best[1]]) if len(best) > 1 else 1.0
    return names, scores


def learn(docs: DataFrame, doc_id: str, text: str, lang: str, docs_each: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> tuple:
    """For each language of ``docs`` up to ``docs_each`` pieces of ``chars`` characters, from places and documents that a hash picks.

    Only this bounded sample reaches the driver: its size depends on the number of languages, not of documents.
    """
    lot = F.xxhash64(F.lit("cross-parse"), F.col(doc_id).cast("string"))
    place = F.pmod(F.xxhash64(F.lit("place"), F.col(doc_id).cast("string")), F.greatest(F.length(text) - chars, F.lit(1)).cast("bigint"))
    piece = F.substring(F.col(text), (place + 1).cast("int"), F.lit(chars))
    pieces = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), lot.alias("lot"), piece.alias("piece"))
    within = Window.partitionBy("lang").orderBy("lot", "piece")
    chosen = pieces.withColumn("n", F.row_number().over(within)).where(F.col("n") <= docs_each).orderBy("lang", "n").collect()
    found: dict[str, list[bytes]] = {}
    for row in chosen:
        if has_letter(data := row.piece.encode()):
            found.setdefault(row.lang, []).append(data)
    return tuple((name, tuple(texts)) for name, texts in sorted(found.items()))


def identify(docs: DataFrame, samples: tuple, doc_id: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """``<doc_id>, lang_pred, score`` for every row; ``und`` with score 0 if the text is null or has no letter.

    ``keep`` keeps all columns in place of the id alone; the two that are added then have the names of :func:`added_names`.

    Without any labelled text every language is ``und``. Rows and ids may repeat or be null; an empty table gives
    an empty result; ties go to the language that is first by name; other columns are not looked at.
    """

    def values(texts: list[bytes]) -> list[pa.Array]:
        names, scores = predict(texts, samples)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    if keep:
        names = added_names(docs)
        return add_text_columns(docs, text, f"{names['lang_pred']} STRING, {names['score']} DOUBLE", values, keep=True)
    body = free_name(docs, "body")
    return add_text_columns(docs.select(doc_id, F.col(text).alias(body)), body, "lang_pred STRING, score DOUBLE", values)


def added_names(docs: DataFrame) -> dict[str, str]:
    """The columns that ``identify`` adds to those of ``docs``: names that are free there."""
    return {name: free_name(docs, name) for name in ("lang_pred", "score")}


def in_training(doc_id: str):
    return F.coalesce(F.pmod(id_crc32(doc_id), F.lit(FOLDS)) != HELD_OUT, F.lit(False))


def with_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the training folds of ``docs`` and identify all of it: ``<doc_id>, held_out, lang_pred, score``.

    A row without an id is in no training fold.
    """
    samples = learn(docs.where(in_training(doc_id)), doc_id, text, lang)
    found = identify(docs, samples, doc_id, text)
    return found.select(doc_id, (~in_training(doc_id)).alias("held_out"), "lang_pred", "score")
