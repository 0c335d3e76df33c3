"""Sampling by time per key (X1, K5) over a whole table.

A row is emitted if it comes more than its ``wait`` after the last emitted row of its key; the first
row of a key always is. The rule looks back along the chain of emitted rows, so a key seems to need
one long walk. Here no task ever walks a whole key:

1. Of rows with the same key, millisecond and wait only the first can be emitted. This bounds what
   one key can have in one hour, and is done before and after a shuffle like any aggregate.
2. Time is cut into hours. What an hour does to its key depends only on the last emission before it
   and is a step function "last emission before -> last emission after", found for all
   hours side by side.
3. Step functions are composed sixteen at a time, so that a few short walks per key give the last
   emission before every hour.
4. Each hour, now knowing that, lists its own emissions, again side by side.
5. The emitted row ids select the full rows.

What is known from before, a last emission per key, enters the walk and the hour it lies in: no row is joined by its
key alone, so a hot key stays spread over its hours.

A step function is a pair of rising arrays ``edges`` and ``exits``: the first edge above the
last emission before gives the exit; above all edges nothing is emitted and the time stays as it is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import key_text
from tidemark.functions.timing import as_column

# Send the functions below along with the tasks, for clusters where this package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_MS = 60 * 60 * 1000
FAN_IN = 16
LEVELS = 3
NEVER = -(2**62)

_STEPS = "key string, segment bigint, edges array<bigint>, exits array<bigint>"
_ENTRIES = "key string, segment bigint, last bigint"


def throttle(
    df: DataFrame,
    key: str | Column,
    time_ms: str | Column,
    wait_ms: int | Column,
    row_id: str,
    segment_ms: int = SEGMENT_MS,
    known: DataFrame | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """The rows of ``df`` that are emitted.

    ``row_id`` is a unique bigint in arrival order: it decides between rows of one millisecond. Rows
    without a time or a wait are never emitted.
    ``wait_ms`` may differ from row to row (K5: a shorter wait for rows with a clock ahead).
    ``known`` has the last emission before all rows, as ``key`` (text), ``last``, one row per key.
    ``levels`` is how often step functions are composed: :func:`levels_for` tells it for rows of a known span.
    """
    wait = F.lit(wait_ms) if isinstance(wait_ms, int) else wait_ms
    candidates = (
        df.groupBy(
            key_text(key).alias("key"),
            as_column(time_ms).cast("bigint").alias("ms"),
            wait.cast("bigint").alias("wait"),
        )
        .agg(F.min(row_id).alias("id"))
        .withColumn("segment", F.floor(F.col("ms") / F.lit(segment_ms)))
        # The join below implies this filter; stated here, both uses of the shuffle are alike and share it.
        .filter(F.col("key").isNotNull() & F.col("segment").isNotNull() & F.col("wait").isNotNull())
    )
    hours = candidates.repartition("key", "segment")
    if known is not None:
        within = known.select("key", F.floor(F.col("last") / F.lit(segment_ms)).alias("segment"), F.col("last").alias("known"))
        past_wait = F.col("known").isNull() | (F.col("ms") - F.col("wait") > F.col("known"))
        hours = hours.join(within, ["key", "segment"], "left").filter(past_wait).drop("known")
    steps = hours.sortWithinPartitions("key", "segment", "ms", "id").mapInPandas(
        partial(_segment_steps, segment_ms=segment_ms), _STEPS
    )
    emitted = (
        hours.join(_entries(steps, segment_ms, known, levels), ["key", "segment"])
        .sortWithinPartitions("key", "segment", "ms", "id")
        .mapInPandas(partial(_emissions, segment_ms=segment_ms), "id bigint")
    )
    return df.join(emitted.withColumnRenamed("id", row_id), row_id, "left_semi").select(*df.columns)


def _after(steps: DataFrame, known: DataFrame, segment_ms: int) -> DataFrame:
    """Steps without the segments before the known emission and without the edges that it has passed."""
    joined = steps.join(known.select("key", F.col("last").alias("known")), "key", "left")
    ahead = F.expr("filter(arrays_zip(edges, exits), step -> known is null or step.edges > known)")
    return (
        joined.filter(F.col("known").isNull() | (F.col("segment") >= F.floor(F.col("known") / F.lit(segment_ms))))
        .select("key", "segment", ahead.alias("ahead"))
        .filter(F.size("ahead") > 0)
        .select("key", "segment", F.col("ahead.edges").alias("edges"), F.col("ahead.exits").alias("exits"))
    )


def levels_for(span_ms: int, segment_ms: int = SEGMENT_MS) -> int:
    """So many levels that the last walk of a key over rows within ``span_ms`` takes about ``FAN_IN`` steps at most."""
    levels, covered = 0, FAN_IN * segment_ms
    while covered < span_ms and levels < LEVELS:
        levels, covered = levels + 1, covered * FAN_IN
    return levels


def last_emissions(emitted: DataFrame, key: str | Column, time_ms: str | Column) -> DataFrame:
    """What later rows of each key go on from: ``key`` (text), ``last``."""
    return emitted.groupBy(key_text(key).alias("key")).agg(F.max(as_column(time_ms).cast("bigint")).alias("last"))


def _entries(steps: DataFrame, segment_ms: int, known: DataFrame | None, depth: int) -> DataFrame:
    """The last emission before each segment."""
    if known is not None:
        steps = _after(steps, known, segment_ms)
    levels = [_under_parents(steps) if depth else steps]
    for level in range(1, depth + 1):
        compose = partial(_compose_groups, span_ms=segment_ms * FAN_IN**level)
        parents = levels[-1].sortWithinPartitions("key", "parent", "segment").mapInPandas(compose, _STEPS)
        levels.append(_under_parents(parents) if level < depth else parents)
    top = levels.pop().withColumn("parent", F.lit(0)).repartition("key")
    if known is None:
        top = top.withColumn("last", F.lit(NEVER))
    else:
        top = top.join(known.select("key", "last"), "key", "left").fillna({"last": NEVER})
    entries = _walked(top)
    for children in reversed(levels):
        entries = _walked(children.join(entries.withColumnRenamed("segment", "parent"), ["key", "parent"]))
    return entries


def _under_parents(steps: DataFrame) -> DataFrame:
    """Segments that compose into one, side by side.

    The explicit shuffle keeps a group in one task, also through the joins above, where entries are unique.
    """
    numbered = steps.withColumn("parent", F.floor(F.col("segment") / FAN_IN))
    return numbered.filter(F.col("key").isNotNull() & F.col("parent").isNotNull()).repartition("key", "parent")


def _walked(children: DataFrame) -> DataFrame:
    return children.sortWithinPartitions("key", "parent", "segment").mapInPandas(_walk_groups, _ENTRIES)


def first_after(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by edge, and for each place the earliest row from there on.

    A row may follow any emission below its edge (its time less its wait), so the row that
    follows an emission is the earliest of those whose edge is above it.
    """
    order = np.argsort(edges, kind="stable")
    return edges[order], np.minimum.accumulate(order[::-1])[::-1]


class _Segments:
    """Links between the rows of many whole (key, segment) groups, sorted by group and time."""

    def __init__(self, frame: pd.DataFrame, segment_ms: int):
        self.starts = np.flatnonzero(_group_starts(frame, "segment"))
        self.sizes = np.diff(self.starts, append=len(frame))
        self.group = np.repeat(np.arange(len(self.starts)), self.sizes)
        self.ms = frame["ms"].to_numpy()
        wait = frame["wait"].to_numpy()
        self.begin = frame["segment"].to_numpy()[self.starts] * segment_ms
        # Edges of all groups on one axis: each group has its own stretch of it.
        self.reach_back = int(wait.max())
        self.stretch = segment_ms + self.reach_back + 1
        self.edges, self.earliest = first_after(self._place(self.ms - wait, self.group))

    def _place(self, time: np.ndarray, group: np.ndarray) -> np.ndarray:
        offset = np.maximum(time - self.begin[group] + self.reach_back, -1)
        return group * self.stretch + offset

    def next_row(self, last: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The row that follows an emission at ``last`` in ``group``, or -1."""
        at = np.searchsorted(self.edges, self._place(last, group), side="right")
        row = np.append(self.earliest, -1)[at]
        return np.where((row >= 0) & (self.group[row] == group), row, -1)

    def final_row(self) -> np.ndarray:
        """Where the chain from each row ends within its segment."""
        following = self.next_row(self.ms, self.group)
        end = np.where(following < 0, np.arange(len(self.ms)), following)
        while True:
            further = end[end]
            if np.array_equal(further, end):
                return end
            end = further


def _group_starts(frame: pd.DataFrame, part: str) -> np.ndarray:
    """Where a new (key, part) begins."""
    key, number = frame["key"].to_numpy(), frame[part].to_numpy()
    starts = np.ones(len(frame), dtype=bool)
    starts[1:] = (number[1:] != number[:-1]) | (key[1:] != key[:-1])
    return starts


def _whole_groups(frames: Iterator[pd.DataFrame], part: str) -> Iterator[pd.DataFrame]:
    """Cut sorted batches anew so that none ends within a (key, part)."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        cut = int(np.flatnonzero(_group_starts(frame, part))[-1])
        goes_on = bool(held) and all(held[-1][c].iloc[-1] == frame[c].iloc[0] for c in ("key", part))
        if cut == 0 and (goes_on or not held):
            held.append(frame)
        else:
            yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
            held = [frame.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _shorten(edges: np.ndarray, exits: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Leave out edges that no emission before ``begin`` can be between, and those without a turn."""
    count = int(np.searchsorted(edges, begin, side="left")) + 1
    edges, exits = edges[:count], exits[:count]
    turns = np.append(exits[1:] != exits[:-1], True)
    return edges[turns], exits[turns]


def _segment_steps(frames: Iterator[pd.DataFrame], segment_ms: int) -> Iterator[pd.DataFrame]:
    for frame in _whole_groups(frames, "segment"):
        rows = _Segments(frame, segment_ms)
        exits = rows.ms[rows.final_row()[rows.earliest]]
        shift = np.arange(len(rows.starts)) * rows.stretch + rows.reach_back - rows.begin
        steps = [
            _shorten(rows.edges[i : i + n] - by, exits[i : i + n], begin)
            for i, n, by, begin in zip(rows.starts, rows.sizes, shift, rows.begin)
        ]
        firsts = frame.iloc[rows.starts]
        yield pd.DataFrame(
            {
                "key": firsts["key"].to_numpy(),
                "segment": firsts["segment"].to_numpy(),
                "edges": [edges for edges, _ in steps],
                "exits": [exits for _, exits in steps],
            }
        )


def _apply(edges: np.ndarray, exits: np.ndarray, last: np.ndarray) -> np.ndarray:
    at = np.searchsorted(edges, last, side="right")
    return np.where(at < len(edges), exits[np.minimum(at, len(edges) - 1)], last)


def _compose_groups(frames: Iterator[pd.DataFrame], span_ms: int) -> Iterator[pd.DataFrame]:
    """One step function for the consecutive ones under a parent."""
    for frame in _whole_groups(frames, "parent"):
        starts = np.flatnonzero(_group_starts(frame, "parent"))
        firsts = frame.iloc[starts]
        steps = list(zip(frame["edges"], frame["exits"]))
        composed = [
            _shorten(*_compose(steps[start:end]), parent * span_ms)
            for start, end, parent in zip(starts, [*starts[1:], len(frame)], firsts["parent"])
        ]
        yield pd.DataFrame(
            {
                "key": firsts["key"].to_numpy(),
                "segment": firsts["parent"].to_numpy(),
                "edges": [edges for edges, _ in composed],
                "exits": [exits for _, exits in composed],
            }
        )


def _compose(steps: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    edges, exits = steps[-1]
    for first_edges, first_exits in reversed(steps[:-1]):
        later = edges > first_edges[-1]
        exits = np.concatenate([_apply(edges, exits, first_exits), exits[later]])
        edges = np.concatenate([first_edges, edges[later]])
    return edges, exits


def _walk_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last emission before each of the segments under a parent, given that before the parent."""
    for frame in _whole_groups(frames, "parent"):
        starts = _group_starts(frame, "parent")
        before = np.empty(len(frame), dtype=np.int64)
        last = NEVER
        for i, (edges, exits, entry) in enumerate(zip(frame["edges"], frame["exits"], frame["last"])):
            last = entry if starts[i] else last
            before[i] = last
            at = np.searchsorted(edges, last, side="right")
            last = exits[at] if at < len(edges) else last
        yield pd.DataFrame({"key": frame["key"], "segment": frame["segment"], "last": before})


def _emissions(frames: Iterator[pd.DataFrame], segment_ms: int) -> Iterator[pd.DataFrame]:
    for frame in _whole_groups(frames, "segment"):
        rows = _Segments(frame, segment_ms)
        ids = frame["id"].to_numpy()
        last = frame["last"].to_numpy()[rows.starts]
        group = np.arange(len(rows.starts))
        while len(group):
            row = rows.next_row(last, group)
            row = row[row >= 0]
            yield pd.DataFrame({"id": ids[row]})
            last, group = rows.ms[row], rows.group[row]
