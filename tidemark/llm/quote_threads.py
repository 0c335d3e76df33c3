"""Conversations from messages that quote each other.

Quoted lines are parsed into passages by their nesting level and taken out of the text. Passages, and the own text of
every message, are hashed in a normal form; a message replies to the one whose own text its outermost quotes show:
the latest earlier message of its conversation that holds the passage, else the first message anywhere that does.
Without such a message it replies to the one before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import utf8, written

SPAN_BITS = 10  # turns that agree in all but so many low bits are put in order together
_QUOTE = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
_SAID = re.compile(r"^.{0,300}(?:wrote|schrieb|a écrit|escribió)\s*:\s*$", re.IGNORECASE)
_GAP = re.compile(r"\W+")


def normal(text: str) -> str:
    """Lower case, and a blank for all that is no letter, digit or underscore."""
    return _GAP.sub(" ", text.casefold()).strip()


def _hash(text: str) -> int | None:
    plain = normal(text)
    return xxhash.xxh64_intdigest(plain.encode("utf-8", "surrogatepass")) - (1 << 63) if plain else None


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The text without quotes and attribution lines, and the quoted passages with their levels (1: quoted once)."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    level = 0
    for line in text.split("\n"):
        found = _QUOTE.match(line)
        depth = found[1].count(">") if found else 0
        body = line[found.end() :] if found else line
        if depth == 0:
            own.append(line)
        else:
            if level == 0 and own and _SAID.match(own[-1]):
                own.pop()
            if depth != level:
                passages.append((depth, []))
            passages[-1][1].append(body)
        level = depth
    return "\n".join(own).strip("\n") if passages else text, [(n, "\n".join(lines)) for n, lines in passages]


def hashes_of(own: str) -> list[int]:
    """Hashes of a whole text and of each of its lines and paragraphs."""
    parts = [own, *own.split("\n"), *re.split(r"\n\s*\n", own)]
    return list(dict.fromkeys(h for h in map(_hash, parts) if h is not None))


def quote_hashes(passages: list[tuple[int, str]]) -> list[dict]:
    """Level, hash and length of each passage, and of its lines where it has several."""
    out: dict[tuple[int, int], int] = {}
    for level, passage in passages:
        for part in [passage, *passage.split("\n")]:
            if (h := _hash(part)) is not None:
                out.setdefault((level, h), len(normal(part)))
    return [{"level": n, "hash": h, "size": size} for (n, h), size in out.items()]


_PARSED = "clean STRING, own ARRAY<BIGINT>, quotes ARRAY<STRUCT<level: INT, hash: BIGINT, size: INT>>, n_quotes INT, levels INT"


def _parsed(rows: DataFrame) -> DataFrame:
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType([*kept, *rows.sparkSession.createDataFrame([], _PARSED).schema.fields])
    at = rows.columns.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            absent = batch.column(at).is_null().to_pylist()
            found = [parse(t.decode()) for t in utf8(batch.column(at))]
            quotes = [quote_hashes(passages) for _, passages in found]
            columns = [
                pa.array([None if gone else own for (own, _), gone in zip(found, absent, strict=True)], pa.string()),
                pa.array([hashes_of(own) for own, _ in found], pa.list_(pa.int64())),
                pa.array(quotes, pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("size", pa.int32())]))),
                pa.array([len(passages) for _, passages in found], pa.int32()),
                pa.array([max((n for n, _ in passages), default=0) for _, passages in found], pa.int32()),
            ]
            others = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*others, *columns], names=schema.names)

    return rows.mapInArrow(step, schema)


def _before(slim: DataFrame) -> DataFrame:
    """``row, before``: the row before it in its conversation; turns are put in order span by span."""
    spans = slim.withColumn("span", F.shiftright("turn", SPAN_BITS))
    lasts = spans.groupBy("conv", "span").agg(F.max(F.struct("turn", "row")).alias("last"))
    earlier = lasts.select("conv", "span", F.lag("last.row").over(Window.partitionBy("conv").orderBy("span")).alias("last"))
    within = Window.partitionBy("conv", "span").orderBy("turn", "row")
    inner = spans.withColumn("before", F.lag("row").over(within))
    same = inner["conv"].eqNullSafe(earlier["conv"]) & inner["span"].eqNullSafe(earlier["span"])
    return inner.join(earlier, same).select("row", F.coalesce("before", "last").alias("before"))


def _quoted(parsed: DataFrame) -> DataFrame:
    """``row, origin``: the row that a message quotes, where there is one.

    Of a message's passages that can be linked, the outermost counts, then one of its own conversation, then the longest.
    """
    quotes = parsed.select("conv", "turn", "row", F.inline("quotes"))
    asked = quotes.select("hash").distinct()
    own = parsed.select("conv", "turn", "row", F.explode("own").alias("hash")).join(asked, "hash")
    firsts = own.groupBy("hash").agg(F.min(F.struct("conv", "turn", "row")).alias("first"))
    both = own.select("hash", "conv", "turn", "row", F.col("row").alias("held"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("int").alias("size")).unionByName(
        quotes.select("hash", "conv", "turn", "row", F.lit(None).cast("bigint").alias("held"), "level", "size")
    )
    # A quoting message may hold the passage too: its quote is put before that, so it never links to itself.
    place = Window.partitionBy("hash", "conv").orderBy("turn", "row", F.col("level").isNull().cast("int")).rowsBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.last("held", ignorenulls=True).over(place)).where("level is not null")
    found = near.join(firsts, "hash", "left")
    far = F.when(F.col("first") < F.struct("conv", "turn", "row"), F.col("first.row"))
    origin = F.coalesce("near", far)
    rank = F.struct((-F.col("level")).alias("outer"), F.col("near").isNotNull().alias("inside"), "size", origin.alias("origin"))
    return found.where(origin.isNotNull()).groupBy("row").agg(F.max(rank).alias("best")).select("row", F.col("best.origin").alias("origin"))


def _roots(links: DataFrame) -> DataFrame:
    """``row, root, depth`` of a forest ``row, parent``, by doubling: rounds grow with the logarithm of the depth."""
    step = F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint")
    state = written(links.select("row", F.coalesce("parent", "row").alias("root"), step.alias("depth")), "roots")
    while True:
        up = state.select(F.col("row").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        after = written(state.join(up, "root").select("row", F.col("above").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("moved")), "roots")
        done = after.where("moved").isEmpty()
        state = after.select("row", "root", "depth")
        if done:
            return state


def _numbered(placed: DataFrame) -> DataFrame:
    """``placed`` with ``reply_no``: its rows counted by ``root`` in order of ``conv, turn, row``, span by span of turns.

    A thread's spans are counted up in one task, a row for each; the rows of a span are numbered on their own.
    """
    spans = placed.withColumn("span", F.shiftright("turn", SPAN_BITS))
    sizes = spans.groupBy("root", "conv", "span").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("root").orderBy("conv", "span").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("root", "conv", "span", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("begin"))
    inner = spans.withColumn("place", F.row_number().over(Window.partitionBy("root", "conv", "span").orderBy("turn", "row")))
    same = (inner["root"] == begins["root"]) & inner["conv"].eqNullSafe(begins["conv"]) & inner["span"].eqNullSafe(begins["span"])
    return inner.join(begins, same).select(*[inner[c] for c in placed.columns], (F.col("begin") + F.col("place")).alias("reply_no"))


def link_quotations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message, its text without quotes, with its parent and its place in a thread.

    ``<conv>, <turn>, <role>, <text>, n_quotes`` (passages), ``quote_levels, linked`` (whether a quote gave the
    parent), ``parent_conv, parent_turn`` (null at the head of a thread), ``thread_conv, thread_turn`` (the head),
    ``depth`` (replies from the head) and ``reply_no`` (1, 2, ...: the order in the thread, where each message comes
    after the one it replies to). A null text stays null and is linked by its turn; empty texts too. Messages without
    a conversation id form one conversation; null turns come first; repeated rows follow each other. Other columns
    are not looked at. An empty table gives an empty result. A thread that holds a large part of all messages is numbered
    span by span of its turns; messages of one conversation and equal turns are one span.
    """
    rows = messages.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    parsed = written(_parsed(rows).withColumn("row", F.monotonically_increasing_id()), "parsed")
    slim = parsed.select("conv", "turn", "row")
    links = _before(slim).join(_quoted(parsed), "row", "left")
    links = written(links.select("row", F.coalesce("origin", "before").alias("parent"), F.col("origin").isNotNull().alias("linked")), "links")
    placed = links.join(_roots(links), "row")
    names = slim.select(F.col("row").alias("parent"), F.col("conv").alias("parent_conv"), F.col("turn").alias("parent_turn"))
    heads = slim.select(F.col("row").alias("root"), F.col("conv").alias("thread_conv"), F.col("turn").alias("thread_turn"))
    placed = slim.join(placed, "row").join(names, "parent", "left").join(heads, "root")
    wide = parsed.select("row", "role", "clean", "n_quotes", "levels").join(_numbered(placed), "row")
    return wide.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), F.col("clean").alias(text),
        "n_quotes", F.col("levels").alias("quote_levels"), "linked", "parent_conv", "parent_turn", "thread_conv", "thread_turn", "depth", "reply_no",
    )
