"""Document fingerprints: SimHash by DataFrame functions alone, and permuted block tables to look them up.

The terms of a text are its neighbouring word pairs (and its last word); each occurrence votes with the signed bits
of its 128-bit hash, so a term weighs as often as it occurs. Votes are counted two to a long: one sum over
``(hash >> i) & 0x0000000100000001`` counts bits ``i`` and ``i + 32``, so that 64 long sums in a hash aggregate hold
all 128 counters, without Python and without an object per term.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, written

BITS = 128
RADIUS = 3
SPAN_BITS = 12  # of dense ids, those that agree in all but so many low bits are neighbours in one group
_PAIR = (1 << 32) | 1
_WHITE = " \t\n\x0b\f\r"


def term_hashes(text: Column) -> Column:
    """An array with a hash per term; empty for a text without words."""
    core = F.btrim(text, F.lit(_WHITE))
    words = F.when(core != "", F.split(core, f"[{BLANKS}]+")).otherwise(F.array().cast("array<string>"))
    return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))


def fingerprint_columns(rows: DataFrame, key: list[str], texts: list[str]) -> DataFrame:
    """``key`` and, for the n-th of ``texts``, the two halves ``hi_n, lo_n`` of its fingerprint.

    ``key`` must tell rows apart. A bit is set if over half of the terms set it; a text that is null or has no
    word has the fingerprint 0. All terms of a row are counted where the row is: only counters are shuffled.
    """
    hashed = rows.select(*key, *[term_hashes(F.coalesce(F.col(t), F.lit(""))).alias(f"terms_{i}") for i, t in enumerate(texts)])
    tagged = F.array(*[F.struct(F.lit(i).alias("which"), F.col(f"terms_{i}").alias("terms")) for i in range(len(texts))])
    terms = (
        hashed.select(*key, F.explode(tagged).alias("t"))
        .select(*key, F.col("t.which").alias("which"), F.explode_outer("t.terms").alias("h"))
        .withColumn("g", F.xxhash64("h"))
    )
    sums = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_PAIR))).alias(f"{h}{i}") for h in "hg" for i in range(32)]
    votes = terms.groupBy(*key, "which").agg(F.count("h").alias("n"), *sums)

    def half(h: str) -> Column:
        out = F.lit(0).cast("bigint")
        for i in range(32):
            for shift, count in ((i, F.col(f"{h}{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(f"{h}{i}", 32))):
                out = out.bitwiseOR(F.when(count * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), shift)).otherwise(F.lit(0).cast("bigint")))
        return F.coalesce(out, F.lit(0).cast("bigint"))

    prints = votes.select(*key, "which", F.when(F.col("n") > 0, half("h")).otherwise(0).alias("hi"), F.when(F.col("n") > 0, half("g")).otherwise(0).alias("lo"))
    of = lambda i, c: F.max(F.when(F.col("which") == i, F.col(c))).alias(f"{c}_{i}")
    return prints.groupBy(*key).agg(*[of(i, c) for i in range(len(texts)) for c in ("hi", "lo")])


def as_hex(hi: str, lo: str) -> Column:
    return F.concat(F.lpad(F.lower(F.hex(hi)), 16, "0"), F.lpad(F.lower(F.hex(lo)), 16, "0"))


def bits_apart(hi_a: str, lo_a: str, hi_b: str, lo_b: str) -> Column:
    return F.bit_count(F.col(hi_a).bitwiseXOR(F.col(hi_b))) + F.bit_count(F.col(lo_a).bitwiseXOR(F.col(lo_b)))


def likeness(hi_a: str, lo_a: str, hi_b: str, lo_b: str) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - bits_apart(hi_a, lo_a, hi_b, lo_b) / float(BITS)


def _blocks(radius: int) -> list[tuple[int, int]]:
    """``radius + 2`` ranges of bits: of so many blocks, at least two are equal within ``radius``."""
    n = radius + 2
    edges = [BITS * i // n for i in range(n + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _block(hi: str, lo: str, begin: int, end: int) -> Column:
    """Bits ``begin`` to ``end`` (0: the lowest of ``hi``) as a long; blocks have 64 bits at most."""
    mask = (1 << (end - begin)) - 1
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    if end <= 64:
        value = F.shiftrightunsigned(hi, begin) if begin else F.col(hi)
    elif begin >= 64:
        value = F.shiftrightunsigned(lo, begin - 64) if begin > 64 else F.col(lo)
    else:
        value = F.shiftrightunsigned(hi, begin).bitwiseOR(F.shiftleft(lo, 64 - begin))
    return value.bitwiseAND(F.lit(mask))


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of the distinct fingerprints ``hi, lo`` that differ in 1 to ``radius`` bits, each once: ``hi_a, lo_a, hi_b, lo_b, bits``.

    Each table orders the bits so that two blocks come first and looks up fingerprints that are equal there; a pair
    within the radius has two equal blocks or more. Of the tables that hold a pair, only the first one gives it.
    """
    if radius < 0:
        raise ValueError("radius must not be negative")
    blocks = _blocks(radius)
    tables = list(combinations(range(len(blocks)), 2))

    def side(s: str) -> DataFrame:
        named = prints.select(F.col("hi").alias(f"hi_{s}"), F.col("lo").alias(f"lo_{s}"))
        keys = [F.struct(F.lit(i).alias("table"), *[_block(f"hi_{s}", f"lo_{s}", *blocks[j]).alias(f"k{x}") for x, j in enumerate(pair)]) for i, pair in enumerate(tables)]
        return named.select("*", F.inline(F.array(*keys)))

    a, b = side("a"), side("b")
    same = [_block("hi_a", "lo_a", *x) == _block("hi_b", "lo_b", *x) for x in blocks]
    first = F.lit(len(tables))
    for i, (x, y) in reversed(list(enumerate(tables))):
        first = F.when(same[x] & same[y], i).otherwise(first)
    ordered = (F.col("hi_a") < F.col("hi_b")) | ((F.col("hi_a") == F.col("hi_b")) & (F.col("lo_a") < F.col("lo_b")))
    apart = bits_apart("hi_a", "lo_a", "hi_b", "lo_b")
    on = (a["table"] == b["table"]) & (a["k0"] == b["k0"]) & (a["k1"] == b["k1"]) & ordered & (apart <= radius) & (first == a["table"])
    return a.join(b, on).select("hi_a", "lo_a", "hi_b", "lo_b", apart.alias("bits"))


def _span_bits(rows: DataFrame) -> int:
    """As many low bits of ``k`` as let a span have about ``2 ** SPAN_BITS`` rows, if ids are spread evenly."""
    low, high, count = rows.where("id IS NOT NULL").agg(F.min("k"), F.max("k"), F.count("*")).first()
    return min(62, SPAN_BITS + ((high - low) // count).bit_length()) if count else SPAN_BITS


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``span, pos, extra, <doc_id>, <text>, next_text``: the next row by descending id; after the last comes the first.

    Ids are grouped into spans of ``2 ** SPAN_BITS``, wider ones where ids are sparse, so that the spans, of which one task
    orders a row each, are far fewer than the rows. Each span is ordered on its own; its first row is also
    sent to the span before it, as an ``extra`` row at its end, so texts are shuffled once. Equal ids are ordered
    by text; null ids come last.
    """
    low = F.lit(-(1 << 63)).cast("bigint")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body")).withColumn("k", F.coalesce(F.col("id").cast("bigint"), low))
    bits = _span_bits(rows)
    spans = rows.groupBy(F.shiftright("k", bits).alias("span")).agg(F.max("k").alias("head"))
    order = Window.orderBy(F.col("span").desc())
    to = F.coalesce(F.lag("span").over(order), F.min("span").over(Window.partitionBy(F.lit(1))))
    heads = written(spans.select(F.col("head"), to.alias("to")), "heads")
    own = F.struct(F.shiftright("k", bits).alias("span"), F.lit(False).alias("extra"))
    more = F.struct(F.col("to").alias("span"), F.lit(True).alias("extra"))
    sent = rows.join(heads, rows["k"] == heads["head"], "left").select("id", "k", "body", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, more))).alias("at"))
    within = Window.partitionBy("span").orderBy("extra", F.col("k").desc(), "body")
    return sent.select("id", "k", "body", "at.span", "at.extra").select(
        "span", F.row_number().over(within).alias("pos"), "extra", F.col("id").alias(doc_id), F.col("body").alias(text),
        F.lead("body").over(within).alias("next_text"),
    )


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and how like they are: see ``op8_document_fingerprints``.

    The edited text ends, in place of the last half of the code points, with the first as many of the next row.
    """
    body, after = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col("next_text"), F.lit(""))
    n = F.length("body")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs, doc_id, text).select("span", "pos", "extra", F.col(doc_id).alias("id"), body.alias("body"), after.alias("after"))
    edited = F.concat(F.substring("body", F.lit(1), n - half), F.substring("after", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumns({"n_chars": n.cast("bigint"), "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256)})
    key = ["span", "pos", "extra", "id", "n_chars", "edited_sha256"]
    prints = fingerprint_columns(rows, key, ["body", "edited"])
    within = Window.partitionBy("span").orderBy("pos")
    prints = prints.withColumns({"hi_next": F.lead("hi_0").over(within), "lo_next": F.lead("lo_0").over(within)}).where("not extra")
    return prints.select(
        F.col("id").alias(doc_id), "n_chars", "edited_sha256",
        as_hex("hi_0", "lo_0").alias("fingerprint"), as_hex("hi_1", "lo_1").alias("edited_fingerprint"),
        likeness("hi_0", "lo_0", "hi_1", "lo_1").alias("near_edited"),
        likeness("hi_0", "lo_0", "hi_next", "lo_next").alias("near_next"),
        F.col("hi_0").alias("hi"), F.col("lo_0").alias("lo"),
    )


def count_near(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (with ``hi, lo``) and ``n_near``: how many other rows have a fingerprint within ``radius`` bits.

    Equal fingerprints are one class with a count; only classes are looked up.
    """
    classes = written(prints.groupBy("hi", "lo").agg(F.count("*").alias("rows")), "classes")
    pairs = near_pairs(classes, radius)
    ends = pairs.select("hi_a", "lo_a", "hi_b", "lo_b").unionByName(
        pairs.select(F.col("hi_b").alias("hi_a"), F.col("lo_b").alias("lo_a"), F.col("hi_a").alias("hi_b"), F.col("lo_a").alias("lo_b"))
    )
    other = classes.select(F.col("hi").alias("hi_b"), F.col("lo").alias("lo_b"), F.col("rows").alias("rows_b"))
    linked = ends.join(other, ["hi_b", "lo_b"]).groupBy(F.col("hi_a").alias("hi"), F.col("lo_a").alias("lo")).agg(F.sum("rows_b").alias("linked"))
    counted = classes.join(linked, ["hi", "lo"], "left").select("hi", "lo", (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_near"))
    return prints.join(counted, ["hi", "lo"])
