"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the form each word stands for.

Of two words the longer one (of equally long ones the later in code-point order) is cut into two disjoint chunks, its
halves; the other gives its positional grams of the same sizes. One edit leaves one of the chunks whole. In the other
word it stands at its own place, or, if the edit comes before it, moved by the difference of the lengths, which is
none or one: so chunks and grams are joined on the place from the side that the edit leaves alone, and each candidate is
verified by its edit distance.

A chunk that many words share would list pairs by the square. Where a chunk's pairs outnumber its rows ``CROWD`` to
one, its words also have to agree on one half of the other chunk, again and again; as one edit cannot touch both
halves, no pair is lost, and what is listed stays in proportion to the words.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

# Which runs of text are words, which runs lose a code point, and which words are taken.
RUN = "[a-zÀ-ÿ]+"
EVERY = 199
LEAST_LENGTH, LEAST_COUNT, LEAST_RATIO = 6, 5, 5

CROWD = 8


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = EVERY, length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n`` over all runs of letters, A-Z lower-cased; a run whose hash with its document's id ``every`` divides has lost one code point."""
    lowered = F.translate(F.col(text), ascii_uppercase, ascii_lowercase)
    found = F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("own"), found).where(F.length("run") >= length)
    lot = runs.select("run", F.crc32(F.concat("own", F.lit(":"), "run").cast("binary")).alias("lot"))
    at = (F.col("lot") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = lot.select(F.when(F.col("lot") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))


_KEY = ["size", "begin", "end", "rest"]


def _keyed(rows: DataFrame, begin: Column, end: Column) -> DataFrame:
    """``rest``: the word without what lies in the gap from ``begin`` to ``end``, in places of a chunked word of ``size`` code points."""
    cut = rows.select("word", "n", "chunked", "size", begin.alias("begin"), end.alias("end"))
    tail = F.col("size") - F.col("end")
    rest = F.concat(F.substring(F.col("word"), F.lit(1), F.col("begin")), F.substring(F.col("word"), F.length("word") - tail + 1, tail))
    return cut.withColumn("rest", rest)


def _halves(begin: Column, end: Column) -> Column:
    middle = F.floor((begin + end) / 2).cast("int")
    gap = lambda x, y: F.struct(x.alias("begin"), y.alias("end"))
    return F.explode(F.array(gap(begin, middle), gap(middle, end))).alias("gap")


def _split(rows: DataFrame) -> DataFrame:
    halved = rows.select("word", "n", "chunked", "size", _halves(F.col("begin"), F.col("end")))
    return _keyed(halved, F.col("gap.begin"), F.col("gap.end"))


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``a, n_a, b, n_b``: the pairs of different words of ``word, n`` one edit apart, each once, ``a`` the longer or later one."""
    length = F.length("word")
    chunks = words.select("word", "n", F.lit(True).alias("chunked"), length.alias("size"))
    grams = words.select("word", "n", F.lit(False).alias("chunked"), F.explode(F.array(length, length + 1)).alias("size"))
    # A gap that is one half of the word leaves the other half, the chunk.
    level = _split(chunks.unionByName(grams).withColumns({"begin": F.lit(0), "end": F.col("size")}))
    found = None
    while True:
        level = written(level, "chunks")
        n_chunks, n_grams = F.count_if("chunked"), F.count_if(~F.col("chunked"))
        sizes = level.groupBy(*_KEY).agg(n_chunks.alias("n_chunks"), n_grams.alias("n_grams")).where("n_chunks > 0 AND n_grams > 0")
        crowded = (F.col("end") - F.col("begin") > 1) & (F.col("n_chunks") * F.col("n_grams") > crowd * (F.col("n_chunks") + F.col("n_grams")))
        told = written(level.join(sizes.select(*_KEY, crowded.alias("crowded")), _KEY), "told")
        sparse = told.where("not crowded")
        a = sparse.where("chunked").select(*_KEY, F.col("word").alias("a"), F.col("n").alias("n_a"))
        b = sparse.where("not chunked").select(*_KEY, F.col("word").alias("b"), F.col("n").alias("n_b"))
        ordered = (F.length("a") > F.length("b")) | (F.col("a") > F.col("b"))
        pairs = a.join(b, _KEY).where(ordered & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")
        found = pairs if found is None else found.unionByName(pairs)
        level = told.where("crowded")
        if level.isEmpty():
            return found.distinct()
        level = _split(level)


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of the forms that follow each other from ``word, form``; every step doubles how far they are followed."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def with_forms(words: DataFrame, ratio: int = LEAST_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the distinct words of ``word, n``.

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near word of largest
    ``n``, of equal ones the first in code-point order, if that ``n`` is at least ``ratio`` times its own; its root is
    the last form that follows, or itself. Words that are null are left out; an empty table gives an empty result.
    """
    words = words.where("word IS NOT NULL").select("word", "n")
    pairs = written(near_words(words), "near")
    one, other = (pairs.select(*[F.col(c).alias(x) for c, x in zip(cs, ["word", "n", "other", "other_n"], strict=True)]) for cs in (["a", "n_a", "b", "n_b"], ["b", "n_b", "a", "n_a"]))
    fit = F.when(F.col("other_n") >= ratio * F.col("n"), F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("form")))
    near = written(one.unionByName(other).groupBy("word").agg(F.count("*").alias("n_near"), F.min(fit).alias("best")), "forms")
    roots = _roots(near.where("best IS NOT NULL").select("word", F.col("best.form").alias("form")))
    found = words.join(near, "word", "left").join(roots, "word", "left")
    return found.select(
        "word", F.col("best.form").alias("form"), F.coalesce("root", "word").alias("root"),
        "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), (-F.col("best.n")).alias("form_n"),
    )


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """``with_forms`` of the words that occur ``least`` times or more in ``docs``.

    A null text has no words and a null id is written as an empty one; repeated rows count as often as they stand there;
    other columns are not looked at; an empty table gives an empty result.
    """
    return with_forms(written(word_counts(docs, doc_id, text).where(F.col("n") >= least), "words"))
