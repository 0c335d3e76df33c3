"""The registered query of each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import block_tables, collision_counting, cover_tree, cross_parse, curve_packing, divergence_skyband, induced_sort, log_bilinear, mixing, quote_threads, segment_popcount, spelling_chunks, toxicity
from tidemark.llm.common import written
from tidemark.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_segment_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_popcount.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, names = mixing.mix_plan(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = F.col(names["size"]) * F.col(names["copies"])
    return plan.select("doc_id", names["size"], names["source_size"], names["target"], taken.alias("taken"))


ORACLES["op3_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM totals
), summed AS (
  SELECT *, sum(source_size) OVER () AS sum_size, sum(weight) OVER () AS sum_weight,
    coalesce(sum(source_size) OVER w, 0) AS full_size, coalesce(sum(weight) OVER w, 0) AS full_weight
  FROM weighted WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
  SELECT *, (sum_size - 3 * full_size)::DOUBLE / (sum_weight - full_weight)::DOUBLE AS share FROM summed
), level AS (
  SELECT arg_min(share, full_weight) AS level FROM shares WHERE source_size * 3 >= share * weight
), targets AS (
  SELECT source, source_size, least((source_size * 3)::DOUBLE, coalesce(level * weight, (source_size * 3)::DOUBLE)) AS target FROM shares, level
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0.0::DOUBLE END AS rate FROM targets
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate) + CASE WHEN rate - floor(rate) >
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|mix'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 THEN 1 ELSE 0 END)::BIGINT AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""


@query
def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = written(block_tables.edited_fingerprints(read_table(spark, sf_dir, "documents")), "prints")
    return block_tables.count_near(prints).drop("hi", "lo")


@query
def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(read_table(spark, sf_dir, "embeddings"))


ORACLES["op2_cover_tree"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), parts AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM parts
"""


@query
def op4_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_threads.link_quotations(read_table(spark, sf_dir, "conversations"))


@query
def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(read_table(spark, sf_dir, "documents"))


@query
def op10_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_parse.with_languages(read_table(spark, sf_dir, "documents"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.with_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op6_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.with_scores(read_table(spark, sf_dir, "documents"))


@query
def op9_induced_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return induced_sort.remove_repeats(docs).drop("text")


@query
def op11_spelling_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_chunks.variants(read_table(spark, sf_dir, "documents"))


# CRC-32 is worked out byte by byte from its table; near words are found by the words with one code point left out.
ORACLES["op11_spelling_chunks"] = r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS named, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(named)) AS x FROM counted
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM bytes, steps
), edited AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), shorter AS (
  SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM words, range(100) r(k) WHERE k < length(word)
), near AS (
  SELECT a.word AS word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
), forms AS (
  SELECT w.word, w.n, count(other) AS n_near, arg_min(other, (-other_n, other)) FILTER (WHERE other_n >= 5 * w.n) AS form FROM words w LEFT JOIN near USING (word) GROUP BY ALL
), roots AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL UNION ALL SELECT f.word, r.root FROM roots r JOIN forms f ON f.form = r.word
)
SELECT f.word, f.form, r.root, f.n, f.n_near, g.n AS form_n FROM forms f JOIN roots r ON f.word = r.word LEFT JOIN words g ON f.form = g.word
"""


@query
def op12_divergence_skyband(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_skyband.divergence(read_table(spark, sf_dir, "documents"))


# Every kept term is written out for every group, counted or not.
ORACLES["op12_divergence_skyband"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), terms AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM terms GROUP BY ALL
), filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n,
    (1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w))::HUGEINT AS p,
    (1 + (1000000000::HUGEINT * (lang_n + 1)) // (sum(lang_n) OVER w + count(*) OVER w))::HUGEINT AS q
  FROM filled WINDOW w AS (PARTITION BY lang, source)
), pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN pair_sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
), tops AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (FROM pairs UNION ALL FROM tops)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query
def op13_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_counting.nearest(read_table(spark, sf_dir, "embeddings"))


ORACLES["op13_collision_counting"] = """
WITH usable AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(a.v, b.v) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM pairs
)
SELECT * FROM ranked WHERE rank <= 5
"""
