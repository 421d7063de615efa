"""The registered queries of the operators in this folder and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrain.llm import (
    chaining,
    collocations,
    hard_negatives,
    line_dedup,
    minhash,
    orc_ids,
    pii,
    prefix_join,
    quality,
    sentencepiece_fst,
    toxicity,
    urls,
    wumanber,
)
from haulgrain.llm.shared import hex_sha256, importable, new_folder, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents")).drop("_text_key")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", "runs", hex_sha256(F.coalesce("text", F.lit(""))).alias("text_sha256"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wumanber.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("hits", "items")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), urls.labelled_urls(spark))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepiece_fst.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "round_trip")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("rejected_by")


def op10_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-ids")
    orc_ids.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return orc_ids.checksums(orc_ids.read_ids(spark, folder))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.jaccard_components(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"

DECONTAMINATION_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{wumanber.WORD}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{wumanber.WORD}') AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
), hits AS (
  SELECT g.doc_id, g.i, g.n, v.item_id FROM grams g JOIN windows v ON g.win = v.win AND g.n = v.n
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
"""

LINE_DEDUP_SQL = r"""
WITH split AS (
  SELECT doc_id, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: x) AS ls, text FROM documents
), lines AS (
  SELECT doc_id, i, l, regexp_matches(l, '[^\x20\x09-\x0D]') AS filled,
    count(*) FILTER (WHERE regexp_matches(l, '[^\x20\x09-\x0D]')) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS nth,
    translate(regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM split)
), filled AS (SELECT doc_id, nth - 1 AS p, norm FROM lines WHERE filled), windows AS (
  SELECT doc_id, p, norm || chr(10) || lead(norm, 1) OVER w || chr(10) || lead(norm, 2) OVER w AS win
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT doc_id, p FROM windows WHERE win IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, p) > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 3)) AS p FROM later), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 1 AS b
  FROM (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM gone) GROUP BY doc_id, g
), named AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_deleted, string_agg(a || '-' || b, ',' ORDER BY a) AS runs FROM runs GROUP BY doc_id
), texts AS (
  SELECT l.doc_id, count(*) FILTER (WHERE l.filled) AS n_lines,
    coalesce(string_agg(l.l, chr(10) ORDER BY l.i) FILTER (WHERE g.p IS NULL OR NOT l.filled), '') AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.p = l.nth - 1 GROUP BY l.doc_id
)
SELECT t.doc_id, n_lines, coalesce(n_deleted, 0) AS n_deleted, coalesce(runs, '') AS runs, sha256(t.text) AS text_sha256
FROM texts t LEFT JOIN named n ON n.doc_id = t.doc_id
"""

def _components_sql(k: int, percent: int, last: str) -> str:
    """Components of documents whose sets of k words are at least ``percent`` alike."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= {percent} * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.other
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id{last}
FROM documents d JOIN reach r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


NEAR_DEDUP_SQL = _components_sql(5, 75, ", min(r.other) = d.doc_id AS kept")
JACCARD_JOIN_SQL = _components_sql(3, 90, "")

COLLOCATIONS_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)
), f AS (SELECT lang, m, g, count(*)::HUGEINT AS f, string_split(g, ' ') AS w FROM grams GROUP BY lang, m, g
), totals AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang
), candidates AS (SELECT lang, m, g, w, f AS a FROM f WHERE m >= 2 AND f >= 10
), cuts AS (
  SELECT c.lang, c.m, c.g, c.a, k, x.f AS l, y.f AS r, (c.a * c.a * 1000000) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.g = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.g = array_to_string(c.w[k + 1:], ' ')
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), held AS (
  SELECT lang, g, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g FROM candidates WHERE m = 3) GROUP BY lang, g
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.g = s.g WHERE h.longer IS NULL OR 100 * h.longer < 50 * s.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY rank <= 2000
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 10
"""

QUALITY_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents
), lines AS (
  SELECT doc_id, sum(c - 1) AS n_dup_lines FROM (
    SELECT doc_id, l, count(*) AS c FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
    WHERE regexp_matches(l, '{_WORDS}') GROUP BY ALL) GROUP BY doc_id
), grams AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, t, w, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    (length(t) - length(replace(t, chr(10), '')))::BIGINT AS breaks,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]') AND strlen(x) > 1)) AS shouted,
    length(t) - length(replace(t, '|', '')) AS bars,
    length(t) - length(regexp_replace(t, '[.!?]', '', 'g')) AS ends
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > word_chars) AND NOT (10 * n_dup_lines > 3 * breaks + 3)
  AND NOT (word_chars < 2 * n_words OR word_chars > 15 * n_words) AND NOT (2 * shouted > n_words)
  AND NOT (5 * bars > n_words) AND NOT (500 * ends < n_words) AS kept
FROM judged
"""

QUERIES = {
    query.__name__: importable(query)
    for query in (
        op1_toxicity,
        op2_substring_chaining,
        op3_line_dedup,
        op4_benchmark_decontamination,
        op5_url_filter,
        op6_personal_data,
        op7_sentencepiece,
        op8_minhash_near_dedup,
        op9_quality_cascade,
        op10_orc_token_ids,
        op11_jaccard_join,
        op12_collocations,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op3_line_dedup": LINE_DEDUP_SQL,
    "op4_benchmark_decontamination": DECONTAMINATION_SQL,
    "op8_minhash_near_dedup": NEAR_DEDUP_SQL,
    "op9_quality_cascade": QUALITY_SQL,
    "op11_jaccard_join": JACCARD_JOIN_SQL,
    "op12_collocations": COLLOCATIONS_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
