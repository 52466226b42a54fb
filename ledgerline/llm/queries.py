"""The queries over the corpus tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, chunk_pieces, decontamination, fingerprints, hard_negatives, line_dedup, merkle, prefix_trees, resampling, simhash, suffix_buckets, url_filter, warc
from ledgerline.llm.common import table

URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


GOOD = "quality = 1 AND toxic = 0"


def op1_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """The documents kept: labelled good ones are the target."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    kept = resampling.resample(docs, labels, GOOD)
    return kept.select("doc_id", "log_weight", "sample_key", "n_features")


def op2_suffix_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the strings of 200 bytes that start elsewhere too."""
    return suffix_buckets.remove_repeats(table(spark, folder, "documents", "doc_id", "text"), digest=True)


OP2_SQL = """
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, s, md5(substr(x, 2 * s + 1, 400)) AS m
  FROM (SELECT doc_id, x, unnest(range(0, n - 199)) AS s FROM d WHERE n >= 200)
), r AS (
  SELECT doc_id, s FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)
), i AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS new FROM r
), g AS (
  SELECT doc_id, min(s) AS a, max(s) + 200 AS b
  FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM i) GROUP BY doc_id, run
), k AS (
  SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS o
  FROM g
), t AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, min(a) AS first,
    string_agg(substr(x, 2 * b + 1, 2 * (coalesce(next, n) - b)), '' ORDER BY o) AS tail
  FROM k JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN removed IS NULL THEN x ELSE substr(x, 1, 2 * first) || tail END)) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and benchmark item found in it."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return decontamination.find_items(docs, table(spark, folder, "benchmark", "item_id", "text"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text to ids and back."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return bpe.tokens(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url against the rules; the classifier judges the others."""
    pages = table(spark, folder, "pages", "page_id", "url")
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.filter_urls(pages, URL_RULES, model)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the repeated chunks of lines."""
    return line_dedup.dedup_lines(table(spark, folder, "documents", "doc_id", "text"))


OP7_SQL = """
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), h AS (
  SELECT *, list_transform(lines, lambda s: CAST('0x' || substr(md5(s), 1, 7) AS BIGINT)) AS h FROM d
), s AS (
  SELECT doc_id, lines, list_prepend(1, list_filter(range(2, len(lines) + 1), lambda i:
    ((CASE WHEN i >= 3 THEN h[i - 2] ELSE 0 END) * 131 + h[i - 1]) % 1000003 % 4 = 0)) AS starts
  FROM h
), k AS (
  SELECT doc_id, lines, starts, unnest(range(1, len(starts) + 1)) AS k FROM s
), c AS (
  SELECT doc_id, k, starts[k] AS a, coalesce(starts[k + 1], len(lines) + 1) AS b,
    array_to_string(lines[starts[k] : coalesce(starts[k + 1], len(lines) + 1) - 1], chr(10)) AS body
  FROM k
), r AS (
  SELECT doc_id, a, b FROM (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS n FROM c
    WHERE b - a >= 2 AND regexp_matches(body, '[^ \\n]')
  ) WHERE n > 1
), g AS (
  SELECT doc_id, flatten(list(range(a, b))) AS removed FROM r GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(lines) AS INTEGER) AS n_lines, CAST(coalesce(len(removed), 0) AS INTEGER) AS n_removed,
  array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i:
    NOT list_contains(coalesce(removed, []), i)), lambda i: lines[i]), chr(10)) AS text
FROM d LEFT JOIN g USING (doc_id)
"""


def op8_prefix_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the windows of 20 words that start earlier too."""
    return prefix_trees.remove_repeats(table(spark, folder, "documents", "doc_id", "text"), digest=True)


OP8_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, s, md5(array_to_string(words[s : s + 19], ' ')) AS m
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM d WHERE len(words) >= 20)
), r AS (
  SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) AS o FROM w) WHERE o > 1
), c AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM r
), g AS (
  SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id
), e AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d
), k AS (
  SELECT e.doc_id, string_agg(words[e.p], ' ' ORDER BY e.p) AS kept
  FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.p = c.p WHERE c.p IS NULL GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Bottom-k sketches of every text, its edited text and the next text."""
    return fingerprints.edit_likeness(table(spark, folder, "documents", "doc_id", "text"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to WARC archives and back."""
    return warc.archive_pages(table(spark, folder, "pages", "page_id", "url", "html"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), d AS (
  SELECT page_id, payload_bytes, hex, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (CAST('0x' || substr(hex, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31
      AS INTEGER), 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text to pieces and back."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return chunk_pieces.tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True, bare=True)



def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh row has the next label."""
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    label = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return hard_negatives.mine(rows, "id % 100 = 0", label=label)


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.r AS b, b.vec_id AS id,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), p AS (
  SELECT a, anchor_id, b AS p, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) AS o FROM s WHERE same) WHERE o <= 5
), n AS (
  SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p ORDER BY score DESC, id, b) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""



def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; one document in seven claims another length."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    docs = table(spark, folder, "documents", *fields)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    longer = F.when(tampered, F.try_add(F.col("n_chars"), F.lit(1).cast("long"))).otherwise(F.col("n_chars"))
    return merkle.manifest(docs, fields, claimed={"n_chars": longer})


OP13_SQL = """
WITH RECURSIVE f AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
    list_reduce(list_prepend(4294967295, range(0, 8 * length(CAST(doc_id AS VARCHAR)))), lambda c, b: xor(
      xor(c, CASE WHEN b % 8 = 0 THEN ascii(substr(CAST(doc_id AS VARCHAR), b // 8 + 1, 1)) ELSE 0 END) >> 1,
      3988292384 * (xor(c, CASE WHEN b % 8 = 0 THEN ascii(substr(CAST(doc_id AS VARCHAR), b // 8 + 1, 1)) ELSE 0 END) & 1))) AS crc
  FROM documents
), d AS MATERIALIZED (
  SELECT doc_id, lang, leaf, claim, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, r,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM (SELECT *, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
      sha256(head || coalesce(length(CAST(n_chars + t AS VARCHAR)) || ':' || (n_chars + t), '-') || tail) AS claim
    FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS t FROM f))
), w AS (
  SELECT 0 AS level, tree, i, leaf AS h FROM d
  UNION ALL
  SELECT level + 1, tree, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM w) WHERE n > 1 GROUP BY level, tree, i // 2
), top AS MATERIALIZED (
  SELECT tree, max(level) AS levels, arg_max(h, level) AS subroot FROM w GROUP BY tree
), u AS (
  SELECT 0 AS level, tree AS i, subroot AS h FROM top
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY level, i // 2
), node AS MATERIALIZED (
  SELECT level, tree, i, h FROM w UNION ALL SELECT level, -1, i, h FROM u
), step AS MATERIALIZED (
  SELECT d.r, s.step, s.place & 1 AS odd, coalesce(node.h, '') AS other
  FROM (
    SELECT r, tree, unnest(range(0, levels)) AS step, i >> unnest(range(0, levels)) AS place, unnest(range(0, levels)) AS level, tree AS own
    FROM d JOIN top USING (tree)
    UNION ALL
    SELECT r, tree, levels + unnest(range(0, (SELECT max(level) FROM u))), tree >> unnest(range(0, (SELECT max(level) FROM u))),
      unnest(range(0, (SELECT max(level) FROM u))), -1
    FROM d JOIN top USING (tree)
  ) s JOIN d ON s.r = d.r LEFT JOIN node ON node.tree = s.own AND node.level = s.level AND node.i = xor(s.place, 1)
), fold AS (
  SELECT r, 0 AS step, claim AS h FROM d
  UNION ALL
  SELECT fold.r, fold.step + 1, sha256(CASE WHEN odd = 1 THEN other || h ELSE h || other END)
  FROM fold JOIN step ON fold.r = step.r AND fold.step = step.step
), proof AS (
  SELECT r, string_agg(other, '' ORDER BY step) AS p FROM step GROUP BY r
), last AS (
  SELECT r, arg_max(h, step) AS h FROM fold GROUP BY r
)
SELECT doc_id, leaf, subroot, (SELECT arg_max(h, level) FROM u) AS root, sha256(coalesce(p, '')) AS proof_sha256,
  last.h AS folded_root, last.h = (SELECT arg_max(h, level) FROM u) AS verified
FROM d JOIN top USING (tree) JOIN last USING (r) LEFT JOIN proof USING (r)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_suffix_buckets": op2_suffix_buckets,
    "op3_decontamination": op3_decontamination,
    "op4_bpe": op4_bpe,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_prefix_trees": op8_prefix_trees,
    "op9_fingerprints": op9_fingerprints,
    "op10_warc": op10_warc,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle": op13_merkle,
}
ORACLES: dict[str, str] = {
    "op2_suffix_buckets": OP2_SQL,
    "op7_line_dedup": OP7_SQL,
    "op8_prefix_trees": OP8_SQL,
    "op10_warc": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_merkle": OP13_SQL,
}
