"""One query per operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.snapshots import shared_dir
from . import (
    class_lm,
    exact_dedup,
    hard_negatives,
    html_text,
    language_id,
    minhash,
    mixing,
    packing,
    phrases,
    rules,
    substring_dedup,
    syncmers,
    warc,
)
from .common import table

TOKENIZER = "word_bpe_49k.json"
INDEX_BUCKETS = 32


def checksum_of_id(modulus: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def new_index(spark: SparkSession) -> exact_dedup.DigestIndex:
    name = f"digest_index_{uuid.uuid4().hex}"
    return exact_dedup.DigestIndex(spark, name, shared_dir(spark, "digest-index"), INDEX_BUCKETS)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.digest_rows(table(spark, sf_dir, "documents"))
    return exact_dedup.deduplicate(rows, new_index(spark), "documents")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = checksum_of_id(3) == 1
    model = language_id.fit(docs.filter(~held_out))
    flagged = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.identify(flagged, model).drop("text")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def op4_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    records = warc.read_records(index, with_html=False)
    broken = F.raise_error(F.concat(F.lit("payload of another digest: page "), F.col("page_id").cast("string")))
    return records.select(
        "page_id",
        "payload_bytes",
        F.when(F.col("intact"), F.col("payload_digest")).otherwise(broken).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents"), checksum_of_id(7) == 2)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op9_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = syncmers.fingerprints(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op10_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id") == F.col("component_id")
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(kept, F.lit(False)).alias("kept"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = checksum_of_id(3) == 1
    scored = rules.score(docs.withColumn("held_out", held_out), table(spark, sf_dir, "labels"), ~F.col("held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_language_id,
        op3_source_mixing,
        op4_sequence_packing,
        op5_main_text,
        op6_warc,
        op7_class_lm,
        op8_substring_dedup,
        op9_syncmer_fingerprints,
        op10_bbit_minhash,
        op11_collocations,
        op12_quality_rules,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op1_exact_dedup": r"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), placed AS (
  SELECT *, row_number() OVER best AS place,
         first_value(doc_id) OVER best AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM hashed
  WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM placed
""",
    "op3_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15))::BIGINT
           >> 20 AS bucket
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT (t.total - coalesce(sum(3 * b.source_size), 0)) / (t.weights - coalesce(sum(b.weight), 0)) AS level,
         a.source_size * 3 / a.weight AS bound
  FROM sources a CROSS JOIN (SELECT sum(source_size)::BIGINT AS total, sum(weight)::BIGINT AS weights FROM sources) t
  LEFT JOIN sources b ON b.source_size * a.weight < a.source_size * b.weight
  GROUP BY a.source, a.source_size, a.weight, t.total, t.weights
), target AS (
  SELECT source, source_size,
         least(weight * (SELECT max(level) FROM levels WHERE level <= bound), CAST(3 * source_size AS DOUBLE)) AS target
  FROM sources
), whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM target
), sums AS (
  SELECT source, bucket, sum(size) AS tokens,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket) AS upto
  FROM sized GROUP BY source, bucket
), ends AS (
  SELECT w.source, s.bucket,
         CASE WHEN s.upto - (w.target - w.times * w.source_size)
                 < (w.target - w.times * w.source_size) - (s.upto - s.tokens)
              THEN 1 ELSE 0 END AS closer
  FROM whole w JOIN sums s ON w.source IS NOT DISTINCT FROM s.source
  WHERE s.upto > w.target - w.times * w.source_size
    AND s.upto - s.tokens <= w.target - w.times * w.source_size
)
SELECT d.doc_id, d.size, w.source_size, w.target,
       CAST((w.times + CASE WHEN d.bucket < coalesce(e.bucket + e.closer, 0) THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM sized d
JOIN whole w ON w.source IS NOT DISTINCT FROM d.source
LEFT JOIN ends e ON e.source IS NOT DISTINCT FROM d.source
""",
    "op6_warc": r"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS newest,
         list_aggregate(list_transform(range(0, 8), lambda i:
           list_aggregate(list_transform([15, 10, 5, 0], lambda s:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    CAST((('0x' || substr(hex, CAST(i * 5 + 1 AS BIGINT), 5))::BIGINT >> s) & 31 AS BIGINT) + 1, 1)),
             'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM newest THEN NULL ELSE newest END AS refers_to
FROM coded
""",
    "op8_substring_dedup": r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(words) - 33)) AS place, words FROM texts WHERE len(words) >= 35
), hashed AS (
  SELECT r, place, md5(array_to_string(words[place : place + 34], ' ')) AS h FROM windows
), again AS (
  SELECT r, place FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM hashed) WHERE n > 1
), covered AS (
  SELECT DISTINCT r, place + k AS place FROM again, (SELECT unnest(range(0, 35)) AS k)
), single AS (
  SELECT r, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), left_over AS (
  SELECT s.r, count(c.place) AS n_removed, string_agg(s.word, ' ' ORDER BY s.place) FILTER (c.place IS NULL) AS kept
  FROM single s LEFT JOIN covered c ON c.r = s.r AND c.place = s.place GROUP BY s.r
)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, coalesce(l.n_removed, 0) AS n_removed,
       sha256(coalesce(l.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN left_over l USING (r)
""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS place FROM words
), grams AS (
  SELECT lang, k, array_to_string(words[place : place + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE place + k - 1 <= len(words)
), f AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS parts, count(*)::HUGEINT AS a
  FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, i, l.a AS l, r.a AS r, 2000000 * c.a // (l.a + r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM f WHERE k > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.parts[1 : i], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.parts[i + 1 : c.k], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), inside AS (
  SELECT lang, array_to_string(parts[i : i + n - 1], ' ') AS phrase, max(a) AS longer
  FROM f, (SELECT unnest([2, 2, 2, 3, 3]) AS n, unnest([1, 2, 3, 1, 2]) AS i)
  WHERE n < k AND i + n - 1 <= k GROUP BY ALL
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weakest w LEFT JOIN inside i USING (lang, phrase) WHERE coalesce(100 * i.longer < 80 * w.a, true)
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
""",
    "op13_hard_negatives": r"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.row <> b.row
), positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id NULLS LAST) AS INTEGER) AS rank
FROM positive p JOIN scored n
  ON n.anchor = p.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
""",
}
