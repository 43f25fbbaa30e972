"""One query per operator: production parameters, the whole intended table, the whole result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tabflow.llm import bpe, hmm, importance, jaccard, lexical, mixing, negatives, pieces, rules, search, sharding, simple8b, toxicity
from tabflow.llm.catalogue import query
from tabflow.llm.common import fold, word_count
from tabflow.sources.shared import new_path
from tabflow.sources.tables import table

WEIGHTS = [1, 2, 3]

OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws('|', '11', coalesce('=' || doc_id, '~'), coalesce('=' || text, '~'))), 1, 15)
              AS BIGINT) AS draw
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
  FROM sized GROUP BY source),
stops AS (SELECT *, CAST(3 * source_size AS DOUBLE) AS stop FROM sources),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY stop / weight, source) AS i,
         sum(stop) OVER (ORDER BY stop / weight, source) - stop AS held,
         sum(weight) OVER (ORDER BY stop / weight DESC, source DESC) AS free
  FROM stops),
levels AS (
  SELECT i, weight, stop, ((SELECT CAST(sum(size) AS DOUBLE) FROM sized) - held) / free AS level FROM ranked),
chosen AS (SELECT min_by(level, i) AS level FROM levels WHERE weight * level < stop),
targets AS (
  SELECT source, source_size,
         CASE WHEN weight * level >= stop OR level IS NULL THEN stop ELSE weight * level END AS target
  FROM stops, chosen),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
running AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, CAST(p.whole AS BIGINT) AS whole,
         target - p.whole * p.source_size AS quota,
         2 * sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw RANGE UNBOUNDED PRECEDING) - s.size AS middle
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN quota > 0 AND middle <= 2 * quota THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running"""


@query("op1_mix_sources", OP1_SQL)
def op1_mix_sources(spark, root):
    docs = table(spark, root, "documents")
    mixed = mixing.mix(docs, word_count(F.col("text")), WEIGHTS)
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", taken)


@query("op2_shard_by_key")
def op2_shard_by_key(spark, root):
    placed = sharding.shards_by_key(table(spark, root, "documents"), shards=8)
    return placed.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard",
    )


OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS h FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) AS g
  FROM words WHERE len(w) >= 3),
repeated AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, source, h, line,
         array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+'), ' ') AS normal,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, source, h, unnest(string_split(text, chr(10))) AS line FROM docs)),
duplicates AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE n > 0 GROUP BY r),
per_text AS (
  SELECT source, h, normal, max(n) AS n
  FROM (SELECT r, source, h, normal, sum(n) AS n FROM lines WHERE n > 0 GROUP BY ALL) GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT h) AS of_host FROM docs GROUP BY source),
frequent AS (
  SELECT p.source, p.normal FROM per_text p JOIN hosts o ON p.source IS NOT DISTINCT FROM o.source
  GROUP BY p.source, p.normal, o.of_host HAVING count(*) > 50 AND count(*) > o.of_host * 0.002),
removed AS (
  SELECT p.source, p.h, sum(p.n) AS gone
  FROM per_text p JOIN frequent f ON p.source IS NOT DISTINCT FROM f.source AND p.normal = f.normal GROUP BY ALL),
counted AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone, 0) AS BIGINT) AS n_removed_words
  FROM docs d JOIN words USING (r) LEFT JOIN duplicates USING (r) LEFT JOIN covered USING (r)
  LEFT JOIN removed g ON d.source IS NOT DISTINCT FROM g.source AND d.h = g.h)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND n_words - n_removed_words >= n_words * CAST(0.3 AS DOUBLE) AS kept
FROM counted"""


@query("op4_line_frequency", OP4_SQL)
def op4_line_frequency(spark, root):
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    judged = rules.judge(rules.measure(table(spark, root, "documents")), failed)
    return judged.select(F.col("key").alias("doc_id"), *rules.COUNTS, "n_removed_words", "base_failed", "kept")


OP8_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query("op8_exact_top_k", OP8_SQL)
def op8_exact_top_k(spark, root):
    return search.top_k(table(spark, root, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_bpe")
def op6_bpe(spark, root):
    spec = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_documents(table(spark, root, "documents"), spec, ["doc_id"])
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_simple8b_files")
def op10_simple8b_files(spark, root):
    path = new_path(spark, "ids")
    simple8b.write_ids(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return simple8b.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_toxic_segments")
def op7_toxic_segments(spark, root):
    docs = table(spark, root, "documents")
    judged = toxicity.toxicity(toxicity.fit(docs, table(spark, root, "labels")), docs)
    scored = docs.select("doc_id", judged("text").alias("found"))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("found.score").alias("score"),
        F.when(F.col("found.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("found.passages").alias("n_passages"),
    )


@query("op9_importance_resampling")
def op9_importance_resampling(spark, root):
    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    sampled = importance.sample_documents(docs, labels)
    held_out = (fold(F.col("key")) == 0).alias("held_out")
    return sampled.select(F.col("key").alias("doc_id"), held_out, "log_weight", "score", "kept")


@query("op3_hidden_markov")
def op3_hidden_markov(spark, root):
    scored = hmm.score_documents(table(spark, root, "documents"), fold(F.col("doc_id")) == 1)
    columns = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select(F.col("key").alias("doc_id"), *columns)


OP5_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS s FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * o >= 75 * (p.n + q.n - o)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT doc_id, doc_id AS r FROM docs UNION SELECT doc_id, y FROM reached JOIN ways ON r = x)
SELECT doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


@query("op5_jaccard_groups", OP5_SQL)
def op5_jaccard_groups(spark, root):
    found = jaccard.groups(table(spark, root, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", "component_id")


@query("op11_prefix_table")
def op11_prefix_table(spark, root):
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_documents(table(spark, root, "documents"), model, ["doc_id"])
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP12_SQL = r"""
WITH spelled AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sized AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM spelled WHERE len(w) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
tfs AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM sized) GROUP BY ALL),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, whole GROUP BY term, docs),
scores AS (
  SELECT a.item_id, r, CAST(sum(weights.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked a JOIN tfs USING (term) JOIN weights USING (term) JOIN sized USING (r), whole GROUP BY a.item_id, r),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS FIRST) AS INTEGER) AS rank
  FROM scores JOIN sized USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""


@query("op12_max_sketches", OP12_SQL)
def op12_max_sketches(spark, root):
    return lexical.ranked_documents(table(spark, root, "documents"), table(spark, root, "benchmark"), k=50)


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scores WHERE alike),
ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scores n
    ON p.anchor_id = n.anchor_id AND place <= 5 AND NOT alike
   AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10"""


@query("op13_shared_lists", OP13_SQL)
def op13_shared_lists(spark, root):
    rows = table(spark, root, "embeddings").select("vec_id", "embedding", "label")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", turned), F.col("vec_id") % 100 == 0)
