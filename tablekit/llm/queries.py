"""One query per operator over its whole table, and the SQL that states the same result where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import (
    exact_dedup, html_main, jaccard_join, line_dedup, merkle, mixing, order_minhash, quality, sentencepiece_bpe,
    substring_dedup, suffix_dedup, toxicity, vector_codes,
)

#: Where the vocabulary lies; the same path on every machine.
PIECE_MODEL = "piece_bpe_32k.model"


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_bpe.encode_digests(_docs(spark, folder), piece_model()).withColumnRenamed("id", "doc_id")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(_docs(spark, folder))
    return done.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keys AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keys WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (
  SELECT k.doc_id, k.pos, k.line, (r.key IS NOT NULL AND k.doc_id <> r.keeper) AS dropped
  FROM keys k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_docs(spark, folder)).withColumnRenamed("id", "doc_id")


OP7_SQL = r"""
WITH facts AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('7:' || CAST(doc_id AS VARCHAR)) AS place
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM facts GROUP BY source),
named AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         source_size::DOUBLE * 3 AS cap FROM sizes),
levels AS (
  SELECT *, cap / weight AS ratio,
         (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (
            ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM named),
targets AS (
  SELECT source, source_size, least(cap, coalesce(
           (SELECT arg_min(level, ratio) FROM levels WHERE level < ratio) * weight, cap)) AS target FROM levels),
whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 3) AS BIGINT) ELSE 0 END AS whole
  FROM targets),
placed AS (
  SELECT f.*, w.source_size, w.target, w.whole,
         sum(f.size) OVER (PARTITION BY f.source ORDER BY f.place) - f.size / 2.0 <= w.target - w.whole * w.source_size
           AS extra
  FROM facts f JOIN whole w ON f.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target, whole + extra::BIGINT AS copies, size * (whole + extra::BIGINT) AS taken
FROM placed
"""


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = substring_dedup.dedup_substrings(_docs(spark, folder))
    return done.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows)
  WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later)
SELECT d.doc_id, any_value(len(d.w)) AS n_words, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(p.word, ' ' ORDER BY p.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM words d LEFT JOIN placed p ON p.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i
GROUP BY d.doc_id
"""


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_groups(_docs(spark, folder)).withColumnRenamed("id", "doc_id")


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                    FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


def op5_html_main(spark: SparkSession, folder: str) -> DataFrame:
    done = html_main.extract_main(spark.read.parquet(f"{folder}/pages.parquet"))
    return done.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    probe = order_minhash.edit_probe(_docs(spark, folder))
    return probe.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.fingerprint_text("signature").alias("fingerprint"),
        order_minhash.fingerprint_text("edited_signature").alias("edited_fingerprint"),
        order_minhash.likeness("signature", "edited_signature").alias("near_edited"),
        order_minhash.likeness("signature", "next_signature").alias("near_next"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return (quality.judge(_docs(spark, folder))
            .select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "quality"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.dedup_bytes(_docs(spark, folder))
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_toxicity(_docs(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(spark.read.parquet(f"{folder}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


def _assigned_sql(books: str, out: str) -> str:
    """Squared distance and entry of every part as one number, distance * 64 + entry, so that ties go to the lower entry."""
    return f"""{out} AS (
  SELECT vec_id, c.p, min(list_sum(list_transform(range(1, len(c.part) + 1),
                                                  lambda i: (c.part[i] - b.part[i]) * (c.part[i] - b.part[i]))) * 64 + b.e) AS near
  FROM parts c JOIN {books} b ON c.p = b.p GROUP BY vec_id, c.p)"""


def _refined_sql(books: str, near: str, out: str) -> str:
    return f"""{out} AS (
  SELECT b.p, b.e, coalesce(m.part, b.part) AS part FROM {books} b LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS part FROM (
      SELECT c.p, (near % 64)::BIGINT AS e, i, sum(c.part[i]) AS s, count(*) AS n
      FROM (SELECT *, unnest(range(1, len(part) + 1)) AS i FROM parts) c JOIN {near} a ON a.vec_id = c.vec_id AND a.p = c.p
      GROUP BY ALL) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""


OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS part
  FROM (SELECT vec_id, v, unnest(range(16)) AS p FROM kept)),
books0 AS (
  SELECT * FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part FROM parts) WHERE e < 64),
{_assigned_sql("books0", "near0")},
{_refined_sql("books0", "near0", "books1")},
{_assigned_sql("books1", "near1")},
{_refined_sql("books1", "near1", "books2")},
{_assigned_sql("books2", "near2")},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', (near % 64)::BIGINT), '' ORDER BY p) AS code,
         CAST(sum(near // 64) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) FROM books2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder)
    stripped = F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 2 == 0,
                      F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = merkle.document_proofs(docs, stripped).withColumn("folded_root", merkle.folded(F.col("changed"), "path"))
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                         merkle.proof_digest("path").alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def _field_sql(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_field_sql(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes (tree, level, pos, digest) over ``leaves`` (tree, pos, digest)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, pos, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 2) // 3)
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3)"""


# crc32 is even if its last bit, inverted, is not set; -1 stands for one shift, other numbers for a byte that comes in
OP12_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql('text')} AS digest,
         CASE WHEN list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT)
                          ELSE c // 2 END) % 2 = 1
         THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS changed
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos FROM docs),
{_tree_sql("nodes", "leaves")},
tops AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, tree AS source FROM nodes WHERE n = 1),
{_tree_sql("upper_nodes", "tops")},
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
whole AS (
  SELECT tree, level, pos, digest FROM nodes WHERE n > 1
  UNION ALL SELECT 'top', level, pos, digest FROM upper_nodes WHERE n > 1),
starts AS (
  SELECT l.doc_id, l.tree, l.pos, l.digest AS leaf, l.changed, t.digest AS subroot, t.pos AS top_pos, h.height,
         (SELECT digest FROM upper_nodes WHERE n = 1) AS root,
         h.height + (SELECT max(level) FROM upper_nodes) AS steps
  FROM leaves l JOIN tops t ON t.source = l.tree JOIN heights h ON h.tree = l.tree),
walk AS (
  SELECT doc_id, 0 AS step, changed AS folded, '' AS siblings FROM starts
  UNION ALL
  SELECT w.doc_id, any_value(w.step) + 1,
         sha256(string_agg(CASE WHEN n.pos = p.own THEN w.folded ELSE n.digest END, '' ORDER BY n.pos)),
         any_value(w.siblings) || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (WHERE n.pos <> p.own), '')
  FROM walk w
  JOIN (SELECT s.doc_id, k.step, CASE WHEN k.step < s.height THEN s.tree ELSE 'top' END AS tree,
               CASE WHEN k.step < s.height THEN k.step ELSE k.step - s.height END AS level,
               CASE WHEN k.step < s.height THEN s.pos // CAST(pow(3, k.step) AS BIGINT)
                    ELSE s.top_pos // CAST(pow(3, k.step - s.height) AS BIGINT) END AS own
        FROM starts s JOIN (SELECT unnest(range(64)) AS step) k ON k.step < s.steps) p
    ON p.doc_id = w.doc_id AND p.step = w.step
  JOIN whole n ON n.tree = p.tree AND n.level = p.level AND n.pos // 3 = p.own // 3
  GROUP BY w.doc_id)
SELECT s.doc_id, s.leaf, s.subroot, s.root, sha256(w.siblings) AS proof_sha256, w.folded AS folded_root,
       w.folded = s.root AS verified
FROM starts s JOIN walk w ON w.doc_id = s.doc_id AND w.step = s.steps
"""


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = exact_dedup.dedup_exact(spark, f"{folder}/documents.parquet")
    return done.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


OP13_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_line_dedup": op2_line_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_html_main": op5_html_main,
    "op6_order_minhash": op6_order_minhash,
    "op7_source_mix": op7_source_mix,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_exact_dedup": op13_exact_dedup,
}
ORACLE = {
    "op2_line_dedup": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op4_jaccard_join": OP4_SQL, "op7_source_mix": OP7_SQL,
    "op11_vector_codes": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_exact_dedup": OP13_SQL,
}
