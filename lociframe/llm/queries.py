"""The corpus operators' queries, each over its whole intended table, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import functools
import re
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import centroids, chat, line_dedup, merkle, near_dup, ngram_join, packing, pieces, pii, quality_rules, shared, topk, url_filter, warc
from lociframe.session import ship

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CONTROL = "</s>[INST] ok [/INST]"

# n_turns and the digests follow from the turns alone; formatted_chars adds, for each turn, its markers and one
# backslash for each control string.
OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
    length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '(?:</?s|\[/?(?:INST|OUT)|\[(?:IMG|AUD|DOC):\d*)\\*[>\]]'))
      + 3 + 4 + CASE WHEN role = 'assistant' THEN 5 + 6 ELSE 6 + 7 END AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(shown) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM e GROUP BY conv_id"""


@query("op1_chat_formatting", OP1_SQL)
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    parts = turns.select("conv_id", "turn", "role", chat.text_part(F.coalesce("text", F.lit(""))).alias("parts"))
    return chat.digests(chat.read_back(chat.format_conversations(parts)))


@query("op2_url_filters")
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested on planted combinations and long urls: SQL has no FP-growth."""
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


OP4_SQL = """
WITH w AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM w q JOIN w c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


@query("op4_exact_top_k", OP4_SQL)
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_numbers(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors, k=10)


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against a brute-force tokenization and the plan's invariants: SQL has no tokenizer."""
    documents = table(spark, sf_dir, "documents")
    pieces = packing.tokenize_pieces(documents, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces, partitions=packing.partitions_for(documents))


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled ids of every document, decoded again in the same pass; tested against enumerated paths and for exact round trips."""
    ids = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), check=True)
    return ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "lossless")


@query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against brute force over all pairs: the classes of SQL would need a recursive join."""
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT payload, max(page_id) AS largest, count(*) AS n FROM p WHERE strlen(payload) >= {warc.MIN_REVISIT} GROUP BY payload)
SELECT p.page_id, strlen(p.payload) AS payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN n > 1 AND largest IS NOT NULL AND (p.page_id IS NULL OR p.page_id < largest) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n > 1 AND largest IS NOT NULL AND (p.page_id IS NULL OR p.page_id < largest) THEN largest END AS refers_to
FROM p LEFT JOIN d USING (payload)"""


@query("op7_warc", OP7_SQL)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared.shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    index = shared.cut(warc.write(warc.dedup_plan(table(spark, sf_dir, "pages")), folder), "warc-index")
    return warc.read(folder, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against brute force over all pairs of lines: SQL has the distance but not the classes."""
    return line_dedup.judge(table(spark, sf_dir, "documents")).drop("digest")


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts are tested against brute force, the field on held-out labels."""
    documents = table(spark, sf_dir, "documents")
    return quality_rules.judge(documents, quality_rules.train(documents, table(spark, sf_dir, "labels")))


@query("op10_pii_surrogates")
def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested for round properties: coreference, distinctness, format; SQL has no keyed permutation."""
    return pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.query_key(spark))


OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, lang, n_chars,
    sha256(concat(H(doc_id), H(source), H(lang), H(n_chars), H(text))) AS leaf,
    sha256(concat(H(doc_id), H(source), H(lang), H(n_chars), H(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS low,
    list_reduce(list_prepend(4294967295, flatten([[ascii(CAST(c AS VARCHAR)), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
      lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1))) AS crc FROM documents),
p AS (
  SELECT *, coalesce('1' || source, '0') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS id,
    CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN low ELSE leaf END AS changed FROM d),
a AS (
  SELECT tree, 0 AS level, pos AS idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS m FROM p
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(m) + 15) // 16 FROM a WHERE m > 1 GROUP BY tree, level, idx // 16),
s AS (SELECT tree, level AS height, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM a WHERE m = 1),
b AS (
  SELECT 0 AS level, pos AS idx, subroot AS digest, count(*) OVER () AS m FROM s
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(m) + 15) // 16 FROM b WHERE m > 1 GROUP BY level, idx // 16),
n AS (SELECT tree, level, idx, digest FROM a WHERE m > 1 UNION ALL SELECT '', level, idx, digest FROM b WHERE m > 1),
k AS (
  SELECT tree, level, idx,
    coalesce(string_agg(digest, '') OVER (PARTITION BY tree, level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (PARTITION BY tree, level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM n),
f AS (
  SELECT id, tree, 0 AS level, pos AS idx, changed AS digest, '' AS proof FROM p
  UNION ALL
  SELECT id, f.tree, f.level + 1, f.idx // 16, sha256(l || digest || r), proof || l || r FROM f JOIN k ON k.tree = f.tree AND k.level = f.level AND k.idx = f.idx),
g AS (
  SELECT f.id, 0 AS level, s.pos AS idx, f.digest, f.proof FROM f JOIN s ON s.tree = f.tree AND s.height = f.level
  UNION ALL
  SELECT id, g.level + 1, g.idx // 16, sha256(l || digest || r), proof || l || r FROM g JOIN k ON k.tree = '' AND k.level = g.level AND k.idx = g.idx)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, sha256(g.proof) AS proof_sha256, g.digest AS folded_root, g.digest = t.digest AS verified
FROM p JOIN s ON s.tree = p.tree JOIN b t ON t.m = 1 JOIN g ON g.id = p.id AND g.level = t.level"""
OP11_SQL = re.sub(r"\bH\((\w+)\)", r"coalesce(strlen(CAST(\1 AS VARCHAR)) || ':' || CAST(\1 AS VARCHAR), '-')", OP11_SQL)
OP11_SQL = re.sub(r"\bH\((translate\([^)]*\))\)", r"coalesce(strlen(\1) || ':' || \1, '-')", OP11_SQL)


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_sql(k: int = centroids.K, rounds: int = centroids.ROUNDS) -> str:
    """Each round as two common table expressions: the nearest centroid of each vector, and the centroids that follow."""
    out = ["""
WITH v0 AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS id FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c, v AS m FROM v0 WHERE vec_id IS NOT NULL
  QUALIFY c < """ + f"{k})"]
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (
  SELECT id, vec_id, v, CAST(list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d, c FROM v0 CROSS JOIN c{r}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, c) = 1)""")
        if r < rounds:
            out.append(f"""s{r} AS (SELECT c, i, CAST(floor(CAST(sum(v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM a{r} CROSS JOIN range(1, 65) t(i) GROUP BY c, i),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (SELECT c, list(x ORDER BY i) AS m FROM s{r} GROUP BY c) n ON n.c = c{r}.c)""")
    return ",\n".join(out) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""


@query("op12_centroid_clustering", op12_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark, centroids.whole_numbers(table(spark, sf_dir, "embeddings")))


@query("op13_ngram_join")
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against all pairs: the components of SQL would need a recursive join over all pairs."""
    return ngram_join.components(table(spark, sf_dir, "documents"))
