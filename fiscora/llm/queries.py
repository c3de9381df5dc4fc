"""The corpus operators as registered queries."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.llm import decontaminate, hmm, line_dedup, near_dedup, packing, periodic_runs, pieces, quality, sharding, spelling, substring_dedup, topk, toxicity
from fiscora.llm.labels import fold

Query = Callable[[SparkSession, str], DataFrame]

#: The tokenizer's model; the driver alone reads it.
PIECE_MODEL = "piece_bpe_32k.model"

NOISE = 199  # one run of letters in so many loses a character

SHARD_BYTES = 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"), length=200)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.drop("k1", "k2")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k1", "k2")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = fold("doc_id", 5)
    found = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder != 0)
    return found.withColumn("held_out", F.coalesce(remainder == 0, F.lit(False)))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate(table(spark, sf_dir, "documents"), min_words=1)
    return found.withColumn("kept_sha256", F.sha2(F.coalesce("kept", F.lit("")), 256)).drop("kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = fold("doc_id", 3)
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder != 1)
    return found.withColumn("held_out", F.coalesce(remainder == 1, F.lit(False)))


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), fold("doc_id", 10) == 0)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"), noise=NOISE)


def wrapped(doc_id: object, n: int) -> tuple[int, int] | None:
    """The words that the query rewrites: a tenth of the documents, from some place on, with some period."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(table(spark, sf_dir, "documents"), wrapped)


def op13_pieces(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path(PIECE_MODEL)
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.Vocabulary.load(model))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_topk": op3_topk,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality": op5_quality,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_hmm": op10_hmm,
    "op11_spelling": op11_spelling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_pieces": op13_pieces,
}

TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row AS query, q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.row <> v.row AND q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM s
)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 5
"""

# Links from shared shingles, classes as what a recursion over links reaches.
NEAR_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
  FROM w
), e AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT r.doc_id, l.b FROM reached AS r JOIN links AS l ON r.other = l.a
)
SELECT s.doc_id, CAST(any_value(len(g)) AS BIGINT) AS n_shingles, min(other) AS component_id, min(other) = s.doc_id AS kept
FROM s JOIN reached USING (doc_id) GROUP BY s.doc_id
"""

# Every later line beside every earlier equal one; neighbours on one diagonal form the maximal runs.
LINES_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL
), c AS (
  SELECT *, len(list_filter(string_split_regex(line, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')) AS words FROM l
), pairs AS (
  SELECT a.doc_id, a.i, a.words, b.doc_id AS other, a.i - b.i AS diagonal
  FROM c AS a JOIN c AS b ON a.line = b.line AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.i < a.i))
), runs AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, other, diagonal ORDER BY i) AS run FROM pairs
), gone AS (
  SELECT DISTINCT doc_id, i FROM (
    SELECT doc_id, i, sum(words) OVER (PARTITION BY doc_id, other, diagonal, run) AS total FROM runs) WHERE total >= 1
), marked AS (
  SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS gone,
    g.i IS NOT NULL AND coalesce(lag(g.i) OVER (PARTITION BY l.doc_id ORDER BY l.i), -5) <> l.i - 1 AS begins
  FROM l LEFT JOIN gone AS g ON g.doc_id = l.doc_id AND g.i = l.i
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_runs,
    string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents AS d LEFT JOIN kept USING (doc_id)
"""

# Every prefix of every hash with its bytes; a bucket fits, or holds one hash only, and its parent does not.
SHARDS_SQL = f"""
WITH h AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
    md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS digest
  FROM documents
), b AS (
  SELECT doc_id, n_bytes, lpad(bin(CAST('0x' || substr(digest, 1, 15) AS BIGINT)), 60, '0') AS bits FROM h
), cells AS (
  SELECT depth, substr(bits, 1, depth) AS shard, sum(n_bytes) AS size, count(*) AS n,
    sum(n_bytes) <= {SHARD_BYTES} OR min(bits) = max(bits) AS final
  FROM b, (SELECT CAST(unnest(range(61)) AS INTEGER) AS depth) GROUP BY ALL
), buckets AS (
  SELECT c.* FROM cells AS c LEFT JOIN cells AS p ON p.depth = c.depth - 1 AND p.shard = substr(c.shard, 1, c.depth - 1)
  WHERE c.final AND NOT coalesce(p.final, false)
)
SELECT doc_id, n_bytes, shard, depth, CAST(size AS BIGINT) AS shard_bytes, CAST(n AS BIGINT) AS shard_rows, size > {SHARD_BYTES} AS oversize
FROM b JOIN buckets ON substr(bits, 1, depth) = shard
"""

EXPECTED: dict[str, str] = {"op8_line_dedup": LINES_SQL, "op6_sharding": SHARDS_SQL, "op2_near_dedup": NEAR_SQL, "op3_topk": TOPK_SQL}
