"""Registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import (
    bloom_variants,
    compression_bands,
    cover_dedup,
    cross_parsing,
    cutting_stock,
    kmeans_tree,
    maxscore,
    periodic_runs,
    simhash_pivots,
    token_files,
    toxicity_cnn,
    unigram_pieces,
    warc_revisit,
)
from tickframe.llm._common import fold, let_workers_import, scratch_path, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash_pivots.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, written as token files and read from them."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_files.read_documents(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether the rules keep it."""
    return compression_bands.rules(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the archives that hold every page, read back and resolved."""
    path = scratch_path(spark, "warc")
    warc_revisit.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc_revisit.resolved(warc_revisit.read_records(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity_cnn.ToxicityModel:
    """Fitted on labelled documents whose fold of five is not 0."""
    return toxicity_cnn.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity_model(docs, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity_cnn.score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, their digest, and whether decoding gives the text back."""
    encoder = unigram_pieces.Encoder(unigram_pieces.read_vocabulary())
    return unigram_pieces.round_trips(_table(spark, sf_dir, "documents").select("doc_id", "text"), encoder)


def op7_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many of them repeated passages take, and a digest of the rest."""
    found = cover_dedup.remove_repetitions(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op8_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return cutting_stock.pack(_table(spark, sf_dir, "documents"))


def op9_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector among all vectors."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return kmeans_tree.neighbours(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from documents whose fold of three is not 1."""
    docs = _table(spark, sf_dir, "documents")
    model = cross_parsing.fit(docs.where(fold(F.col("doc_id"), 3) != 1))
    found = cross_parsing.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_bloom_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    words = bloom_variants.counted_words(_table(spark, sf_dir, "documents"))
    return bloom_variants.variants(words.where(F.col("n") >= bloom_variants.FEWEST_OCCURRENCES))


def op12_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty largest inner products of every twentieth vector with all others, in whole numbers."""
    vectors = written(maxscore.quantised(_table(spark, sf_dir, "embeddings")), "maxscore-vectors")
    return maxscore.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every document, and digests of all of them and of what they leave."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(docs, periodic_runs.planted)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_pivots": op1_simhash_pivots,
        "op2_token_files": op2_token_files,
        "op3_compression_bands": op3_compression_bands,
        "op4_warc_revisit": op4_warc_revisit,
        "op5_toxicity_cnn": op5_toxicity_cnn,
        "op6_unigram_pieces": op6_unigram_pieces,
        "op7_cover_dedup": op7_cover_dedup,
        "op8_cutting_stock": op8_cutting_stock,
        "op9_kmeans_tree": op9_kmeans_tree,
        "op10_cross_parsing": op10_cross_parsing,
        "op11_bloom_variants": op11_bloom_variants,
        "op12_maxscore": op12_maxscore,
        "op13_periodic_runs": op13_periodic_runs,
    }


#: SHA-1 in base 32: its 40 hexadecimal digits in 8 groups of 20 bits, each 4 letters of the alphabet.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP4_SQL = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digested AS (
    SELECT page_id, payload, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS original FROM payloads),
grouped AS (
    SELECT *, [list_sum([(instr('0123456789abcdef', substr(hex, 5 * g + d + 1, 1)) - 1) * CAST(pow(16, 4 - d) AS BIGINT) for d in range(5)])
               for g in range(8)] AS bits
    FROM digested)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string([array_to_string([substr('{_BASE32}', CAST((CAST(b AS BIGINT) // CAST(pow(32, 3 - c) AS BIGINT)) % 32 + 1 AS BIGINT), 1)
                                         for c in range(4)], '') for b in bits], '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM grouped
"""

OP7_SQL = """
WITH split AS (
    SELECT doc_id, [w for w in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if w <> ''] AS words FROM documents),
windows AS (
    SELECT doc_id, place, array_to_string(words[place:place + 19], ' ') AS passage
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS place FROM split WHERE len(words) >= 20) w),
repeated AS (
    SELECT doc_id, place FROM (
        SELECT doc_id, place, row_number() OVER (PARTITION BY passage ORDER BY doc_id, place) AS nth FROM windows) n
    WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM repeated),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split) w
    ANTI JOIN gone USING (doc_id, place)
    GROUP BY doc_id)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""

OP12_SQL = """
WITH usable AS (
    SELECT vec_id, min([CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding]) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    GROUP BY vec_id),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
           CAST(list_inner_product(CAST(q.w AS DOUBLE[]), CAST(v.w AS DOUBLE[])) AS BIGINT) AS score
    FROM usable q JOIN usable v ON q.vec_id <> v.vec_id
    WHERE q.vec_id % 20 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def llm_oracles() -> dict[str, str]:
    return {"op4_warc_revisit": OP4_SQL, "op7_cover_dedup": OP7_SQL, "op12_maxscore": OP12_SQL}
