"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from civiclake.llm import (
    bpe,
    bundles,
    limb_codes,
    line_dedup,
    ngram_join,
    packing,
    prefix_forest,
    projection_forest,
    residue_negatives,
    substrings,
    suffix_tree,
    token_counts,
    toxicity,
)
from civiclake.session import BATCHES, tune
from civiclake.sources.scratch import new_dir


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark, BATCHES).read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts through a cache of this run's own, so every distinct text is a miss once."""
    return token_counts.count_tokens(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        new_dir(spark, "token-cache"),
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.predict(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.dedup_digests(_table(spark, folder, "documents"))


def op4_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.score(_table(spark, folder, "documents"))


def op5_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_forest.nearest(_table(spark, folder, "embeddings"), "vec_id % 100 = 0")


def op6_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    place = new_dir(spark, "bundles")
    index = bundles.write_bundles(_table(spark, folder, "pages"), place)
    return bundles.verified(bundles.read_records(index, place))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
    )


def op10_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    return projection_forest.near_duplicates(_table(spark, folder, "embeddings"))


def op11_limb_codes(spark: SparkSession, folder: str) -> DataFrame:
    return limb_codes.compress(_table(spark, folder, "embeddings"))


def op12_residue_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh row first gets the next label, so that some positives are wrong."""
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residue_negatives.mine(_table(spark, folder, "embeddings"), "vec_id % 100 = 0", label=relabelled)


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_digests(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_suffix_tree": op4_suffix_tree,
    "op5_prefix_forest": op5_prefix_forest,
    "op6_warc_bundles": op6_warc_bundles,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_ngram_join": op8_ngram_join,
    "op9_packing": op9_packing,
    "op10_projection_forest": op10_projection_forest,
    "op11_limb_codes": op11_limb_codes,
    "op12_residue_negatives": op12_residue_negatives,
    "op13_line_dedup": op13_line_dedup,
    "pipeline": corpus_pipeline.run,
}

_BASE_32 = "||".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(hex, {10 * (i // 8) + 1}, 10))::BIGINT >> {35 - 5 * (i % 8)} & 31)::INT, 1)"
    for i in range(32)
)



def _rounds_of_means(parts: int, entries: int, rounds: int) -> str:
    """The codebooks b0, b1, ... and what is nearest to each, as common table expressions."""
    tables = []
    for i in range(rounds + 1):
        tables.append(f"""
        d{i} AS (
            SELECT c.vec_id, c.p, b.e, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
            FROM c JOIN b{i} b ON b.p = c.p AND b.k = c.k GROUP BY ALL
        ),
        n{i} AS (SELECT vec_id, p, e, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)""")
        if i < rounds:
            tables.append(f"""
        s{i} AS (SELECT c.p, n.e, c.k, sum(c.x)::BIGINT AS s, count(*) AS m FROM c JOIN n{i} n ON n.vec_id = c.vec_id AND n.p = c.p GROUP BY ALL),
        b{i + 1} AS (
            SELECT b.p, b.e, b.k, coalesce((s.s - ((s.s % s.m) + s.m) % s.m) // s.m, b.x) AS x
            FROM b{i} b LEFT JOIN s{i} s ON s.p = b.p AND s.e = b.e AND s.k = b.k
        )""")
    return ",".join(tables)


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

#: Where SQL over the tables can say the same; for all others tests/llm has brute-force versions.
ORACLE: dict[str, str] = {
    "op6_warc_bundles": f"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex,
                max(page_id) OVER (PARTITION BY coalesce(html, '')) AS response
            FROM pages
        )
        SELECT page_id, payload_bytes, {_BASE_32} AS payload_digest,
            CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response THEN response END AS refers_to
        FROM p""",
    "op11_limb_codes": f"""
        WITH kept AS (SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings WHERE {_FINITE}),
        c AS (
            SELECT vec_id, (i - 1) // (len(v) // 16) AS p, (i - 1) % (len(v) // 16) AS k, v[i] AS x
            FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept)
        ),
        f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
        b0 AS (SELECT c.p, f.e, c.k, c.x FROM c JOIN f USING (vec_id)),
        {_rounds_of_means(16, 64, 2)},
        books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, k)) AS codebooks_sha256 FROM b2),
        coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n2 GROUP BY vec_id)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (vec_id), books""",
    "op12_residue_negatives": f"""
        WITH r AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
        ),
        s AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM r a JOIN r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
        ),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
            (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5""",
    "op13_line_dedup": r"""
        WITH w AS (SELECT E' \t\n\x0b\x0c\r' AS white),
        lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), E'\n')) AS line, generate_subscripts(string_split(coalesce(text, ''), E'\n'), 1) AS i FROM documents
        ),
        keyed AS (
            SELECT doc_id, i, line, translate(trim(line, white), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines, w
        ),
        often AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last <> doc_id) AS n_dropped,
            sha256(coalesce(string_agg(line, E'\n' ORDER BY i) FILTER (last IS NULL OR last = doc_id), '')) AS kept_sha256
        FROM keyed LEFT JOIN often USING (key) GROUP BY doc_id""",
}
