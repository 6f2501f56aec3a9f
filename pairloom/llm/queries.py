"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    best_fit_packing,
    class_lm,
    cuckoo_dedup,
    fuzzy_lines,
    mixing,
    nn_descent,
    quality_pu,
    repeated_units,
    simhash_anchors,
    token_alignment,
    url_reputation,
    walsh_codes,
    warc_archive,
)
from pairloom.llm.common import Scratch, table

URL_RULES = (
    ("com/en/", "block"),
    ("example.com/en/7", "allow"),
    ("net/de/", "allow"),
    ("example.net/de/8", "block"),
    ("org/es/", "block"),
)

QUALITY_THRESHOLD = 0.3
MIX = mixing.Mix(mixing.Target("repetition", 2.0))


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of a mix that repeats no source more than twice and drops no document."""
    return mixing.draws(table(spark, sf_dir, "documents"), MIX)


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL; the quality label with the page's id is the page's outcome."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").cast("long").alias("good")
    )
    return url_reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op3_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that repeats an earlier one, and parts of lines in runs of 30 words or more."""
    return repeated_units.repeated_units(table(spark, sf_dir, "documents"))


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, and what the archive says of it."""
    archive = Scratch(spark, "archive").path("warc")
    warc_archive.write_archive(table(spark, sf_dir, "pages"), archive)
    return warc_archive.resolved_records(spark, archive).select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def packed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    import public_tokenizers

    pieces = best_fit_packing.token_pieces(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    scratch = Scratch(spark, "packing")
    return best_fit_packing.pack(pieces, scratch).withColumnRenamed("id", "doc_id")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    return packed(spark, table(spark, sf_dir, "documents"))


def trained_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_pu.Model | None:
    """A model that has seen neither the labels nor the texts of the held-out fifth."""
    known = ~quality_pu.held_out(F.col("doc_id"))
    trusted = table(spark, sf_dir, "labels").filter(known & (F.col("quality") == 1))
    return quality_pu.learn(docs.filter(known), trusted.select(F.col("doc_id").alias("id")))


def op6_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    docs = table(spark, sf_dir, "documents")
    return quality_pu.score(docs, trained_quality(spark, docs, sf_dir)).select(
        "doc_id",
        quality_pu.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op7_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and near-duplicate class."""
    return simhash_anchors.simhash_classes(table(spark, sf_dir, "documents"))


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that goes, with the occurrence of its group that stays."""
    return fuzzy_lines.fuzzy_line_dedup(table(spark, sf_dir, "documents"))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of links and its component."""
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document of equal text that stays."""
    return cuckoo_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by classes learned from nine tenths of them."""
    return class_lm.scored(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links under a byte-level and a piece model."""
    import public_tokenizers

    path = public_tokenizers.path
    bpe = partial(
        token_alignment.ByteBpe,
        path("byte_bpe_50k.json"),
        path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    pieces = partial(token_alignment.Pieces, path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents")
    return token_alignment.aligned(docs, bpe, pieces).withColumnRenamed("id", "doc_id")


def op13_walsh_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's code, its error, and its label's."""
    vectors = table(spark, sf_dir, "embeddings")
    return walsh_codes.compressed(vectors).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_temperature_mixing": op1_temperature_mixing,
    "op2_url_reputation": op2_url_reputation,
    "op3_repeated_units": op3_repeated_units,
    "op4_warc_archive": op4_warc_archive,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_pu": op6_quality_pu,
    "op7_simhash_anchors": op7_simhash_anchors,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_nn_descent": op9_nn_descent,
    "op10_cuckoo_dedup": op10_cuckoo_dedup,
    "op11_brown_lm": op11_brown_lm,
    "op12_lockstep_alignment": op12_lockstep_alignment,
    "op13_walsh_codes": op13_walsh_codes,
}


def _codes_sql(width: int = 64, parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Product quantisation by whole comparison, each round a table of its own."""
    each = range(width // parts)
    columns = ", ".join(f"v{i}" for i in each)
    distance = " + ".join(f"(x.v{i} - e.v{i}) * (x.v{i} - e.v{i})" for i in each)
    cut = ", ".join(f"v[p * {width // parts} + {i + 1}] AS v{i}" for i in each)
    # Division of whole numbers drops the remainder's sign, so the remainder goes first.
    mean = ", ".join(
        f"((sum(x.v{i}) - ((sum(x.v{i}) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v{i}"
        for i in each
    )
    steps = [
        """kept AS MATERIALIZED (
            SELECT vec_id, label, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v
            FROM embeddings WHERE embedding IS NOT NULL
            AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""pieces AS MATERIALIZED (
            SELECT vec_id, label, p, {cut} FROM kept, range({parts}) AS r(p))""",
        f"""e0 AS MATERIALIZED (
            SELECT * EXCLUDE (vec_id, label) FROM (
                SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k FROM pieces)
            WHERE k < {entries})""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
                SELECT vec_id, label, p, min(({distance}) * 256 + e.k) AS best
                FROM pieces x JOIN e{r} e USING (p) GROUP BY ALL)"""
        )
        if r < rounds:
            steps.append(
                f"""e{r + 1} AS MATERIALIZED (
                    SELECT p, k, {columns} FROM (
                        SELECT p, best % 256 AS k, {mean} FROM pieces x JOIN a{r} USING (vec_id, p)
                        GROUP BY ALL)
                    UNION ALL
                    SELECT p, k, {columns} FROM e{r} old WHERE NOT EXISTS (
                        SELECT 1 FROM a{r} a WHERE a.p = old.p AND a.best % 256 = old.k))"""
            )
    steps.append(
        f"""coded AS (
            SELECT vec_id, label, sum(best // 256)::BIGINT AS error,
                   string_agg(printf('%02x', (best % 256)::INT), '' ORDER BY p) AS code
            FROM a{rounds} GROUP BY vec_id, label)"""
    )
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(concat_ws(',', {columns}), ',' ORDER BY p, k))
                FROM e{rounds}) AS codebooks_sha256
        FROM coded
    """

ORACLES: dict[str, str] = {
    # Within a limit r and with every document drawn, the exponent has a closed form:
    # (largest share / smallest share) ** (1 - exponent) = r.
    "op1_temperature_mixing": """
        WITH d AS (
            SELECT doc_id, coalesce('=' || source, '') AS source_key,
                   greatest(1, ceil(coalesce(strlen(text), 0) / 4))::BIGINT AS tokens
            FROM documents
        ), s AS (
            SELECT source_key, sum(tokens)::BIGINT AS t FROM d GROUP BY 1
        ), a AS (
            SELECT CASE WHEN max(t) > min(t)
                   THEN greatest(0, 1 - ln(2) / ln(max(t) / min(t))) ELSE 0 END AS alpha FROM s
        ), w AS (
            SELECT source_key, t, pow(t, alpha) / sum(pow(t, alpha)) OVER () AS weight FROM s, a
        ), q AS (
            SELECT source_key, t, weight * max(t / weight) OVER () AS quota,
                   greatest(1, ceil(t / 20000))::BIGINT AS blocks FROM w
        ), r AS (
            SELECT d.*, t, quota,
                   ('0x' || substr(md5(doc_id || '/1'), 1, 15))::BIGINT % blocks AS block
            FROM d JOIN q USING (source_key)
        ), b AS (
            SELECT source_key, block, t, quota, sum(tokens)::BIGINT AS block_tokens
            FROM r GROUP BY ALL
        ), p AS (
            SELECT *, unnest(generate_series(0, greatest(ceil(quota / t)::INT - 1, 0))) AS pass
            FROM b
        ), o AS (
            SELECT *, ('0x' || substr(md5(concat_ws('/', source_key, pass, block, 1)), 1, 15))
                   ::BIGINT AS ord FROM p
        ), g AS (
            SELECT *, pass * t + coalesce(sum(block_tokens) OVER (
                PARTITION BY source_key, pass ORDER BY ord, block
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM o
        )
        SELECT doc_id, source_key, pass::INT AS pass, block, tokens,
               floor(start / g.quota * 1000000 + 0.5)::BIGINT AS position
        FROM g JOIN r USING (source_key, block) WHERE start + block_tokens / 2 <= g.quota
    """,
    "op4_warc_archive": """
        SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN strlen(html) >= 100 AND page_id > first_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(html) >= 100 AND page_id > first_id
                    THEN first_id END AS refers_to
        FROM (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS first_id
              FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
    """,
    "op10_cuckoo_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_walsh_codes": _codes_sql(),
}
