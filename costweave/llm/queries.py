"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.llm import (
    chat, clusters, contamination, fingerprint, html, language, lm, mix, neardup, quality, repair, spans, suffixes, twins,
)
from costweave.llm.common import held_out, table
from costweave.session import stage


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    split = docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text", "lang")
    model = language.fit(split.where("NOT held_out"))
    return language.predict(split.drop("lang"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous"
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stage(docs.select("doc_id", "source", mix.size().alias("size"), mix.coin().alias("coin")), "sized")
    rates = stage(mix.targets(sized), "rates")
    return mix.with_copies(sized, rates, F.col("coin")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.dedup(docs).select("doc_id", "n_sentences", "n_removed", "text")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text"
    )
    learn = ~held_out("doc_id", 4, 2)
    labels = table(spark, sf_dir, "labels").where(learn)
    weights = quality.fit(docs.where(learn), labels)
    return quality.predict(docs, weights).select("doc_id", "held_out", "score", "predicted")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies", "n_links")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.digests(repair.edits(repair.damage(said)))
    every = said.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clusters.clustered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    shown = [",".join(map(str, c)) for c in centroids]
    return found.withColumn("centroid_sha256", F.sha2(clusters.by_cluster(shown).cast("binary"), 256))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_fingerprints": op3_fingerprints,
    "op4_html_extraction": op4_html_extraction,
    "op5_language_id": op5_language_id,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_source_mixing": op7_source_mixing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}

TWINS: dict[str, str] = {
    "op2_benchmark_decontamination": r"""
        WITH doc_words AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
        item_words AS (
            SELECT row_number() OVER () AS r, item_id,
                   regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
        held AS (
            SELECT DISTINCT r, doc_id, list_slice(w, i, i + 4) AS s
            FROM doc_words, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0),
        wanted AS (
            SELECT DISTINCT r, item_id, list_slice(w, i, i + 4) AS s
            FROM item_words, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0),
        sizes AS (SELECT r, count(*) AS n_shingles FROM wanted GROUP BY r)
        SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*)::DOUBLE / n_shingles AS containment
        FROM held JOIN wanted USING (s) JOIN sizes ON sizes.r = wanted.r
        GROUP BY held.r, wanted.r, doc_id, item_id, n_shingles
        HAVING 10 * count(*) >= 8 * n_shingles
    """,
    "op6_chat_formatting": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        logs AS (
            SELECT conv_id, count(*) AS n_turns,
                   list({'role': role, 'text': text}
                        ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said,
                   string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), ''
                              ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS shown
            FROM turns GROUP BY conv_id),
        whole AS (
            SELECT min(conv_id) AS conv_id, n_turns, said, count(*) AS n_logged, min(shown) AS text
            FROM logs GROUP BY n_turns, said)
        SELECT conv_id, n_turns, n_logged, text FROM whole a
        WHERE NOT EXISTS (
            SELECT 1 FROM whole b
            WHERE b.said[1] = a.said[1] AND b.n_turns > a.n_turns AND b.said[1:a.n_turns] = a.said)
    """,
    "op7_source_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS coin
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM sized GROUP BY source),
        ranked AS (
            SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS full_at FROM sources),
        levels AS (
            SELECT a.full_at,
                   (1.5 * (SELECT sum(source_size) FROM sources)::DOUBLE
                    - coalesce((SELECT sum(b.cap) FROM ranked b WHERE b.full_at < a.full_at), 0)::DOUBLE)
                   / (SELECT sum(b.weight) FROM ranked b WHERE b.full_at >= a.full_at)::DOUBLE AS level
            FROM ranked a),
        target AS (
            SELECT source, source_size,
                   least(cap::DOUBLE, weight * (SELECT min_by(level, full_at) FROM levels WHERE level <= full_at))
                       AS target
            FROM ranked)
        SELECT doc_id, size, source_size, target,
               (floor(target / source_size)::BIGINT
                + (('0x' || substr(coin, 1, 13))::BIGINT::DOUBLE / 4503599627370496
                   < target / source_size - floor(target / source_size))::BIGINT) * size AS taken
        FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source
    """,
    "op11_conversation_repair": twins.repair_sql(),
    "op12_centroid_clustering": twins.cluster_sql(),
    "op13_suffix_array_dedup": twins.BYTE_DEDUP,
}
