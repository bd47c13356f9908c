"""Queries of the subpackage: each applies an operator with production settings to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import byte_bpe, decontaminate, exact_search, guess_cost, html_crf, jaccard_join, line_dedup, periodic_runs, prefix_forest, prefix_trie, rule_ensemble, warc, weak_pii
from rankloom.llm.common import table
from rankloom.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_forest.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return prefix_forest.nearest(rows, rows.filter("vec_id % 100 = 0"), k=10)


def op3_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_pii.summarise(docs, weak_pii.find_positions(docs))


def op4_heavy_light_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=85)


def op5_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = html_crf.train(html_crf.labelled_pages(500))
    return html_crf.extract(table(spark, sf_dir, "pages"), field)


def op6_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guess_cost.summarise(guess_cost.find_secrets(table(spark, sf_dir, "documents"), RANKS))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.deduplicate(table(spark, sf_dir, "pages"), scratch_path(spark, "archives"), least_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, PATTERN, with_offsets=False)
    return byte_bpe.digests(byte_bpe.decode(encoded.select("doc_id", "token_ids"), RANKS))


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_windows(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op11_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_search.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return exact_search.top_k(rows, rows.filter("vec_id % 100 = 0"), k=10, scale=1024.0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    turns = prefix_trie.rebuilt(indexed, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, most=5)
    return prefix_trie.with_digests(*prefix_trie.prefix_trie(turns))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    seed = F.when(F.col("h") % 10 == 0, F.floor(F.col("h") / 10))
    text = F.when(seed.isNull(), F.col("text")).otherwise(periodic_runs.repeated(F.col("text"), seed))
    return periodic_runs.summarise(periodic_runs.periodic_runs(docs.select("doc_id", text.alias("text"))))


def near_duplicate_stage(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates: five words, similarity 0.8; the smallest doc_id of the group stays.

    Texts without words are no one's duplicates and stay. Of rows that share the smallest doc_id all stay.
    """
    found = jaccard_join.near_duplicates(docs, width=5, percent=80)
    kept = found.filter("doc_id is null or doc_id = component_id").select(F.col("doc_id").alias("_doc_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_template_decontamination, op2_prefix_forest, op3_weak_pii, op4_heavy_light_jaccard, op5_html_crf, op6_guess_cost,
    op7_warc_revisits, op8_byte_bpe, op9_rule_ensemble, op10_line_windows, op11_exact_search, op12_prefix_trie, op13_periodic_runs)}

ORACLE: dict[str, str] = {
    "op10_line_windows": line_dedup.ORACLE,
    "op11_exact_search": exact_search.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op7_warc_revisits": """
        SELECT page_id, url, payload_bytes, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to,
               list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31), 1)), 'string_agg', '') AS payload_digest
        FROM (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
                     min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)""",
}
