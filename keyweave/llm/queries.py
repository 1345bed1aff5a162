"""The registered query of each operator, with production parameters, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyweave.llm.common import crc_mod, table


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.order_minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.compact_windows import passages

    return passages(table(spark, sf_dir, "documents")).drop("text_key")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.langid import identify, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, crc_mod("doc_id", 3) != 1)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.warc import page_records, resolve_revisits

    out = resolve_revisits(page_records(table(spark, sf_dir, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(
        e["key"], F.lit(": "), e["value"])))
    return out.select(
        "record_id", "canonical_url", F.unix_seconds("date").alias("date_s"), "outcome",
        "source_id", F.unix_seconds("source_date").alias("source_date_s"), "payload_digest",
        "payload_length", F.array_join(entries, "\n").alias("headers"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.decontaminate import measure

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return measure(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from keyweave.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"),
                public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.gbt import predict, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return predict(docs, trees).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op10_trie_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.trie_lm import lm_scores

    held = crc_mod("doc_id", 7) == 2
    return lm_scores(table(spark, sf_dir, "documents"), ~held, order=3, on_files=True).select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def branch_trie(conversations: DataFrame, **kw) -> DataFrame:
    """Prefix trie of the conversations rebuilt as branches of every fifth one."""
    from keyweave.llm.prefix_trie import branched, ordered_turns, prefix_trie

    c = F.col("c")
    turns, sequences = branched(ordered_turns(conversations), base=c - c % 5,
                                head=F.crc32(c.cast("string")) % 9, most=8)
    return prefix_trie(turns, sequences, **kw)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return branch_trie(table(spark, sf_dir, "conversations"))


def op12_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.kronecker import hard_negatives

    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", shifted.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyweave.llm.one_bit import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_order_minhash": op2_order_minhash,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_html_text": op5_html_text,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_decontaminate": op7_decontaminate,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_trie_lm": op10_trie_lm,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_kronecker_negatives": op12_kronecker_negatives,
    "op13_one_bit_codes": op13_one_bit_codes,
}
