"""The operators over their whole tables, with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.llm import (
    byte_bpe,
    chat_windows,
    exact_dedup,
    html_template,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality_filter,
    rule_ensemble,
    sharding,
    token_counts,
    vector_codes,
)
from custodia.llm.common import read_table
from custodia.storage import new_folder, stage

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The same vocabulary with its merges.
MERGES = public_tokenizers.path("byte_bpe_50k.json")
#: The id that the vocabulary leaves free.
END_OF_DOCUMENT = 50_256
#: The id that ends a document in packed sequences.
PACKED_END = 2
#: Words of a shingle in the query over documents.
SHINGLE_WORDS = 2

#: A conversation whose texts are the template's own control strings. Fixed values.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(read_table(spark, sf_dir, "pages"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), SHINGLE_WORDS)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(read_table(spark, sf_dir, "documents"), RANKS)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return rule_ensemble.score_documents(docs, rule_ensemble.train(docs, read_table(spark, sf_dir, "labels")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").selectExpr(
        "cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text"
    )
    control = [(-1, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    more = spark.createDataFrame(control, "conv_id long, turn long, role string, text string")
    return chat_windows.read_back(chat_windows.format_conversations(rows.unionByName(more)))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_filter.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_filter.assess_documents(docs, model)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = new_folder(spark, "token-files")
    order = stage(token_counts.write_token_files(docs, RANKS, END_OF_DOCUMENT, folder), "token-order")
    counts = token_counts.count_tokens(order, END_OF_DOCUMENT, END_OF_DOCUMENT)
    # Names and ordinals compress so well that file sizes say nothing about this table's size in memory.
    return order.hint("merge").join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, MERGES, public_tokenizers.PATTERN, PACKED_END)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_html_extraction,
        op2_near_dedup,
        op3_byte_bpe,
        op4_quality_classifier,
        op5_mixing,
        op6_exact_dedup,
        op7_chat_formatting,
        op8_sharding,
        op9_quality_rules,
        op10_token_counts,
        op11_vector_codes,
        op12_prefix_trie,
        op13_packing,
    )
}
