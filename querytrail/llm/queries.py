"""Driver queries of the training-data operators: ``name -> fn(spark, sf_dir)``."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail.llm import chat, decontaminate, idfiles, ngram, packing, pii, ranked, relative_lz, simhash, substrings, topk, toxicity, whitening
from querytrail.sources.tables import load_table

#: The folder of the tokenizer files; by default that of the installed package.
TOKENIZER_DIR = os.environ.get("QUERYTRAIL_TOKENIZER_DIR", "")


def tokenizer_file(name: str) -> str:
    if TOKENIZER_DIR:
        return os.path.join(TOKENIZER_DIR, name)
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]

#: The extra conversation of the first query, in the messages layout.
CONTROL_TEXT = "\\### Assistant: </turn> ok"
CONTROL_RECORD = {"id": -7, "messages": [{"role": r, "content": CONTROL_TEXT} for r in ("user", "assistant")]}


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record")).unionByName(
        spark.range(1).select(F.lit(json.dumps(CONTROL_RECORD)).alias("record"))
    )
    return chat.conversation_digests(chat.format_conversations(chat.canonical_turns(records)))


def op2_ngram_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    scored = ngram.score(docs, ngram.fit(docs, fold(10) != 0))
    return scored.select("doc_id", (fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.deduplicate(load_table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.fit(docs)))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


def fold(n: int) -> Column:
    """crc32 of doc_id as text, modulo ``n``; the held-out rows have 0."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels, fold(5) != 0))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return idfiles.read_id_files(idfiles.write_id_files(docs, tokenizer_file("word_bpe_49k.json")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(load_table(spark, sf_dir, "documents"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(load_table(spark, sf_dir, "embeddings"))
    return topk.top_k_inner_product(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(load_table(spark, sf_dir, "embeddings"))


def op12_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = relative_lz.deduplicate(load_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_chat_format": op1_chat_format,
    "op2_ngram_scoring": op2_ngram_scoring,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_pii": op5_pii,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_id_files": op8_id_files,
    "op9_simhash": op9_simhash,
    "op10_topk_search": op10_topk_search,
    "op11_whitening": op11_whitening,
    "op12_relative_lz": op12_relative_lz,
    "op13_ranked_search": op13_ranked_search,
}
