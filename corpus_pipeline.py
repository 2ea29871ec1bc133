"""Corpus pipeline: five stages over ``documents``.

1. toxicity: documents that the classifier rejects go;
2. simhash: one document of each near-duplicate group stays;
3. decontaminate: documents that contain a benchmark item go;
4. pii: personal data in the texts is masked;
5. packing: the documents that are left are packed into sequences.

Each stage is ``f(spark, docs, sf_dir)``; all but the last return the columns
of ``docs``.  A stage's rows are those of its input, extra columns included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from querytrail.llm import decontaminate, packing, pii, simhash, toxicity
from querytrail.llm.common import written
from querytrail.llm.queries import fold, tokenizer_file
from querytrail.sources.tables import load_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that score below 0.5."""
    return toxicity.accepted(docs, toxicity.fit(docs, load_table(spark, sf_dir, "labels"), fold(5) != 0))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each component, once."""
    return simhash.representatives(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain an item's shingles to 0.8 or more."""
    return decontaminate.decontaminated(docs, load_table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask all spans; ``n_chars`` follows the new text."""
    return pii.masked(docs, pii.fit(docs), "text", "n_chars" if "n_chars" in docs.columns else None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: A trained classifier, XXH64 and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's output written and read again."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"pipeline-{name}")
    return docs
