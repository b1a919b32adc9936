"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalytics.llm import exact_dedup, jaccard_join, packing, quality, secrets
from catalytics.llm.common import cut_lineage, read_table
from catalytics.llm.queries import tokenizer_file


#: Words that a Python worker remembers in the last stage: few, as it holds them beside what
#: all other stages need of an executor's memory.
REMEMBERED = 50_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents whose quality is doubtful go."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of equal texts stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of linked texts stays."""
    return jaccard_join.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: secrets are masked in the text; every document stays."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: power-of-two sequences with their token ids."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), remembered=REMEMBERED)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secret_scans),
    ("packing", packed),
]

#: The quality model is fitted by iteration, which SQL can't express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
