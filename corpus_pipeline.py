"""A training corpus in five stages; each takes all that the one before kept, as a table.

Rows without a doc_id stay where no rule is against them; rows that repeat a doc_id and a text stay together or go together.
Null texts are empty. Columns other than those of documents are left out; the input may have more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm import decontaminate, lines, ngrams, pieces, quality
from keyflow.llm.common import Scratch, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy."""
    rows = quality.kept(docs.withColumn("raw", F.col("text")), quality.DEFAULT_POLICY, "raw", "lang", "source", "n_chars")
    return rows.select("doc_id", F.col("raw").alias("text"), "lang", "source", "n_chars")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stay elsewhere; those left without a word go."""
    out = lines.deduplicated(docs.select(COLUMNS)).where(F.col("text").rlike(r"[^\x20\x09\x0A\x0B\x0C\x0D]"))
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """By shingles of five words and a similarity of 0.8, the document with the smallest doc_id of each group, and all documents without a doc_id, which are in no group."""
    first = ngrams.classes(docs, n=5, percent=80).where("doc_id = component_id").select("doc_id").distinct()
    docs = docs.select(COLUMNS)
    return docs.join(first, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a few words of benchmark windows."""
    rows = decontaminate.annotate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))
    return rows.withColumn("n_hit", decontaminate.n_hit()).where(~decontaminate.contaminated()).select(COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the best segmentation, and the N best with their scores and what differs in each."""
    import public_tokenizers

    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, old = table(spark, sf_dir, "documents"), Scratch(spark, "stages"), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if old:
            scratch.drop(old)
        old = name.replace(" ", "-")
    return docs


#: Union-find and A* have no SQL; tests/llm compares the n-gram stage with brute force and each operator with its own.
ORACLE_SQL = None
