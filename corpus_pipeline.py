"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing and BPE, each stage over all that is left.

Defined cases are those of the stages: rows without a doc_id, with a repeated one, or that repeat wholly are documents like any other
until the near-dedup stage, which keeps one of equal texts; null and empty texts fail the quality rules; texts of any length are
read whole; extra columns of documents are left behind by the first stage; an empty table gives an empty result.

Tables that a stage writes for itself are removed when its result is written, and that result when the next one's is. The result
is lazy and reads the mixed documents, so this one table (no larger than three times the input) stays in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import bpe, line_dedup, mixing, quality, simhash
from claimloom.llm.common import kept, removed, scratch, table

STAGES = [
    ("quality_rules", quality.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("mixing", mixing.stage),
    ("bpe", bpe.stage),
]

#: Neither EM, nor components of near copies, nor BPE can be put in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each stage's result is written as Parquet and read again as the next one's input."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs, path = kept(stage(spark, docs, sf_dir), name)
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
