"""Queries of the thirteen operators: name -> function of (spark, sf_dir); SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import alignment, ann, bpe, byte_bpe, divergence, language, line_dedup, mixing, pii, quality, simhash, toxicity, url_filter

MODULES = [toxicity, language, quality, bpe, url_filter, pii, simhash, ann, line_dedup, mixing, divergence, byte_bpe, alignment]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
