"""The queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusweave.llm import chat, decontamination, filter_audit, hard_negatives, licenses, ngram_join, packing, pii, quality_classifier, quality_rules, sharding, topk_search, toxicity

_MODULES = [ngram_join, quality_rules, chat, quality_classifier, packing, licenses, decontamination, toxicity, pii, sharding, topk_search, hard_negatives, filter_audit]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in vars(m).items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {name: m.ORACLE_SQL for m in _MODULES for name in vars(m) if name.startswith("op") and name[2].isdigit() and m.ORACLE_SQL}
