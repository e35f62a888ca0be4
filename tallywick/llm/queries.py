"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallywick.llm import byte_bpe, decontamination, filter_audit, language_id, lexical_search, pii, quality_model, quality_rules, repeats, secrets_scan, simhash, toxicity, url_filter
from tallywick.llm.common import ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, run: Callable[..., DataFrame], *tables: str, sql: str | None = None) -> None:
    """`run` gets the named tables of the data folder."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return run(*[table(spark, sf_dir, t) for t in tables])

    query.__name__ = name
    QUERIES[name] = query
    if sql is not None:
        ORACLE_SQL[name] = sql


register("op1_byte_bpe", byte_bpe.op1_byte_bpe, "documents")
register("op2_quality_rules", quality_rules.op2_quality_rules, "documents", sql=quality_rules.SQL)
register("op3_simhash", simhash.op3_simhash, "documents")
register("op4_language_id", language_id.op4_language_id, "documents")
register("op5_quality_model", quality_model.op5_quality_model, "documents", "labels")
register("op6_decontamination", decontamination.op6_decontamination, "documents", "benchmark", sql=decontamination.SQL)
register("op7_secrets_scan", secrets_scan.op7_secrets_scan, "documents")
register("op8_url_filter", url_filter.op8_url_filter, "pages", sql=url_filter.SQL)
register("op9_pii", pii.op9_pii, "documents")
register("op10_repeats", repeats.op10_repeats, "documents")
register("op11_lexical_search", lexical_search.op11_lexical_search, "documents", "benchmark", sql=lexical_search.SQL)
register("op12_filter_audit", filter_audit.op12_filter_audit, "documents", "labels", sql=filter_audit.SQL)
register("op13_toxicity", toxicity.op13_toxicity, "documents", "labels")
QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
