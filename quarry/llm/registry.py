"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import cotrain, decontaminate, katz, language, licences, negatives, packing, periods, phrases, repetition, secrets, simhash, url_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_retrieval_packing": packing.query,
    "op2_decontaminate": decontaminate.query,
    "op3_repetition_rules": repetition.query,
    "op4_simhash": simhash.query,
    "op5_url_rules": url_rules.query,
    "op6_licence_scan": licences.query,
    "op7_katz_score": katz.query,
    "op8_language_id": language.query,
    "op9_phrase_dedup": phrases.query,
    "op10_quality_classifier": cotrain.query,
    "op11_markov_secrets": secrets.query,
    "op12_hard_negatives": negatives.query,
    "op13_periodic_runs": periods.query,
}

ORACLE_SQL: dict[str, str] = {"op2_decontaminate": decontaminate.oracle(), "op5_url_rules": url_rules.oracle(), "op11_markov_secrets": secrets.oracle(), "op12_hard_negatives": negatives.oracle(), "op13_periodic_runs": periods.oracle()}
