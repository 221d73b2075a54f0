"""The queries of this folder by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docrecords.llm import decontamination, jaccard_join, mixing, packing, prefix_trie, quality_model, quality_rules, repair, secrets, substrings, token_counts, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.op1_warc,
    "op2_substrings": substrings.op2_substrings,
    "op3_packing": packing.op3_packing,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_quality_model": quality_model.op6_quality_model,
    "op7_secrets": secrets.op7_secrets,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_mixing": mixing.op10_mixing,
    "op11_repair": repair.op11_repair,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_toxicity": toxicity.op13_toxicity,
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.SQL,
    "op5_quality_rules": quality_rules.SQL,
    "op7_secrets": secrets.SQL,
    "op10_mixing": mixing.SQL,
    "op11_repair": repair.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
