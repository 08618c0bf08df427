"""The operators' queries and, where SQL can say it, the same as SQL."""

from __future__ import annotations

from . import decontaminate, mixture, near_dedup, pii, quality_model, quality_rules, suffix_dedup, token_output, toxicity, url_filter

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_token_output": token_output.op5_token_output,
    "op6_pii": pii.op6_pii,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_mixture": mixture.op8_mixture,
    "op9_quality_model": quality_model.op9_quality_model,
    "op10_toxicity": toxicity.op10_toxicity,
}
ORACLE_SQL = {
    "op2_near_dedup": near_dedup.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op7_decontaminate": decontaminate.ORACLE,
}
