"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ripplecast.llm import decontamination, oracles
from ripplecast.llm.alignment import op11_token_alignment
from ripplecast.llm.conversations import op13_conversation_repair
from ripplecast.llm.decontamination import op3_benchmark_decontamination
from ripplecast.llm.fm_dedup import op5_substring_dedup
from ripplecast.llm.jaccard_join import op8_jaccard_join
from ripplecast.llm.line_dedup import op12_line_dedup
from ripplecast.llm.lpf_dedup import op9_suffix_array_dedup
from ripplecast.llm.nbsvm import op2_quality_classifier
from ripplecast.llm.packing import op6_best_fit_packing
from ripplecast.llm.quality_rules import op4_quality_rules
from ripplecast.llm.secrets import op10_secret_scan
from ripplecast.llm.toxicity import op7_toxicity
from ripplecast.llm.url_trust import op1_url_trust

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_trust": op1_url_trust,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_line_dedup": op12_line_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

#: The others train a model, tokenise or iterate: tests/llm holds them against brute force or held-out labels.
ORACLE_SQL: dict[str, str] = {
    "op3_benchmark_decontamination": decontamination.ORACLE,
    "op5_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op8_jaccard_join": oracles.JACCARD_JOIN,
    "op9_suffix_array_dedup": oracles.SUFFIX_ARRAY_DEDUP,
    "op10_secret_scan": oracles.SECRET_SCAN,
    "op12_line_dedup": oracles.LINE_DEDUP,
}
