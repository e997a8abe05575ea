"""The queries of this subpackage, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gnomon.llm import op2_html, op3_language, op4_substrings, op5_surrogates, op6_exact, op7_decontaminate, op8_toxicity, op9_score, op10_near, op11_token_files, op12_negatives, op13_divergence
from gnomon.llm.op1_pieces import op1_pieces

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pieces, op2_html.op2_main_text, op3_language.op3_language, op4_substrings.op4_substrings, op5_surrogates.op5_surrogates, op6_exact.op6_exact_dedup, op7_decontaminate.op7_decontaminate, op8_toxicity.op8_toxicity, op9_score.op9_score, op10_near.op10_near_dedup, op11_token_files.op11_token_files, op12_negatives.op12_hard_negatives, op13_divergence.op13_divergence)}
ORACLES: dict[str, str] = {"op6_exact_dedup": op6_exact.ORACLE, "op7_decontaminate": op7_decontaminate.ORACLE, "op12_hard_negatives": op12_negatives.ORACLE, "op13_divergence": op13_divergence.ORACLE}
