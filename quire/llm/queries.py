"""Registered queries of this package and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm.kneserney import op9_kneser_ney
from quire.llm.language import op6_language_id
from quire.llm.mixing import OP2_SQL, op2_source_mixing
from quire.llm.negatives import OP13_SQL, op13_hard_negatives
from quire.llm.packing import op1_best_fit_packing
from quire.llm.quality import op3_quality_classifier
from quire.llm.repetition import op5_quality_rules
from quire.llm.resampling import op11_importance_resampling
from quire.llm.simhash import op10_simhash
from quire.llm.suffixdedup import op12_suffix_dedup
from quire.llm.tokencounts import op4_token_counts
from quire.llm.tokenfiles import op7_token_files
from quire.llm.vectors import op8_embedding_neardup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_source_mixing": op2_source_mixing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_token_files": op7_token_files,
    "op8_embedding_neardup": op8_embedding_neardup,
    "op9_kneser_ney": op9_kneser_ney,
    "op10_simhash": op10_simhash,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {"op2_source_mixing": OP2_SQL, "op13_hard_negatives": OP13_SQL}
