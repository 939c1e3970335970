"""The subpackage's queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, quality_rules
from .chat_format import op9_chat_formatting
from .decontamination import op8_benchmark_decontamination
from .license_scan import op2_license_scans
from .lm_scoring import op10_lm_scoring
from .near_dedup import op6_minhash_near_dedup
from .packing import op7_best_fit_packing
from .quality_model import op3_quality_classifier
from .quality_rules import op1_quality_rules
from .secret_scan import op5_secret_scans
from .toxicity import op4_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_license_scans,
        op3_quality_classifier,
        op4_toxicity,
        op5_secret_scans,
        op6_minhash_near_dedup,
        op7_best_fit_packing,
        op8_benchmark_decontamination,
        op9_chat_formatting,
        op10_lm_scoring,
    )
}
#: The others can't be written as SQL, or not with rows that are equal to the last bit; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op1_quality_rules": quality_rules.ORACLE, "op9_chat_formatting": chat_format.ORACLE}
