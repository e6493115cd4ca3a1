"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .chat_format import op12_chat_format
from .conversation_repair import op13_conversation_repair
from .decontamination import op10_benchmark_decontamination
from .hard_negatives import op11_hard_negatives
from .license_scan import op9_license_scan
from .line_dedup import op1_line_dedup
from .mixing import op5_source_mixing
from .pii import op4_pii
from .quality_rules import op3_quality_rules
from .simhash import op8_simhash
from .token_counts import op6_token_counts
from .token_output import op7_token_output
from .toxicity import op2_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_toxicity, op3_quality_rules, op4_pii, op5_source_mixing, op6_token_counts, op7_token_output, op8_simhash, op9_license_scan, op10_benchmark_decontamination, op11_hard_negatives, op12_chat_format, op13_conversation_repair)
}

#: The others need fitted models, XXH64, tokenizers, keyed hashes, fuzzy matching or shortest paths; tests/llm holds them against versions by hand.
ORACLES: dict[str, str] = {
    "op1_line_dedup": oracles.LINE_DEDUP,
    "op10_benchmark_decontamination": oracles.DECONTAMINATION,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op12_chat_format": oracles.CHAT_FORMAT,
}
