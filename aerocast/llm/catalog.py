"""All queries of this subpackage (importing the modules registers them)."""

from aerocast.llm import (  # noqa: F401
    op1_suffix_array, op2_decontamination, op3_minhash, op4_sharding, op5_line_dedup, op6_exact_dedup,
    op7_quality, op8_toxicity, op9_substring_dedup, op10_bpe, op11_suffix_tree, op12_phrases, op13_alignment,
)
from aerocast.llm.registry import ORACLES, QUERIES  # noqa: F401
