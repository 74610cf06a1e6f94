"""The queries of this subpackage and, where SQL can express one, its oracle."""

from __future__ import annotations

from .chunk_dedup import op3_chunk_dedup
from .minhash import op8_minhash_near_dedup
from .mixing import op10_mixing
from .packing import op4_packing
from .quality_classifier import op7_quality_classifier
from .quality_rules import OP5_SQL, op5_quality_rules
from .secrets import op1_secret_scan
from .suffix_dedup import op6_suffix_dedup
from .token_counts import op2_token_counts
from .vector_graph import op9_vector_graph

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_counts": op2_token_counts,
    "op3_chunk_dedup": op3_chunk_dedup,
    "op4_packing": op4_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_vector_graph": op9_vector_graph,
    "op10_mixing": op10_mixing,
}

ORACLE_SQL = {
    "op5_quality_rules": OP5_SQL,
}
