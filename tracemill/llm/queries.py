"""The operators bound to their tables, and the SQL of those SQL can express."""

from tracemill.llm import audit, negatives, quality
from tracemill.llm.audit import op13_filter_audit
from tracemill.llm.language import op9_language_fusion
from tracemill.llm.minhash import op5_minhash_near_dedup
from tracemill.llm.negatives import op12_hard_negatives
from tracemill.llm.pieces import op3_sampled_pieces
from tracemill.llm.pii import op4_semi_markov_pii
from tracemill.llm.quality import op6_quality_rules
from tracemill.llm.secrets import op7_assignment_secrets
from tracemill.llm.templates import op1_line_templates
from tracemill.llm.tiling import op2_string_tiling
from tracemill.llm.tokens import op8_token_output
from tracemill.llm.toxicity import op10_toxicity
from tracemill.llm.vptree import op11_vantage_points

QUERIES = {
    "op1_line_templates": op1_line_templates,
    "op2_string_tiling": op2_string_tiling,
    "op3_sampled_pieces": op3_sampled_pieces,
    "op4_semi_markov_pii": op4_semi_markov_pii,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_assignment_secrets": op7_assignment_secrets,
    "op8_token_output": op8_token_output,
    "op9_language_fusion": op9_language_fusion,
    "op10_toxicity": op10_toxicity,
    "op11_vantage_points": op11_vantage_points,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE: dict[str, str] = {
    "op6_quality_rules": quality.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_filter_audit": audit.ORACLE,
}
