"""The queries of this package, and their SQL forms where SQL can say them."""

from __future__ import annotations

from .binary_search import op8_multi_index_hashing
from .bpe import op2_bpe_round_trip
from .language import op4_language_evidence
from .licenses import op9_license_chains
from .lm import op1_deleted_interpolation
from .mixing import OP7_SQL, op7_golden_mix
from .near import op6_near_classes
from .prefix_trie import OP13_SQL, op13_prefix_trie
from .quality import OP5_SQL, op5_line_rules
from .secrets import op10_secret_spans
from .toxicity import op3_toxicity
from .url_filter import op11_host_words
from .whitening import op12_polarised_whitening

QUERIES = {
    "op1_deleted_interpolation": op1_deleted_interpolation,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_toxicity": op3_toxicity,
    "op4_language_evidence": op4_language_evidence,
    "op5_line_rules": op5_line_rules,
    "op6_near_classes": op6_near_classes,
    "op7_golden_mix": op7_golden_mix,
    "op8_multi_index_hashing": op8_multi_index_hashing,
    "op9_license_chains": op9_license_chains,
    "op10_secret_spans": op10_secret_spans,
    "op11_host_words": op11_host_words,
    "op12_polarised_whitening": op12_polarised_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL = {
    "op5_line_rules": OP5_SQL,
    "op7_golden_mix": OP7_SQL,
    "op13_prefix_trie": OP13_SQL,
}
