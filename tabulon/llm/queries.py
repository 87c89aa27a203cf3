"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .chat import OP2_SQL, op2_chat_format
from .decontaminate import op10_benchmark_decontamination
from .fingerprints import op5_edit_fingerprints
from .jaccard import OP8_SQL, op8_ngram_jaccard_join
from .merkle import OP12_SQL, op12_merkle_manifest
from .orc_tokens import op9_token_orc
from .packing import op4_best_fit_packing
from .periods import OP13_SQL, op13_periodic_runs
from .quality import op7_quality_classifier
from .simhash import op11_simhash_groups
from .substrings import OP6_SQL, op6_substring_dedup
from .toxicity import op1_toxicity_chain
from .warc import OP3_SQL, op3_warc_zip

QUERIES = {
    "op1_toxicity_chain": op1_toxicity_chain,
    "op2_chat_format": op2_chat_format,
    "op3_warc_zip": op3_warc_zip,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_edit_fingerprints": op5_edit_fingerprints,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_token_orc": op9_token_orc,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_simhash_groups": op11_simhash_groups,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE: dict[str, str] = {
    "op2_chat_format": OP2_SQL,
    "op3_warc_zip": OP3_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op8_ngram_jaccard_join": OP8_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_periodic_runs": OP13_SQL,
}
