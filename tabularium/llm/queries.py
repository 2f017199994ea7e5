"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from .decontam import op9_bm25_decontamination
from .fixity import OP8_SQL, op8_merkle_fixity
from .htmltext import op2_consensus_host_paths
from .neardup import op5_minhash_near_dedup
from .packing import op10_best_fit_packing
from .pii import op1_personal_data
from .quality import OP3_SQL, op3_quality_rules
from .substring import op4_repeated_phrase_automata
from .tokenio import op7_token_ids
from .urlfilter import OP6_SQL, op6_url_digest_filter

QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op3_quality_rules": op3_quality_rules,
    "op2_consensus_host_paths": op2_consensus_host_paths,
    "op4_repeated_phrase_automata": op4_repeated_phrase_automata,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_url_digest_filter": op6_url_digest_filter,
    "op7_token_ids": op7_token_ids,
    "op8_merkle_fixity": op8_merkle_fixity,
    "op9_bm25_decontamination": op9_bm25_decontamination,
    "op10_best_fit_packing": op10_best_fit_packing,
}

ORACLE_SQL = {
    "op3_quality_rules": OP3_SQL,
    "op6_url_digest_filter": OP6_SQL,
    "op8_merkle_fixity": OP8_SQL,
}
