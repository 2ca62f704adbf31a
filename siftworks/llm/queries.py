"""The queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from . import bpe, exact_dedup, mixing, search, sharding, simhash, suffix_dedup, token_files, toxicity, url_filter

_MODULES = {
    "op1_simhash": simhash,
    "op2_url_filter": url_filter,
    "op3_exact_dedup": exact_dedup,
    "op4_sharding": sharding,
    "op5_bpe": bpe,
    "op6_search": search,
    "op7_toxicity": toxicity,
    "op8_mixing": mixing,
    "op9_suffix_dedup": suffix_dedup,
    "op10_token_files": token_files,
}

QUERIES = {name: m.query for name, m in _MODULES.items()}
ORACLES = {name: m.SQL for name, m in _MODULES.items() if m.SQL}
