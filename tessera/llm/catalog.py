"""Queries of this folder and, where SQL can express them, the same on DuckDB."""

from __future__ import annotations

import corpus_pipeline
from tessera.llm import bpe, linededup, mixing, pii, prefixes, rules, runs, secret_scan, simhash, topk, toxicity, urls, warc

QUERIES = {
    "op1_bpe_codec": bpe.op1_bpe_codec,
    "op2_warc_merkle_audit": warc.op2_warc_merkle_audit,
    "op3_raked_mix": mixing.op3_raked_mix,
    "op4_simhash_vp_tree": simhash.op4_simhash_vp_tree,
    "op5_fuzzy_lines": linededup.op5_fuzzy_lines,
    "op6_quality_rules": rules.op6_quality_rules,
    "op7_ordinal_toxicity": toxicity.op7_ordinal_toxicity,
    "op8_secret_ownership": secret_scan.op8_secret_ownership,
    "op9_url_reputation": urls.op9_url_reputation,
    "op10_ball_tree_top_k": topk.op10_ball_tree_top_k,
    "op11_contextual_pii": pii.op11_contextual_pii,
    "op12_prefix_trie": prefixes.op12_prefix_trie,
    "op13_periodic_runs": runs.op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op2_warc_merkle_audit": warc.OP2_SQL,
    "op9_url_reputation": urls.OP9_SQL,
    "op10_ball_tree_top_k": topk.OP10_SQL,
    "op12_prefix_trie": prefixes.OP12_SQL,
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
}
