"""The queries of the training-data operators and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from . import bpe, cover_tree, exact_dedup, html_text, licenses, mixing, near_dedup, quality, sharding, token_counts

QUERIES = {
    "op1_cover_tree_dedup": cover_tree.op1_cover_tree_dedup,
    "op2_bpe_tokens": bpe.op2_bpe_tokens,
    "op3_minhash_dedup": near_dedup.op3_minhash_dedup,
    "op4_html_text": html_text.op4_html_text,
    "op5_jump_shards": sharding.op5_jump_shards,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_quality_qda": quality.op9_quality_qda,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}

#: The others are beyond SQL and are tested against libraries, brute force and plain versions.
ORACLE_SQL: dict[str, str] = {
    "op7_license_scan": licenses.OP7_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
}
