"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import byte_bpe, centroids, chat, exact_dedup, html_text, line_dedup, mixing, ngram_join, prefix_trie, quality, secrets, substring_dedup, token_counts

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op2_token_counts": token_counts.query,
    "op3_quality_rules": quality.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_byte_bpe": byte_bpe.query,
    "op6_suffix_array_dedup": substring_dedup.query,
    "op7_ngram_jaccard_join": ngram_join.query,
    "op8_html_extraction": html_text.query,
    "op9_secret_scans": secrets.query,
    "op10_mixing": mixing.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_line_dedup": line_dedup.query,
    "op13_centroid_clustering": centroids.query,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_chat_formatting": chat.ORACLE,
    "op6_suffix_array_dedup": substring_dedup.ORACLE,
    "op7_ngram_jaccard_join": ngram_join.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op9_secret_scans": secrets.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
    "op13_centroid_clustering": centroids.ORACLE,
}
