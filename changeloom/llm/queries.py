"""The queries of this package and, where SQL expresses them, their SQL for DuckDB."""

from __future__ import annotations

from changeloom.llm import graph_search, jaccard_join, mixing, pieces, quality, repair, secrets, token_files, tokens, tool_calls, url_filters, webp, whitening

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_mixing": mixing.op2_mixing,
    "op3_token_counts": tokens.op3_token_counts,
    "op4_tool_calls": tool_calls.op4_tool_calls,
    "op5_graph_search": graph_search.op5_graph_search,
    "op6_media_columns": webp.op6_media_columns,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_url_filters": url_filters.op8_url_filters,
    "op9_ngram_jaccard": jaccard_join.op9_ngram_jaccard,
    "op10_sentencepiece": pieces.op10_sentencepiece,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_token_files": token_files.op12_token_files,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES = {
    "op2_mixing": mixing.ORACLE,
    "op4_tool_calls": tool_calls.ORACLE,
    "op7_secret_scans": secrets.ORACLE,
    "op8_url_filters": url_filters.ORACLE,
    "op11_conversation_repair": repair.ORACLE,
}
