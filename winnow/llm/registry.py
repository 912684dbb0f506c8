"""The queries of the training-data operators and, where SQL can state them, their SQL."""

from __future__ import annotations

from . import (conversation_repair, decontaminate, hamming_join, html_extraction, language_model, neighbours, ngram_join, packing,
               secret_scan, sharding, toxicity, url_filter, whitening)

QUERIES = {
    "op1_minimax_shards": sharding.op1_minimax_shards,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_html_extraction": html_extraction.op6_html_extraction,
    "op7_ngram_jaccard_join": ngram_join.op7_ngram_jaccard_join,
    "op8_random_projection_forest": neighbours.op8_random_projection_forest,
    "op9_pitman_yor_lm": language_model.op9_pitman_yor_lm,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_hamming_minhash": hamming_join.op11_hamming_minhash,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLE_SQL = {"op3_url_filter": url_filter.ORACLE}
