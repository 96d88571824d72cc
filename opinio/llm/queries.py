"""The registered queries of the training-data operators and, where SQL can say it, their oracle."""

from __future__ import annotations

from . import caps, chat_format, decontaminate, html_wrapper, licenses, ngram_join, packing, quality, ranked_search, runs, secrets, token_counts, toxicity

LLM_QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_ngram_jaccard_join": ngram_join.op5_ngram_jaccard_join,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_html_extraction": html_wrapper.op9_html_extraction,
    "op10_embedding_near_dedup": caps.op10_embedding_near_dedup,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_sequence_packing": packing.op7_sequence_packing,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_chat_formatting": chat_format.op12_chat_formatting,
    "op13_ranked_search": ranked_search.op13_ranked_search,
}

# op10 has a recall below 1 by its method, so its exact SQL is a test, not an oracle.
LLM_ORACLE = {
    "op4_benchmark_decontamination": decontaminate.OP4_ORACLE,
    "op5_ngram_jaccard_join": ngram_join.OP5_ORACLE,
    "op12_chat_formatting": chat_format.OP12_ORACLE,
    "op13_ranked_search": ranked_search.OP13_ORACLE,
}
