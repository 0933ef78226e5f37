"""Registry of the package: ``QUERIES[name] = (callable, oracle SQL or None)``."""

from __future__ import annotations

from hirelens.llm import (
    conversations, counts, decontaminate, language, licenses, phrases, pieces, quality, repeats, secrets, simhash, tokenfile, topk)

QUERIES: dict = {
    "op1_license_scan": (licenses.op1_license_scan, licenses.ORACLE),
    "op2_simhash_near_dedup": (simhash.op2_simhash_near_dedup, None),
    "op3_exact_top_k": (topk.op3_exact_top_k, topk.ORACLE),
    "op4_token_counts": (counts.op4_token_counts, None),
    "op5_token_files": (tokenfile.op5_token_files, None),
    "op6_language_id": (language.op6_language_id, None),
    "op7_sentencepiece_n_best": (pieces.op7_sentencepiece_n_best, None),
    "op8_secret_scan": (secrets.op8_secret_scan, None),
    "op9_benchmark_decontamination": (decontaminate.op9_benchmark_decontamination, decontaminate.ORACLE),
    "op10_repeated_passages": (repeats.op10_repeated_passages, repeats.ORACLE),
    "op11_conversation_repair": (conversations.op11_conversation_repair, None),
    "op12_phrase_collocations": (phrases.op12_phrase_collocations, None),
    "op13_quality_rules": (quality.op13_quality_rules, None),
}
