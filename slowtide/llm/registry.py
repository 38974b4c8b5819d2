"""The queries of this subpackage, and the check SQL of those that SQL can express."""

from __future__ import annotations

import importlib

#: Query name -> (module, function).
_PLACES = {
    "op1_license_scan": ("licenses", "op1_license_scan"),
    "op2_language": ("language", "op2_language"),
    "op3_warc_revisits": ("warc", "op3_warc_revisits"),
    "op4_simhash": ("simhash", "op4_simhash"),
    "op5_url_filter": ("urls", "op5_url_filter"),
    "op6_binary_ids": ("binary", "op6_binary_ids"),
    "op7_packing": ("packing", "op7_packing"),
    "op10_sentencepiece": ("viterbi", "op10_sentencepiece"),
    "op9_top_k": ("nearest", "op9_top_k"),
    "op8_quality_rules": ("quality", "op8_quality_rules"),
    "op11_pairwise_quality": ("ranking", "op11_pairwise_quality"),
    "op12_conversation_repair": ("repair", "op12_conversation_repair"),
    "op13_prefix_trie": ("trie", "op13_prefix_trie"),
}


def queries() -> dict:
    import corpus_pipeline

    found = {name: getattr(importlib.import_module(f"slowtide.llm.{module}"), function) for name, (module, function) in _PLACES.items()}
    return found | {"pipeline": corpus_pipeline.run}


def checks() -> dict[str, str]:
    from slowtide.llm import licenses, nearest, warc

    return {"op1_license_scan": licenses.CHECK, "op3_warc_revisits": warc.CHECK, "op9_top_k": nearest.CHECK}
