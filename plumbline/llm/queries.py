"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from plumbline.llm import (
    dualtree, linededup, minhash, mixing, multiindex, packing, pfor, quality, rabitq, secretscan, sentencespans, toxicity,
    whitening,
)

QUERIES = {f.__name__: f for f in (
    quality.op1_quality, sentencespans.op2_sentence_spans, multiindex.op3_code_search, packing.op4_packing,
    pfor.op5_token_files, mixing.op6_target_mixture, secretscan.op7_secret_scan, rabitq.op8_rotation_codes,
    toxicity.op9_toxicity, minhash.op10_minmax_near_duplicates, linededup.op11_line_bitmaps,
    dualtree.op12_dual_tree_codes, whitening.op13_whitening,
)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator; the others are held against brute force in tests."""
    return {
        "op3_code_search": multiindex.OP3_SQL, "op8_rotation_codes": rabitq.OP8_SQL,
        "op10_minmax_near_duplicates": minhash.OP10_SQL, "op11_line_bitmaps": linededup.OP11_SQL,
        "op12_dual_tree_codes": dualtree.OP12_SQL,
    }
