"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import alignment, filter_audit, fingerprints, hnsw, jaccard, language, packing, pieces, quality, secret_scan, tokenfile, toxicity, wordbpe
from .oracle import ORACLE

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_embedding_dedup": hnsw.op2_embedding_dedup,
    "op3_token_file": tokenfile.op3_token_file,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_language": language.op5_language,
    "op6_ngram_jaccard": jaccard.op6_ngram_jaccard,
    "op7_sentencepiece": pieces.op7_sentencepiece,
    "op8_quality": quality.op8_quality,
    "op9_packing": packing.op9_packing,
    "op10_fingerprints": fingerprints.op10_fingerprints,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_word_bpe": wordbpe.op12_word_bpe,
    "op13_alignment": alignment.op13_alignment,
}

__all__ = ["ORACLE", "QUERIES"]
