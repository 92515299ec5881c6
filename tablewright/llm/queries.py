"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from . import decontamination, exact_dedup, fingerprints, line_dedup, ngram_join, quality, ranked_search, secret_scan, sentencepiece_codec, source_mixing, spelling, substring_dedup, toxicity

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_fingerprints": fingerprints.op2_fingerprints,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_quality": quality.op7_quality,
    "op8_source_mixing": source_mixing.op8_source_mixing,
    "op9_sentencepiece": sentencepiece_codec.op9_sentencepiece,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_spelling": spelling.op11_spelling,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_decontamination": decontamination.op13_decontamination,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op4_ngram_join": ngram_join.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op8_source_mixing": source_mixing.ORACLE,
    "op10_secret_scan": secret_scan.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op12_ranked_search": ranked_search.ORACLE,
    "op13_decontamination": decontamination.ORACLE,
}
