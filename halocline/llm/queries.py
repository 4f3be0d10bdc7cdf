"""One query for each operator of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from halocline.llm import ann, bpe, chat, fit, jaccard, langid, minhash, neardup, packing, passages, quality, resample, spelling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_passages": passages.op1_passages,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_packed_ids": packing.op3_packed_ids,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_bpe_round_trip": bpe.op5_bpe_round_trip,
    "op6_language": langid.op6_language,
    "op7_quality": quality.op7_quality,
    "op8_best_fit": fit.op8_best_fit,
    "op9_near_duplicates": neardup.op9_near_duplicates,
    "op10_nearest": ann.op10_nearest,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_importance_resampling": resample.op12_importance_resampling,
    "op13_fingerprints": minhash.op13_fingerprints,
}

SQL: dict[str, str] = {
    "op2_chat_formatting": chat.SQL,
    "op4_ngram_jaccard": jaccard.SQL,
    "op9_near_duplicates": neardup.SQL,
    "op11_spelling_variants": spelling.SQL,
    "op12_importance_resampling": resample.SQL,
}
