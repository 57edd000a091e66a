"""The queries of this subpackage and their SQL."""

from seriesloom.llm import align, bpe, decontaminate, licenses, line_dedup, mixing, ngram_join, pii, quality, resample, token_ids, toxicity, url_filter

QUERIES = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_token_ids": token_ids.op6_token_ids,
    "op7_pii": pii.op7_pii,
    "op8_source_mixing": mixing.op8_source_mixing,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_tokenizer_alignment": align.op11_tokenizer_alignment,
    "op12_importance_resampling": resample.op12_importance_resampling,
    "op13_bpe_codec": bpe.op13_bpe_codec,
}

SQL = {
    "op1_ngram_jaccard_join": ngram_join.SQL,
    "op3_line_dedup": line_dedup.SQL,
    "op5_benchmark_decontamination": decontaminate.SQL,
    "op8_source_mixing": mixing.SQL,
    "op9_quality_rules": quality.SQL,
    "op10_url_filter": url_filter.SQL,
}
