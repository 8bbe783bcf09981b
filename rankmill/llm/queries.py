"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from rankmill.llm import divergence, licenses, ngram_join, quality, substring_dedup, url_filter, warc
from rankmill.llm.bpe import op2_bpe
from rankmill.llm.decontaminate import op10_decontamination
from rankmill.llm.divergence import op12_source_divergence
from rankmill.llm.langid import op3_language_id
from rankmill.llm.licenses import op9_license_scan
from rankmill.llm.ngram_join import op1_ngram_jaccard
from rankmill.llm.quality import op6_quality_rules
from rankmill.llm.substring_dedup import op4_substring_dedup
from rankmill.llm.suffix_dedup import op5_suffix_array_dedup
from rankmill.llm.toxicity import op7_toxicity
from rankmill.llm.url_filter import op11_url_filter
from rankmill.llm.warc import op8_warc
from rankmill.llm.whitening import op13_whitening

QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_bpe": op2_bpe,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_license_scan": op9_license_scan,
    "op10_decontamination": op10_decontamination,
    "op11_url_filter": op11_url_filter,
    "op12_source_divergence": op12_source_divergence,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": ngram_join.ORACLE_SQL,
    "op4_substring_dedup": substring_dedup.ORACLE_SQL,
    "op6_quality_rules": quality.ORACLE_SQL,
    "op8_warc": warc.ORACLE_SQL,
    "op9_license_scan": licenses.ORACLE_SQL,
    "op11_url_filter": url_filter.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
}
