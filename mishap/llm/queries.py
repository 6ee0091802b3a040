"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from mishap.llm import (
    decontamination,
    hilbert_ann,
    language_id,
    lexical_search,
    packing,
    quality,
    sentencepieces,
    sharding,
    simhash_dedup,
    surrogates,
    token_alignment,
    url_filter,
    warc_fixity,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_warc_fixity": warc_fixity.op2_warc_fixity,
    "op3_packing": packing.op3_packing,
    "op4_surrogates": surrogates.op4_surrogates,
    "op5_hilbert_ann": hilbert_ann.op5_hilbert_ann,
    "op6_language_id": language_id.op6_language_id,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_simhash_dedup": simhash_dedup.op8_simhash_dedup,
    "op9_quality": quality.op9_quality,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_sentencepiece": sentencepieces.op11_sentencepiece,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

ORACLE = {
    "op1_sharding": sharding.ORACLE,
    "op2_warc_fixity": warc_fixity.ORACLE,
    "op7_decontamination": decontamination.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op12_lexical_search": lexical_search.ORACLE,
}
