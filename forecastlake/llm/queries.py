"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import ann, bpe, chat, collocations, jaccard, language, licenses, near_vectors, packing, sharding, spelling, toxicity, url_filter

QUERIES = {
    "op1_ngram_jaccard": jaccard.op1_ngram_jaccard,
    "op2_url_filters": url_filter.op2_url_filters,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_language_id": language.op4_language_id,
    "op5_byte_bpe": bpe.op5_byte_bpe,
    "op6_near_vectors": near_vectors.op6_near_vectors,
    "op7_packing": packing.op7_packing,
    "op8_permutation_search": ann.op8_permutation_search,
    "op9_sharding": sharding.op9_sharding,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_license_scans": licenses.op12_license_scans,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}
ORACLES = {"op2_url_filters": url_filter.ORACLE_SQL, "op11_spelling_variants": spelling.ORACLE_SQL,
           "op13_phrase_collocations": collocations.ORACLE_SQL}
