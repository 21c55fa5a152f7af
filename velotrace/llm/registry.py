"""Every query of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from velotrace.llm import (
    audit_query,
    chat_query,
    decontaminate_query,
    fingerprint_query,
    jaccard_query,
    lexical_query,
    mixing_query,
    quality_query,
    repeats_query,
    token_query,
    toxicity_query,
    url_query,
    warc_query,
)

QUERIES = {
    f.__name__: f
    for f in (
        url_query.op1_url_filters,
        toxicity_query.op2_toxicity,
        mixing_query.op3_mixing_sources,
        decontaminate_query.op4_benchmark_decontamination,
        chat_query.op5_chat_formatting,
        warc_query.op6_warc_revisits,
        fingerprint_query.op7_document_fingerprints,
        repeats_query.op8_suffix_array_dedup,
        quality_query.op9_quality_classifier,
        jaccard_query.op10_ngram_jaccard_join,
        token_query.op11_token_files,
        audit_query.op12_filter_audit,
        lexical_query.op13_lexical_search,
    )
}

SQL = {
    "op1_url_filters": url_query.SQL,
    "op3_mixing_sources": mixing_query.SQL,
    "op5_chat_formatting": chat_query.SQL,
    "op10_ngram_jaccard_join": jaccard_query.SQL,
    "op6_warc_revisits": warc_query.SQL,
    "op12_filter_audit": audit_query.SQL,
    "op13_lexical_search": lexical_query.SQL,
}
