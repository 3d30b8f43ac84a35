"""One query per operator, and SQL where it can express the result."""

from tierlake.llm import (
    exact_dedup, filter_audit, fingerprints, html_extract, jaccard_join, mixing, packing, partition_search, quality, sharding, substring_dedup,
    url_filter, whitening,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_sharding": sharding.query,
    "op3_fingerprints": fingerprints.query,
    "op4_quality": quality.query,
    "op5_mixing": mixing.query,
    "op6_url_filter": url_filter.query,
    "op7_jaccard_join": jaccard_join.query,
    "op8_substring_dedup": substring_dedup.query,
    "op9_html_extract": html_extract.query,
    "op10_packing": packing.query,
    "op11_neighbours": partition_search.query,
    "op12_whitening": whitening.query,
    "op13_filter_audit": filter_audit.query,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op7_jaccard_join": jaccard_join.SQL,
    "op8_substring_dedup": substring_dedup.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
