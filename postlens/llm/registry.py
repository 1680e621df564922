"""Queries of this subpackage and the SQL that must give the same rows."""

from postlens.llm import (
    decontaminate,
    embedding_dedup,
    jaccard_join,
    lang_id,
    license_scan,
    lm_score,
    packing,
    periodic_runs,
    ranked_search,
    suffix_dedup,
    toxicity,
    url_rules,
    warc,
)

MODULES = (
    suffix_dedup,
    embedding_dedup,
    packing,
    lang_id,
    jaccard_join,
    decontaminate,
    lm_score,
    url_rules,
    toxicity,
    warc,
    ranked_search,
    periodic_runs,
    license_scan,
)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
