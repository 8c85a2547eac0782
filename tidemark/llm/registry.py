"""The registered queries of the operators in this subpackage, and their check SQL."""

from __future__ import annotations

from tidemark.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    orchard,
    personal_data,
    quality,
    substring_dedup,
    suffix_dedup,
    whitening,
)

MODULES = (
    mixing, quality, license_scan, decontaminate, exact_dedup, html_extract, near_dedup, language_id, suffix_dedup, personal_data,
    whitening, orchard, substring_dedup,
)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
