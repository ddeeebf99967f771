"""Imports every query module of this subpackage, so that its registry is full."""

from labelloom.llm import (  # noqa: F401
    ann, bpe, exact_dedup, jaccard, manifest, packing, pii, quality, quality_rules,
    substring_dedup, url_filter, vector_codes, warc,
)
from labelloom.llm.registry import ORACLES, QUERIES  # noqa: F401
