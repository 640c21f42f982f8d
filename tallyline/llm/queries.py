"""All queries of this subpackage; importing it registers them."""

from tallyline.llm import (  # noqa: F401
    flat_graph, mixing, pieces, quality, signature_join, simhash, spelling, suffix_dedup, token_counts, token_files, toxicity, warc, whitening,
)
from tallyline.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
