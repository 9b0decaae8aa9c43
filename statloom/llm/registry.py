"""All queries of the training-data operators by name, with their SQL where it exists."""

from statloom.llm import (  # noqa: F401
    alignment, ann, clustering, exact_dedup, html_text, language, line_dedup, mixing, packing, pii, sharding, simhash, warc,
)
from statloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
