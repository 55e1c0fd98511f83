"""The registered queries of this package, and their SQL where SQL can state them."""

from slotwise.llm import (  # noqa: F401  (each registers its query)
    ann, bpe, conversations, exact_dedup, html_text, impact_topk, importance, licences, minhash_dedup, mixing,
    passages, substring_exact, toxicity)
from slotwise.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
