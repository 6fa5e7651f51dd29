"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from signals.llm import (  # noqa: F401
    q_chat,
    q_jaccard,
    q_language,
    q_lexical,
    q_mixing,
    q_negatives,
    q_pii,
    q_ppm,
    q_quality,
    q_sentencepieces,
    q_sharding,
    q_simhash,
    q_toxicity,
)
