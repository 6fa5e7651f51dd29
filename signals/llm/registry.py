"""The queries of this subpackage: name -> function of (spark, sf_dir), and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import the query modules, whose ``register`` calls fill the tables."""
    from signals.llm import queries  # noqa: F401
