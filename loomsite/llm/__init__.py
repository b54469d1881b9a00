"""Operators for training-data pipelines. Nothing else in the library imports this."""

from __future__ import annotations

from importlib import import_module

#: The modules with queries, by operator number.
MODULES = {1: "chat", 2: "langid", 3: "toxicity", 4: "vecdedup", 5: "linededup", 6: "bpe", 7: "jaccard", 8: "decontam", 9: "substring", 10: "urls", 11: "pieces", 12: "repair", 13: "negatives"}


def queries() -> dict:
    found: dict = {}
    for name in MODULES.values():
        found |= import_module(f"loomsite.llm.{name}").QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES.values():
        found |= import_module(f"loomsite.llm.{name}").ORACLES
    return found
