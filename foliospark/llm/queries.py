"""Queries of the llm operators; each module registers its own."""

from __future__ import annotations

import importlib

from ..plans.registry import Registry

LLM = Registry()
MODULES = ("q_survivors", "q_chunking", "q_components", "q_tokens", "q_packing", "q_toxicity", "q_leakage", "q_repair")

for _name in MODULES:
    importlib.import_module(f"foliospark.llm.{_name}")
