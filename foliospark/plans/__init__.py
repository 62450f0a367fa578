"""Queries over the tables, one module for each area."""

from __future__ import annotations

import importlib

from .registry import CORE, Registry

MODULES = ("sessions", "references", "feedback", "corrections", "retrieval", "checks", "images", "events", "publishing", "sampling", "reports")


def load_all() -> Registry:
    """Import every module of queries; each registers its own."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return CORE
