"""Registered queries with the SQL that checks them."""

from __future__ import annotations

import importlib

# Modules each defining QUERIES (name -> callable) and ORACLES (name -> SQL).
MODULES = ("tables", "harmonize", "images", "spatial", "texture", "extraction", "manifest", "arrivals")


def _gather(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"{__name__}.{name}")
        merged.update(getattr(module, attribute))
    return merged


def all_queries() -> dict:
    return _gather("QUERIES")


def all_oracles() -> dict:
    return _gather("ORACLES")
