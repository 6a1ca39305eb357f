"""Registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from voxelark.llm import centroids, decontaminate, divergence, embeddings, html, language, minhash, pieces, quality, rollup, sharding, suffixes, superkmers

MODULES = (rollup, minhash, sharding, language, superkmers, embeddings, html, suffixes, pieces, decontaminate, centroids, divergence, quality)


def llm_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def llm_oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
