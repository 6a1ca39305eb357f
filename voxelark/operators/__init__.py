"""Operators on feature tables, voxel tables and study manifests."""
