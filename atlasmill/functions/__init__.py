"""Reusable building blocks: ranks, hierarchies, components, lineage cuts, deterministic hashing."""
