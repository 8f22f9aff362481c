"""Queries over the synthetic tables, and orchestration."""
