"""Incremental resolution and progress."""
