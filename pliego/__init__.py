"""Procurement resolution and pricing analytics on Spark."""
