"""Rebuild, check and reconcile retail till data with PySpark."""
