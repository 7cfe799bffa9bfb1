"""Readers for change logs, base tables and replicas."""
