"""Composed jobs (pipelines) and the registry of named queries."""
