"""Composed jobs: marts and pipelines."""
