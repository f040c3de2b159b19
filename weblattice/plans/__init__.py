"""Iterative jobs, pipelines and lineage control."""
