"""Scalar column helpers (JVM-side expressions only)."""

from .javatext import half_up, java_split, text_lines

__all__ = ["half_up", "java_split", "text_lines"]
