"""Relational building blocks: text, crawl, graph."""
