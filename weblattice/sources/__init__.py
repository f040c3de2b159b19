"""Readers and writers: text lines, edge lists, rank tables, crawl
SequenceFiles, rank/pair text sinks."""
