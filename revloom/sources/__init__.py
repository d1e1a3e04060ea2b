"""Corpus sources, intake bookkeeping and sinks."""
