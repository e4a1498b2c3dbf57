"""Corpus operators for text pipelines: quality, language, tokens, copies, leaks and archives."""
