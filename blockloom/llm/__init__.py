"""Operators for building training corpora: filtering, deduplication, mixing and tokenisation of documents and pages."""
