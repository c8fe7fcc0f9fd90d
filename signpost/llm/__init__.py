"""Operators for training-data corpora: filters, near duplicates, scores, extraction, mixing and token files."""
