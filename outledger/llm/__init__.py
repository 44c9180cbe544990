"""Operators over text corpora: cleaning, deduplication, tokens, licences, archives, personal data."""
