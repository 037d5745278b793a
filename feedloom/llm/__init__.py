"""Operators for large text corpora: secrets, tokens, near copies, languages, licences, quality, shards, leaks, mixes."""
