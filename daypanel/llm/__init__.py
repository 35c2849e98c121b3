"""Operators for large text corpora: rules, tokens, secrets, duplicates, sharding, models, language."""
