"""Operators for preparing training data: tokens, mixing, sharding, archives, filters, duplicates, languages."""
