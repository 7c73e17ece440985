"""Operators for large training corpora: encoding, extraction, deduplication, decontamination, sharding, packing,
language, quality, chat formatting, set-similarity joins, hard negatives, byte-pair encoding and phrases. Nothing else in the library imports this package."""
