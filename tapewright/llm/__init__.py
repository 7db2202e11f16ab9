"""Operators for building text corpora: dedup, decontamination, tokenizing, cleaning, sharding."""
