"""Operators for preparing large text corpora: near-dedup, extraction, PII, tokens, quality, shards, mixes."""
