"""Operators for training-data corpora: mixing, dedup, quality, chat, decontamination, LM scoring, WARC, token files."""
