"""Operators for corpora used to train language models."""
