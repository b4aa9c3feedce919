"""Operators for building training corpora; nothing outside this folder needs them."""
