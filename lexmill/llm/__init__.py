"""Operators on texts for the training of language models."""
