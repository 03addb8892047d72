"""Preparation of training text: near duplicates, repeats, tokens, quality, extraction, mixing, search."""
