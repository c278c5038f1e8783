"""Operators for preparing training data: near-duplicates, packing, search, chat, HTML, personal data,
language, tokenizing and toxicity."""
