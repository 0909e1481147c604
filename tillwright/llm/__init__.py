"""Operators for the preparation of training text: near-duplicates, archives, token
files, language-model scores, exact search, packing and byte-level encoding."""
