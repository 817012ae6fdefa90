"""Operators for building training corpora: rules, copies, secrets, mixing, tokens, search and extraction."""
