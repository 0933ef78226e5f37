"""Training-data operators: near-duplicates, search, tokens, language, secrets,
benchmark leaks, repeated passages. Nothing outside this package imports it."""
