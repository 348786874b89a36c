"""Operators on training corpora: near copies, search, languages, secrets, licences, mixtures, tokens."""
