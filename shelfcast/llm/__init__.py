"""Operators for preparing training text: duplicates, leaks, toxicity, secrets, licences, scoring, mixing, sharding."""
