"""Operators for preparing training text: near copies, quality, mixing, personal data, repeated passages, benchmark
leaks, licences, line rules, toxicity and a language model. Nothing else in the library imports this subpackage."""
