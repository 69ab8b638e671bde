"""Operators for preparing training text, each one a Spark job over whole tables."""
