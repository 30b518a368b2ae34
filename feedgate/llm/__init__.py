"""Operators that prepare training data for language models.

Every module holds one operator; ``queries`` registers one query for each. Nothing outside this package
imports it.
"""
