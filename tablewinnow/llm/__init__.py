"""Operators that prepare training data for language models.

Each module holds one operator with its registered query; ``registry`` lists the
queries and their SQL. Nothing outside this package imports it but the entry
module, which does without it when it is not there.
"""
