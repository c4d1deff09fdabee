"""Operators for preparing language-model training text.

Each module holds one operator with its own general interface; ``queries`` holds the thin
``opN_*`` queries that derive the contract columns from them.  Nothing outside this
subpackage imports it.
"""
