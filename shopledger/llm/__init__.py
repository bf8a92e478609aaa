"""Operators for preparing text corpora.

Each module holds one operator with its own general interface; ``queries`` applies
them to the test tables. Nothing outside this subpackage imports it.
"""
