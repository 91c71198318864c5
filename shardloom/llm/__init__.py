"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Queries and their SQL are in
``queries``; every operator keeps its own module.
"""
