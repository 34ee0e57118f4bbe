"""Operators for training-data pipelines over documents and web pages.

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator.
"""
