"""Operators of a training-data pipeline over documents and web pages.

One module per operator; ``queries`` registers one query for each.  Nothing outside this package imports it.
"""
