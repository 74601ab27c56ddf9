"""Preparation of training text: de-duplication, filters, tokens and packing.

Nothing else in the library imports this subpackage.
"""
