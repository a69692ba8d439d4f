"""Operators for large training-data pipelines.

A self-contained subpackage: nothing else in the library imports it.
Each module holds one operator with its own general interface;
``queries`` registers the ``opN_<name>`` queries over the given tables.
"""
