"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage.  ``queries.py`` holds
the registered queries and their SQL twins.
"""
