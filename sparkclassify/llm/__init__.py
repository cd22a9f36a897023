"""Operators of a training-data pipeline over the ``documents`` table.

Nothing else in the library imports this subpackage; the driver file adds
its queries (``queries.py``) when it can be imported.
"""
