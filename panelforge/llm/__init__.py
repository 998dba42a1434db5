"""Operators of a training-data pipeline (packing, near duplicates, privacy, scoring).

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.SQL`` hold what ``__spark_entry__`` registers.
"""
