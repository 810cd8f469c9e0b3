"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage; its queries are in
``queries.py`` and ``__spark_entry__.py`` adds them only when it is there.
"""
