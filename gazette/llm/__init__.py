"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing outside this package imports it.  ``common.ship`` sends the package to
the executors, so they need no installation of it.
"""
