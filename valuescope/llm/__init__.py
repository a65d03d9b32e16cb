"""Training-data operators.

Nothing else in the library imports this subpackage. ``queries.py`` lists its
registered queries, ``oracle.py`` their DuckDB texts.
"""
