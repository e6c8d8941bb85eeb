"""Training-data operators: one module per operator, ``queries`` binds them to the tables.

Nothing else in the library imports this subpackage.
"""
