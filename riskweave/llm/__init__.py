"""Training-data operators: thirteen document-scale operators and their queries.

Nothing else in the library imports this subpackage.
"""
