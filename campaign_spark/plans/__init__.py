"""Composed analyses: the campaign stages, the test-table binding, the query
registry and its SQL twins."""
