"""Registered queries: the operators applied to the given tables, with SQL twins."""
