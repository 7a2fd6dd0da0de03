"""Derived test tables, registered queries and their SQL twins."""
