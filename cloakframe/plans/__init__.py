"""Derived inputs, registered queries and the SQL their results are checked against."""
