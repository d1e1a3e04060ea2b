"""Whole queries over the given tables, each next to the SQL it must agree with."""
