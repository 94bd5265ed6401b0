"""Queries over the test tables, each beside the SQL that states its result."""
