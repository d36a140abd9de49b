"""Queries over the test tables, and the SQL that must give the same rows."""
