"""Registered queries over the test tables and the SQL they are checked with."""
