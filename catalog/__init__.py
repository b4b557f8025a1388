"""Queries over the driver tables and the SQL each is checked against."""
