"""Readers: JDBC, lakehouse tables, information_schema, test fixtures."""
