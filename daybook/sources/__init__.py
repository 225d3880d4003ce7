"""Inputs and outputs: log folders, file tables, JDBC, schemas, and the test-data views."""
