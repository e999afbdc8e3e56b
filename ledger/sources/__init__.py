"""Schemas, readers and the derived billing views of the test data."""
