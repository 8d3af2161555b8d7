"""Readers, writers and the adapters from the test tables to the data model."""
