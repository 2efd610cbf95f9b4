"""Readers, catalog tables and the sample data set."""
