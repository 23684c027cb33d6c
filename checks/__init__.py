"""Queries over the test tables and their independent SQL twins."""
