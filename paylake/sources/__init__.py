"""Readers and writers: lake tables, reference rows, test-table mapping."""
