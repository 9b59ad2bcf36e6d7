"""Readers and writers for the partitioned file layouts."""
