"""Readers, table store, staging folder and the adapter for the benchmark tables."""
