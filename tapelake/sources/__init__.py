"""Readers for tapes, archives and the price index, and the Parquet sinks of each layer."""
