"""Readers and writers: raw file drops, versioned tables, append-only logs, commit logs."""
