"""Readers and writers of read files, records, intervals and settings."""
