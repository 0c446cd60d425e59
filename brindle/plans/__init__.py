"""Whole analyses: the registered queries and the read pipeline."""
