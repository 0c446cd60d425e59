"""Operators on reads, clusters, intervals and labels: DataFrame in, DataFrame out."""
