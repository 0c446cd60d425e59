"""Column functions that Spark lacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    """Places in which two strings of one length differ; null for other lengths."""
    differ = F.aggregate(F.arrays_zip(F.split(a, "").alias("x"), F.split(b, "").alias("y")), F.lit(0), lambda n, p: n + (p["x"] != p["y"]).cast("int"))
    return F.when(F.length(a) == F.length(b), differ)


def pseudo_dna(text: Column) -> Column:
    """A stable sequence of 32 bases for a string."""
    return F.translate(F.md5(text), "0123456789abcdef", "ACGTACGTACGTACGT")


def day_number(time: Column) -> Column:
    return F.unix_date(time.cast("date"))
