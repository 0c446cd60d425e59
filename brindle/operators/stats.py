"""Distributions: bins, weighted ECDFs, shares, roll-ups, histograms, descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Right-closed bins of reads in a cluster.
SIZE_BINS = ((0, "0"), (1, "1"), (5, "2-5"), (10, "6-10"), (20, "11-20"), (50, "21-50"), (100, "51-100"), (200, "101-200"))


def size_bin(size: Column) -> Column:
    out = F
    for top, name in SIZE_BINS:
        out = out.when(size <= top, name)
    return out.otherwise("201+")


def weighted_ecdf(rows: DataFrame, by: str, x: str, weight: str) -> DataFrame:
    """(by, x, ecdf): cumulative weight over the group's weight, one row for each value."""
    sums = rows.groupBy(by, x).agg(F.sum(weight).alias("w"))
    running = F.sum("w").over(Window.partitionBy(by).orderBy(x).rowsBetween(Window.unboundedPreceding, 0))
    return sums.select(by, x, F.round(running / F.sum("w").over(Window.partitionBy(by)), 6).alias("ecdf"))


def share_within(rows: DataFrame, by: str, value: str, name: str = "share") -> DataFrame:
    return rows.withColumn(name, F.round(F.col(value) / F.sum(value).over(Window.partitionBy(by)), 6))


def with_all(rows: DataFrame, sample: str, keys: list[str], value: str) -> DataFrame:
    """Sums by sample and keys, and over samples under the name all."""
    sets = [[F.col(sample), *map(F.col, keys)], [F.col(k) for k in keys]]
    summed = rows.groupingSets(sets, sample, *keys).agg(F.sum(value).alias(value))
    return summed.select(F.coalesce(F.col(sample).cast("string"), F.lit("all")).alias(sample), *keys, value)


def describe(rows: DataFrame, column: str) -> DataFrame:
    """count, mean, sample standard deviation, minimum, interpolated quartiles and maximum."""
    quartile = lambda p: F.round(F.percentile(column, F.lit(p)), 6)
    return rows.agg(F.count(column).alias("n"), F.round(F.avg(column), 6).alias("mean"), F.round(F.stddev_samp(column), 6).alias("std"), F.min(column).alias("least"), quartile(0.25).alias("q1"), quartile(0.5).alias("q2"), quartile(0.75).alias("q3"), F.max(column).alias("most"))


def histogram(rows: DataFrame, width: float, column: str, weight: Column | None = None) -> DataFrame:
    """(bin, n): sums of weight (or rows) in bins of a width from 0."""
    return rows.groupBy(F.floor(F.col(column) / width).alias("bin")).agg((F.count("*") if weight is None else F.sum(weight)).alias("n"))


def histogram_2d(rows: DataFrame, x: str, x_width: float, y: str, y_width: float) -> DataFrame:
    return rows.groupBy(F.floor(F.col(x) / x_width).alias("x_bin"), F.floor(F.col(y) / y_width).alias("y_bin")).agg(F.count("*").alias("n"))


def well(name: Column) -> Column:
    """The well in `...-A1` as A01."""
    found = F.regexp_extract(name, r"([^-]+)$", 1)
    return F.when(F.length(found) == 2, F.concat(F.substring(found, 1, 1), F.lit("0"), F.substring(found, 2, 1))).otherwise(found)


def ratio(parts: DataFrame, wholes: DataFrame, by: tuple[str, ...], value: str = "n") -> DataFrame:
    """(by, efficiency): each group's part of its whole; null without a whole."""
    joined = wholes.select(*by, F.col(value).alias("_whole")).join(parts.select(*by, F.col(value).alias("_part")), list(by), "left")
    return joined.select(*by, F.round(F.coalesce("_part", F.lit(0)) / F.nullif(F.col("_whole"), F.lit(0)), 6).alias("efficiency"))


def _reasons(skipped: dict[str, Column]) -> tuple[list[Column], Column]:
    """(a count for each reason, what is left): a record counts under the first reason that holds."""
    left, out = F.lit(True), []
    for reason, holds in skipped.items():
        holds = F.coalesce(holds, F.lit(False))
        out.append(F.count_if(left & holds).alias(f"n_{reason}"))
        left = left & ~holds
    return out, left


def counters(records: DataFrame, skipped: dict[str, Column]) -> DataFrame:
    """One row with n_read, n_written and, for each reason in turn, n_<reason>: a record counts under the first reason that holds."""
    out, left = _reasons(skipped)
    return records.agg(F.count("*").alias("n_read"), *out, F.count_if(left).alias("n_written"))


def observed(records: DataFrame, skipped: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """(the records that no reason skips, their counters): the counters are taken by the job that uses the records, with no scan of its own.

    `get` of the counters waits for that job. As counters(), with the same names.
    """
    out, left = _reasons(skipped)
    seen = Observation()
    return records.observe(seen, F.count(F.lit(1)).alias("n_read"), *out, F.count_if(left).alias("n_written")).where(left), seen


def ranked(rows: DataFrame, column: str, order: list[str]) -> DataFrame:
    """rows with rank, the place of column's value in a custom order; other values come after all, by name."""
    table = rows.sparkSession.createDataFrame([(v, k) for k, v in enumerate(order)], f"`{column}` string, rank int")
    return rows.join(F.broadcast(table), column, "left").withColumn("rank", F.coalesce("rank", F.lit(len(order))))


def product(*dimensions: DataFrame) -> DataFrame:
    """All combinations of the distinct rows of small dimensions."""
    out, *rest = (d.distinct() for d in dimensions)
    for d in rest:
        out = out.crossJoin(F.broadcast(d))
    return out


def path_counts(paths: DataFrame, path: str, value: str) -> DataFrame:
    """(sample, target, n) of counts named by paths `<sample>.<...>/<target>.<...>`; a path without a folder counts for all samples."""
    found = F.regexp_extract(F.col(path), r"^(?:([^/.]+)[^/]*/)?([^/.]+)[^/]*$", 1), F.regexp_extract(F.col(path), r"^(?:[^/.]+[^/]*/)?([^/.]+)[^/]*$", 1)
    return paths.select(F.coalesce(F.nullif(found[0], F.lit("")), F.lit("all")).alias("sample"), found[1].alias("target"), F.col(value).alias("n"))


def zoomed(rows: DataFrame, column: str, most: int) -> DataFrame:
    """The part of a plot's data up to a value."""
    return rows.where(F.col(column) <= most)


def quartiles(rows: DataFrame, by: str, column: str) -> DataFrame:
    """(by, q1, q2, q3): interpolated quartiles of each group.

    Equal values are counted first, so a group is as many rows as it has distinct values; their running counts give the two
    values that a quartile lies between.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(by, column).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(by).orderBy(column).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("upto", upto).withColumn("all", F.sum("n").over(Window.partitionBy(by)))
    out = []
    for k in (1, 2, 3):
        at = (F.col("all") - 1) * k / 4
        # The first value whose rows reach a place is the value at that place.
        value = lambda place: F.min(F.when(F.col("upto") > place, F.col(column)))
        part = F.first(at - F.floor(at))
        out.append(F.round(value(F.floor(at)) + part * (value(F.ceil(at)) - value(F.floor(at))), 6).alias(f"q{k}"))
    return placed.groupBy(by).agg(*out)


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, first): the distinct values in the order in which they first come."""
    return rows.groupBy(key).agg(F.min(order).alias("first")).orderBy("first")


def missing_keys(rows: DataFrame, others: DataFrame, key: str, other: str) -> DataFrame:
    """(key): the keys of rows that others lacks."""
    return rows.join(others, F.col(key) == F.col(other), "left_anti").select(key)
