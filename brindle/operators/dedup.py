"""De-duplication of reads by keys, with the number of copies in dc."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from ..sources.folder import removed, written

#: Rows up to which groups, or what rounds have left undecided, are judged in order by one task. Larger groups go in rounds.
IN_ORDER = 200_000
#: Keys, and hashes of keys, that are broadcast at most.
BROADCAST, HASHES = 1 << 18, 1 << 20
POSITIONS = {"start": ("start", "ref_start"), "end": ("end", "ref_end")}


def parse_keys(expression: str) -> list[list[str]]:
    """`a&b|c` as [[a, b], [c]]: alternatives of keys that must all agree."""
    out = [[key.strip() for key in part.split("&")] for part in expression.split("|")]
    if not all(key for part in out for key in part):
        raise ValueError(f"empty key in {expression!r}")
    return out


def _column(reads: DataFrame, key: str) -> str:
    """The column of a key: `start` and `end` are ref_start and ref_end where the reads have no columns of their own names."""
    for name in POSITIONS.get(key, (key,)):
        if name in reads.columns:
            return name
    raise ValueError(f"reads have no column for the key {key}")


def _value(reads: DataFrame, key: str) -> Column:
    """A key's value, null where a read has none: a position needs a chromosome, and is not below 0; without either the read is unmapped."""
    name = _column(reads, key)
    if key not in POSITIONS or "rname" not in reads.columns:
        return F.col(name)
    return F.when((F.col("rname") != "*") & (F.col(name) >= 0), F.col(name))


def _parts(reads: DataFrame, alternatives: list[list[str]]) -> list[Column]:
    """Each alternative's key as an array of strings. Positions carry the chromosome and which end they are; values of other columns do not carry their column's name, so equal values of two columns of one kind are one key."""
    out = []
    for keys in alternatives:
        parts = []
        for key in keys:
            if key in POSITIONS:
                parts += ([F.col("rname")] if "rname" in reads.columns else []) + [F.col(_column(reads, key)).cast("string"), F.lit(f"@{key}")]
            else:
                kind = "#" if isinstance(reads.schema[key].dataType, NumericType) else "$"
                parts.append(F.concat(F.lit(kind), F.col(key).cast("string")))
        out.append(F.array(*parts))
    return out


def deduplicate(reads: DataFrame, by: str, within: list[str] | tuple[str, ...] = (), order: tuple[str, ...] = ("idx",), keep_unkeyed: bool = True) -> DataFrame:
    """The first read of each key in `order`, with dc, the reads that have it. Reads without one of the keys stay with dc 1, or go.

    `start` and `end` are positions on a chromosome: where the reads have a column rname, it belongs to these keys, and reads of
    the chromosome `*` or with a position below 0 are unmapped, that is without the key.

    One alternative is a window over the key. Several are judged in order: a read is a copy if an earlier kept read has one of
    its keys; it counts for the first alternative's, and copies give no keys. Groups of `within` of IN_ORDER rows or fewer stream
    through sorted partitions; larger ones, and a whole table without `within`, are judged in parallel rounds. Reads that `order` does
    not tell apart are taken in any order.
    """
    alternatives = parse_keys(by)
    complete = reduce(lambda a, b: a & b, [_value(reads, key).isNotNull() for part in alternatives for key in part])
    keyed, rest = reads.where(complete), reads.where(~complete).withColumn("dc", F.lit(1).cast("long"))
    if len(alternatives) == 1:
        (part,) = alternatives
        keys = [*(["rname"] if "rname" in reads.columns and set(POSITIONS) & set(part) else []), *(_column(reads, k) for k in part)]
        window = Window.partitionBy(*within, *keys)
        out = keyed.withColumn("_first", F.row_number().over(window.orderBy(*order))).withColumn("dc", F.count("*").over(window)).where("_first = 1").drop("_first")
    elif not within:
        out = in_rounds(keyed, alternatives, [], list(order))
    else:
        large = written(keyed.groupBy(*[F.col(c).alias(f"_{c}") for c in within]).agg(F.count("*").alias("_n")).where(F.col("_n") > IN_ORDER).drop("_n"), "large")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in within])
        if large.isEmpty():
            out = _greedy(keyed, alternatives, list(within), list(order))
        else:
            out = _greedy(keyed.join(large, same, "left_anti"), alternatives, list(within), list(order)).unionByName(in_rounds(keyed.join(large, same, "left_semi"), alternatives, list(within), list(order)))
    return out.unionByName(rest) if keep_unkeyed else out


def _greedy(reads: DataFrame, alternatives: list[list[str]], within: list[str], order: list[str]) -> DataFrame:
    """Judges each group in order, read by read, as it streams by in a sorted partition; memory follows the keys and kept reads of one group."""
    keyed = reads.withColumn("_keys", F.array(*_parts(reads, alternatives)))
    at = {c: k for k, c in enumerate(keyed.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept, seen, schema = None, [], {}, None

        def made(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

        for batch in batches:
            schema = pa.schema([*list(batch.schema)[:-1], pa.field("dc", pa.int64())])
            done: list[list] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                name = tuple(row[at[c]] for c in within)
                if name != group:
                    done += kept
                    group, kept, seen = name, [], {}
                own = [tuple(key) for key in row[-1]]
                hit = next((seen[key] for key in own if key in seen), None)
                if hit is None:
                    kept.append([*row[:-1], 1])
                    seen.update((key, kept[-1]) for key in own)
                else:
                    hit[-1] += 1
            yield made(done)
        if schema is not None:
            yield made(kept)

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.schema.fields) + ", dc long"
    return keyed.repartition(*within).sortWithinPartitions(*within, *order).mapInArrow(run, out)


def in_rounds(reads: DataFrame, alternatives: list[list[str]], within: list[str], order: list[str]) -> DataFrame:
    """The reads that judging in order keeps, with dc, found for a whole table at once.

    The first round is made by the first alternative: its keys' first reads are looked up, and those are kept that no read with one of their other keys comes before. All reads
    of a kept one's first key are then its copies, and are only counted, by key. What the other keys leave over goes into rounds, if none of its keys
    has an owner. Thus only summaries of keys are shuffled, and the reads left over; all reads are, if the keys that tell them apart are too many to be broadcast.
    """
    numbered = written(reads.withColumn("_id", F.monotonically_increasing_id()), "reads")
    group = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in within]
    keys = F.array(*[F.concat(F.array(*group), key) if group else key for key in _parts(reads, alternatives)])
    slim = numbered.select(F.struct(*order, "_id").alias("at"), keys.alias("keys"), F.struct(*numbered.columns).alias("row"))
    if numbered.count() <= IN_ORDER:
        kept = written(_rounds(slim.select("at", "keys")), "kept")
        waiting, origin, sums = slim, slim, None
    else:
        places = [slim.withColumn("key", F.get("keys", F.lit(k))) for k in range(len(alternatives))]
        firsts = written(places[0].groupBy("key").agg(F.min("at").alias("at"), F.count("*").alias("n")), "firsts")
        ids = firsts.select(F.col("at._id").alias("_first"))
        ids = F.broadcast(ids) if firsts.count() <= HASHES else ids
        candidates = written(slim.join(ids, F.col("at._id") == F.col("_first"), "left_semi"), "candidates")
        own = candidates.select("at", F.explode(F.array_distinct("keys")).alias("key"))
        others = reduce(DataFrame.unionByName, [_among(rows.select("at", "key"), own.select("key").distinct()) for rows in places[1:]]).groupBy("key").agg(F.min("at").alias("at"))
        first = firsts.select("key", "at").unionByName(others).groupBy("key").agg(F.min("at").alias("first"))
        chosen = own.join(first, "key").groupBy("at").agg(F.bool_and(F.col("first") == F.col("at")).alias("all_first")).where("all_first").select("at")
        now = written(candidates.join(chosen, "at", "left_semi"), "kept")
        owners = _owners(now)
        found = written(firsts.select("key", "n").join(owners, "key", "left"), "found")
        owned, free = found.where("owner IS NOT NULL"), found.where("owner IS NULL")
        rest = places[0]
        if owned.count() < free.count():
            rest = rest.join(_few(owned.select("key")), "key", "left_anti").drop("key")
        else:
            rest = _among(rest, free.select("key")).drop("key")
        rest = left = written(rest, "rest")
        for place in range(1, len(alternatives)):
            left = left.withColumn("key", F.get("keys", F.lit(place))).join(_few(owners.select("key")), "key", "left_anti").drop("key")
        left = written(left, "undecided")
        kept = now.select("at", "keys").unionByName(written(_rounds(left.select("at", "keys")), "kept"))
        waiting, origin = rest, now.unionByName(left)
        # The owner itself is among the reads of its own first key.
        own = now.select(F.col("at").alias("owner"), F.get("keys", F.lit(0)).alias("key"), F.lit(1).alias("self"))
        sums = owned.join(own, ["owner", "key"], "left").select("owner", (F.col("n") - F.coalesce("self", F.lit(0))).alias("_copies"))
    keyed = waiting.select("at", F.posexplode("keys").alias("place", "key"))
    copies = keyed.join(_few(_owners(kept)), "key").where(F.col("owner") < F.col("at"))
    counts = copies.groupBy("at").agg(F.min_by("owner", "place").alias("owner")).groupBy("owner").agg(F.count("*").alias("_copies"))
    counts = counts if sums is None else counts.unionByName(sums)
    counts = counts.groupBy(F.col("owner._id").alias("_id")).agg(F.sum("_copies").alias("_copies"))
    out = origin.select("row.*").join(kept.select(F.col("at._id").alias("_id")), "_id").join(counts, "_id", "left")
    return out.withColumn("dc", 1 + F.coalesce("_copies", F.lit(0))).drop("_id", "_copies")


def _owners(kept: DataFrame) -> DataFrame:
    """(key, owner) of kept reads (at, keys)."""
    return kept.select(F.col("at").alias("owner"), F.explode(F.array_distinct("keys")).alias("key"))


def _few(keys: DataFrame) -> DataFrame:
    """A table of keys, to be broadcast if it has BROADCAST rows or fewer."""
    return F.broadcast(keys) if keys.limit(BROADCAST + 1).count() <= BROADCAST else keys


def _among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows with one of the keys; up to HASHES of these, their hashes are broadcast first, so that few other rows are shuffled."""
    keys = written(keys, "keys")
    if keys.count() <= HASHES:
        rows = rows.withColumn("_hash", F.xxhash64("key")).join(F.broadcast(keys.select(F.xxhash64("key").alias("_hash"))), "_hash", "left_semi").drop("_hash")
    return rows.join(keys, "key", "left_semi")


def _rounds(reads: DataFrame) -> DataFrame:
    """The reads (at, keys) that judging in order keeps.

    In each round, a read that is the first undecided one of all its keys is kept, and all others that share one of them are
    copies: no read between them is left to decide otherwise. What remains goes into the next round; once it is
    IN_ORDER rows or fewer, one task judges them in order. A key that very many reads share decides all of them in its first round, and its
    rows are only aggregated and joined, never gathered.
    """
    left, kept = written(reads, "left"), None
    while left.count() > IN_ORDER:
        keyed = left.select("at", F.explode(F.array_distinct("keys")).alias("key"))
        first = keyed.groupBy("key").agg(F.min("at").alias("first"))
        chosen = keyed.join(first, "key").groupBy("at").agg(F.bool_and(F.col("first") == F.col("at")).alias("all_first")).where("all_first").select("at")
        now = written(left.join(chosen, "at", "left_semi"), "kept")
        kept = now if kept is None else kept.unionByName(now)
        gone = keyed.join(_owners(now).select("key").distinct(), "key", "left_semi").select("at").distinct()
        before, left = left, written(left.join(gone, "at", "left_anti"), "left")
        removed(before)
    last = _in_order(left)
    return last if kept is None else kept.unionByName(last)


def _in_order(left: DataFrame) -> DataFrame:
    """The reads (at, keys), few enough for one task, that judging in order keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            keep = []
            for keys in batch.column("keys").to_pylist():
                own = [tuple(k) for k in keys]
                keep.append(not any(k in seen for k in own))
                if keep[-1]:
                    seen.update(own)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return left.repartition(1).sortWithinPartitions("at").mapInArrow(run, left.schema)


def multiplicity(reads: DataFrame) -> DataFrame:
    """(dc, n_reads): how many kept reads have how many copies."""
    return reads.groupBy("dc").agg(F.count("*").alias("n_reads"))


def write_multiplicity(reads: DataFrame, path: str) -> None:
    """The histogram of multiplicity() as one file of `dc<tab>n_reads` lines in order, without a header."""
    multiplicity(reads).coalesce(1).sortWithinPartitions("dc").write.csv(path, sep="\t", header=False)


def duplication(reads: DataFrame, *by: str) -> DataFrame:
    """(by, n_written, n_total, rate) of kept reads with dc: rate is the share of reads that were copies."""
    return reads.groupBy(*by).agg(F.count("*").alias("n_written"), F.sum("dc").alias("n_total"), F.round(1 - F.count("*") / F.nullif(F.sum("dc"), F.lit(0)), 6).alias("rate"))


def library_complexity(counts: DataFrame, total: str = "n_total", unique: str = "n_written") -> DataFrame:
    """counts with complexity: the M of M (1 - exp(-total / M)) = unique, by bisection; null where no copy was seen."""

    @F.pandas_udf("double")
    def solve(n: pd.Series, u: pd.Series) -> pd.Series:
        import math

        def one(n: float, u: float) -> float | None:
            if not u or not n or u >= n:
                return None
            low, high = u, u * 2.0
            while high * -math.expm1(-n / high) < u:
                high *= 2
            for _ in range(200):
                mid = (low + high) / 2
                low, high = (mid, high) if mid * -math.expm1(-n / mid) < u else (low, mid)
            return (low + high) / 2

        return pd.Series([one(a, b) for a, b in zip(n, u)], dtype=float)

    return counts.withColumn("complexity", solve(F.col(total).cast("double"), F.col(unique).cast("double")))
