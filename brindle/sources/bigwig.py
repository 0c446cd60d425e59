"""bigWig files: coverage of a genome as compressed sections with a range index and zoom levels.

Tasks write the sections of their range of positions to parts; the driver, which gets a few numbers for each section of 1,024
intervals, lays out the file and writes heads and indexes; tasks then copy their parts to their places in it. The file lies on a file
system that every executor mounts. Reading goes by the index: a task takes a run of sections.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .folder import fresh, local

# Fixed values of the format: numbers that name a file, a tree of chromosomes and a range index.
MAGIC, CHROM_TREE, RANGE_TREE = 0x888FFC26, 0x78CA8C91, 0x2468ACE0

#: Intervals of a section, records of a zoom block, entries of an index node, sections that one task reads.
SECTION, ZOOM_BLOCK, NODE, RUN = 1_024, 512, 256, 256
#: A zoom level's bins are so many times as wide as those of the level before.
ZOOMS, STEP = 4, 8
ITEM = np.dtype([("start", "<u4"), ("end", "<u4"), ("value", "<f4")])
ZOOM = np.dtype([("chrom", "<u4"), ("start", "<u4"), ("end", "<u4"), ("valid", "<u4"), ("least", "<f4"), ("most", "<f4"), ("sum", "<f4"), ("squares", "<f4")])
BLOCKS = "part string, offset long, size long, first int, start long, last int, end long, n long, valid long, least double, most double, sum double, squares double"


def with_zero_tracks(cover: DataFrame, sizes: DataFrame) -> DataFrame:
    """cover (chrom, start, end, value) and, for each chrom of sizes (chrom, length) without an interval, one of value 0 over all of it."""
    rows = cover.select("chrom", "start", "end", F.col("value").cast("double").alias("value"))
    empty = sizes.join(rows.select("chrom").distinct(), "chrom", "left_anti")
    return rows.unionByName(empty.select("chrom", F.lit(0).cast("long").alias("start"), F.col("length").cast("long").alias("end"), F.lit(0.0).alias("value")))


def _zoomed(cover: DataFrame, width: int) -> DataFrame:
    """Zoom records of bins of a width: covered bases, least and most value, sums of value and its square over bases."""
    bins = F.explode(F.sequence(F.expr(f"start div {width}"), F.expr(f"(end - 1) div {width}"))).alias("bin")
    cut = cover.select("id", "start", "end", "value", bins)
    n = F.least("end", (F.col("bin") + 1) * width) - F.greatest("start", F.col("bin") * width)
    out = cut.withColumn("n", n).groupBy("id", "bin").agg(
        F.min(F.greatest("start", F.col("bin") * width)).alias("start"), F.max(F.least("end", (F.col("bin") + 1) * width)).alias("end"), F.sum("n").alias("valid"),
        F.min("value").alias("least"), F.max("value").alias("most"), F.sum(F.col("n") * F.col("value")).alias("sum"), F.sum(F.col("n") * F.col("value") * F.col("value")).alias("squares"),
    )
    return out.drop("bin")


def _section(chrom: int, rows: pd.DataFrame) -> bytes:
    items = np.empty(len(rows), dtype=ITEM)
    for c in ITEM.names:
        items[c] = rows[c]
    return struct.pack("<IIIIIBBH", chrom, int(items["start"][0]), int(items["end"][-1]), 0, 0, 1, 0, len(items)) + items.tobytes()


def _zoom_block(chrom: int, rows: pd.DataFrame) -> bytes:
    items = np.empty(len(rows), dtype=ZOOM)
    items["chrom"] = chrom
    for c in ZOOM.names[1:]:
        items[c] = rows[c]
    return items.tobytes()


def _blocks(records: DataFrame, made, most: int, folder: str) -> list:
    """Records, sorted by position, as compressed blocks of `most` in parts; returns BLOCKS rows in order, and so the parts too."""
    columns = [c.split()[0] for c in BLOCKS.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, at = f"{folder}/{uuid.uuid4().hex}", pd.DataFrame(), 0
        os.makedirs(folder, exist_ok=True)
        with open(part, "wb") as file:

            def put(rows: pd.DataFrame) -> tuple:
                nonlocal at
                chrom = int(rows["id"].iloc[0])
                data = zlib.compress(made(chrom, rows), 6)
                file.write(data)
                at += len(data)
                n = rows["end"] - rows["start"]
                stats = (int(n.sum()), rows["value"].min(), rows["value"].max(), float((n * rows["value"]).sum()), float((n * rows["value"] ** 2).sum())) if "value" in rows else (0, 0.0, 0.0, 0.0, 0.0)
                return (part, at - len(data), len(data), chrom, int(rows["start"].iloc[0]), chrom, int(rows["end"].iloc[-1]), len(rows), *stats)

            for frame in frames:
                held = pd.concat([held, frame], ignore_index=True)
                out = []
                # All whole blocks of a chromosome that another follows, and whole blocks of the last one.
                while len(held) and (len(held) > most or held["id"].iloc[0] != held["id"].iloc[-1]):
                    k = min(most, int((held["id"] == held["id"].iloc[0]).sum()))
                    out.append(put(held.iloc[:k]))
                    held = held.iloc[k:].reset_index(drop=True)
                yield pd.DataFrame(out, columns=columns)
            if len(held):
                yield pd.DataFrame([put(held)], columns=columns)

    ordered = records.repartitionByRange("id", "start").sortWithinPartitions("id", "start")
    return sorted(ordered.mapInPandas(run, BLOCKS).collect(), key=lambda r: (r["first"], r["start"]))


def _range_tree(blocks: list, offsets: list[int], at: int, end: int, most: int) -> bytes:
    """The range index of blocks that lie at offsets; it begins at `at` in the file."""
    leaves = [(r["first"], r["start"], r["last"], r["end"], o, r["size"]) for r, o in zip(blocks, offsets)]
    span = lambda part: (*part[0][:2], *max(x[2:4] for x in part))
    levels = [[leaves[k : k + NODE] for k in range(0, len(leaves), NODE)] or [[]]]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([[span(node) for node in below[k : k + NODE]] for k in range(0, len(below), NODE)])
    levels.reverse()
    sizes = [[4 + (32 if k == len(levels) - 1 else 24) * len(node) for node in level] for k, level in enumerate(levels)]
    starts, place = [], at + 48
    for level in sizes:
        starts.append([place + sum(level[:k]) for k in range(len(level))] if len(level) < 3 else [place + int(x) for x in np.cumsum([0, *level[:-1]])])
        place += sum(level)
    whole = span(leaves) if leaves else (0, 0, 0, 0)
    out = [struct.pack("<IIQIIIIQII", RANGE_TREE, NODE, len(leaves), *whole, end, most, 0)]
    for k, level in enumerate(levels):
        child = 0
        for node in level:
            last = k == len(levels) - 1
            out.append(struct.pack("<BBH", last, 0, len(node)))
            for entry in node:
                if last:
                    out.append(struct.pack("<IIIIQQ", *entry))
                else:
                    out.append(struct.pack("<IIIIQ", *entry, starts[k + 1][child]))
                    child += 1
    return b"".join(out)


def _chrom_tree(chroms: list[tuple[str, int]]) -> bytes:
    """The tree of chromosomes, names in order: one leaf."""
    width = max((len(n.encode()) for n, _ in chroms), default=1)
    head = struct.pack("<IIIIQQ", CHROM_TREE, max(len(chroms), 1), width, 8, len(chroms), 0)
    return head + struct.pack("<BBH", 1, 0, len(chroms)) + b"".join(n.encode().ljust(width, b"\0") + struct.pack("<II", k, size) for k, (n, size) in enumerate(chroms))


def write_bigwig(cover: DataFrame, sizes: DataFrame, path: str, bin_size: int = 10) -> None:
    """Intervals (chrom, start, end, value), which do not overlap, as one bigWig file; sizes (chrom, length) are its chromosomes, 65,535 at most.

    Chromosomes without intervals have a track of zeros. Intervals of chromosomes that sizes lacks, and null ones, are an
    error. The zoom levels begin at STEP bins and are STEP times as wide each; values are single precision.
    """
    spark, target = cover.sparkSession, local(path)
    chroms = sorted((r["chrom"], int(r["length"])) for r in sizes.select("chrom", "length").distinct().limit(65_536).collect())
    if len(chroms) > 65_535 or len({n for n, _ in chroms}) < len(chroms):
        raise ValueError("a bigWig file holds 65,535 chromosomes at most, each with one length")
    ids = spark.createDataFrame([(n, k) for k, (n, _) in enumerate(chroms)], "chrom string, id int")
    missing = F.raise_error(F.concat(F.lit("no such chromosome: "), F.coalesce("chrom", F.lit("null")))).cast("int")
    placed = with_zero_tracks(cover, sizes).join(F.broadcast(ids), "chrom", "left").select(F.coalesce("id", missing).alias("id"), "start", "end", "value")
    scratch = local(fresh(spark, "bigwig"))
    widths = [bin_size * STEP ** (k + 1) for k in range(ZOOMS)]
    data = _blocks(placed, _section, SECTION, scratch)
    zooms = [_blocks(_zoomed(placed, w), _zoom_block, ZOOM_BLOCK, scratch) for w in widths]

    def laid(blocks: list, at: int) -> tuple[list[int], int]:
        ends = np.cumsum([0, *(r["size"] for r in blocks)]) + at
        return ends[:-1].tolist(), int(ends[-1])

    tree = _chrom_tree(chroms)
    at_summary = 64 + 24 * ZOOMS
    at_tree = at_summary + 40
    at_data = at_tree + len(tree)
    offsets, end = laid(data, at_data + 8)
    index = _range_tree(data, offsets, end, end, SECTION)
    pieces, copies = [(at_data, struct.pack("<Q", len(data))), (end, index)], [(data, offsets)]
    heads, at_index, at = [], end, end + len(index)
    for width, blocks in zip(widths, zooms):
        places, stop = laid(blocks, at + 4)
        own = _range_tree(blocks, places, stop, stop, ZOOM_BLOCK)
        pieces += [(at, struct.pack("<I", sum(r["n"] for r in blocks))), (stop, own)]
        heads.append(struct.pack("<IIQQ", width, 0, at, stop))
        copies.append((blocks, places))
        at = stop + len(own)
    total = [sum(r[c] for r in data) for c in ("valid", "sum", "squares")]
    summary = struct.pack("<Qdddd", total[0], min((r["least"] for r in data), default=0.0), max((r["most"] for r in data), default=0.0), *total[1:])
    buffer = max(24 + SECTION * ITEM.itemsize, ZOOM_BLOCK * ZOOM.itemsize)
    head = struct.pack("<IHHQQQHHQQIQ", MAGIC, 4, ZOOMS, at_tree, at_data, at_index, 0, 0, 0, at_summary, buffer, 0)
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    with open(target, "wb") as file:
        for place, content in [(0, head + b"".join(heads) + summary + tree), *pieces, (at, struct.pack("<I", MAGIC))]:
            file.seek(place)
            file.write(content)
    # A part holds blocks that follow each other, so it goes to the place of its first.
    moves = [(part, next(rows)[1]) for blocks, places in copies for part, rows in groupby(zip((r["part"] for r in blocks), places), key=lambda x: x[0])]

    def copy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, place in zip(frame["part"], frame["place"]):
                with open(part, "rb") as source, open(target, "r+b") as file:
                    file.seek(place)
                    while block := source.read(1 << 22):
                        file.write(block)
            yield frame[["part"]]

    if moves:
        spark.createDataFrame(moves, "part string, place long").repartition(min(len(moves), 1_000)).mapInPandas(copy, "part string").count()
    for part, _ in moves:
        os.remove(part)


class BigWig:
    """The heads of a file: chromosomes by id, places of the data's and zoom levels' indexes."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            magic, _, zooms, tree, _, index, _, _, _, summary, _, _ = struct.unpack("<IHHQQQHHQQIQ", file.read(64))
            if magic != MAGIC:
                raise ValueError(f"{path} is no bigWig file")
            self.indexes = {0: index}
            for _ in range(zooms):
                width, _, _, at = struct.unpack("<IIQQ", file.read(24))
                self.indexes[width] = at
            file.seek(summary)
            self.summary = struct.unpack("<Qdddd", file.read(40))
            file.seek(tree)
            _, _, width, _, _, _ = struct.unpack("<IIIIQQ", file.read(32))
            self.chroms: dict[int, tuple[str, int]] = {}
            self._leaf(file, tree + 32, width)

    def _leaf(self, file, at: int, width: int) -> None:
        file.seek(at)
        leaf, _, n = struct.unpack("<BBH", file.read(4))
        entries = [file.read(width + 8) for _ in range(n)]
        for e in entries:
            if leaf:
                k, size = struct.unpack("<II", e[width:])
                self.chroms[k] = (e[:width].rstrip(b"\0").decode(), size)
            else:
                self._leaf(file, struct.unpack("<Q", e[width:])[0], width)

    def blocks(self, path: str, width: int = 0, chrom: int | None = None, start: int = 0, end: int = 1 << 32) -> list[tuple[int, int]]:
        """(place, size) of the blocks of the data, or of a zoom level, that may hold something of a range; all without one."""
        out: list[tuple[int, int]] = []
        with open(path, "rb") as file:

            def walk(at: int) -> None:
                file.seek(at)
                leaf, _, n = struct.unpack("<BBH", file.read(4))
                for entry in [file.read(32 if leaf else 24) for _ in range(n)]:
                    a, b, c, d = struct.unpack_from("<IIII", entry)
                    if chrom is None or ((a, b) < (chrom, end) and (chrom, start) < (c, d)):
                        if leaf:
                            out.append(struct.unpack_from("<QQ", entry, 16))
                        else:
                            walk(struct.unpack_from("<Q", entry, 16)[0])

            walk(self.indexes[width] + 48)
        return out


class _Run(InputPartition):
    def __init__(self, blocks: list[tuple[int, int]]) -> None:
        self.blocks = blocks


ROWS = "chrom string, start long, end long, value double"
ZOOM_ROWS = "chrom string, start long, end long, valid long, least double, most double, sum double, squares double"


class _BigWigReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.width, self.range = local(options["path"]), int(options.get("zoom", 0)), json.loads(options.get("range", "null"))

    def partitions(self) -> list[InputPartition]:
        file, where = BigWig(self.path), {}
        if self.range:
            chrom, start, end = self.range
            known = [k for k, (n, _) in file.chroms.items() if n == chrom]
            if not known:
                return [_Run([])]
            where = {"chrom": known[0], "start": start, "end": end}
        blocks = file.blocks(self.path, self.width, **where)
        return [_Run(blocks[k : k + RUN]) for k in range(0, len(blocks), RUN)] or [_Run([])]

    def read(self, partition: _Run):
        names = {k: n for k, (n, _) in BigWig(self.path).chroms.items()}
        with open(self.path, "rb") as file:
            for at, size in partition.blocks:
                file.seek(at)
                data = zlib.decompress(file.read(size))
                if self.width:
                    items = np.frombuffer(data, dtype=ZOOM)
                    chrom, columns = [names[k] for k in items["chrom"].tolist()], ZOOM.names[1:]
                else:
                    items = np.frombuffer(data, dtype=ITEM, offset=24)
                    chrom, columns = [names[struct.unpack_from("<I", data)[0]]] * len(items), ITEM.names
                keep = np.ones(len(items), dtype=bool)
                if self.range:
                    keep = (items["start"] < self.range[2]) & (items["end"] > self.range[1]) & (np.array(chrom) == self.range[0])
                kind = lambda c: np.int64 if c in ("start", "end", "valid") else np.float64
                arrays = [pa.array([c for c, k in zip(chrom, keep) if k], pa.string()), *(pa.array(items[c][keep].astype(kind(c))) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=["chrom", *columns])


class BigWigSource(DataSource):
    """format("bigwig") of one file: options zoom (a level's width, or 0), and range (a JSON list of chrom, start, end)."""

    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        return ZOOM_ROWS if int(self.options.get("zoom", 0)) else ROWS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BigWigReader(self.options)


def read_bigwig(spark: SparkSession, path: str, zoom: int = 0, within: tuple[str, int, int] | None = None) -> DataFrame:
    """Intervals (ROWS) of a bigWig file, or the records (ZOOM_ROWS) of one of its zoom levels; `within` (chrom, start, end) reads only the blocks that the index names, and of these what overlaps."""
    spark.dataSource.register(BigWigSource)
    return spark.read.format("bigwig").option("zoom", str(zoom)).option("range", json.dumps(within)).load(path)
