"""FASTQ, read pairs and FASTA by byte ranges: files are cut anywhere, and each range finds its own first record.

What a range cannot know by itself (how many records, or which sequence and how many bases, came before) is counted by
one pass of a few numbers a range and summed on the driver, which holds a row for each range, never a record. Gzip files cannot be cut and are one
range. Files lie on a file system that every executor mounts.
"""

from __future__ import annotations

import glob
import gzip
import json
import os
from collections.abc import Iterator
from itertools import accumulate, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .folder import local

#: Bytes of a range, bases of a FASTA window, and records of an Arrow batch.
SPLIT, WINDOW, BATCH = 32 << 20, 1 << 16, 10_000
#: Bytes before a place in which the line that it lies in is looked for. A FASTA header is shorter.
HEADER = 1 << 16
BLOCK = 1 << 20
#: Ranges for each core that split_for aims at.
SHARES = 4
WHITE = b" \t\n\r\x0b\x0c"


def files_of(*paths: str) -> list[str]:
    """The files of paths; a folder stands for its visible files, in order of their names."""
    out = []
    for path in map(local, paths):
        out += sorted(f for f in glob.glob(f"{glob.escape(path)}/*") if not os.path.basename(f).startswith(("_", "."))) if os.path.isdir(path) else [path]
    return out


def zipped(path: str) -> bool:
    with open(path, "rb") as probe:
        return probe.read(2) == b"\x1f\x8b"


def cut(paths: list[str], split: int) -> list[tuple[int, str, int, int]]:
    """(file's place, path, start, end) of the ranges of files; end -1 is that of a gzip file."""
    out = []
    for k, path in enumerate(paths):
        size = os.path.getsize(path)
        out += [(k, path, 0, -1)] if zipped(path) else [(k, path, a, min(a + split, size)) for a in range(0, max(size, 1), split)]
    return out


def split_for(spark: SparkSession, *paths: str, least: int = 1 << 20, most: int = SPLIT) -> int:
    """Bytes of a range so that files are SHARES ranges a core, but no less than `least`, nor more than `most`: small files have several ranges, and large ones no more than their bytes need."""
    total = sum(map(os.path.getsize, files_of(*paths)))
    return min(max(total // (SHARES * spark.sparkContext.defaultParallelism), least), max(least, most))


def fastq_start(file, at: int, size: int) -> int:
    """The first byte at or behind `at` where a FASTQ record begins: a line that begins with @, two lines before one that begins with +. No sequence begins with either."""
    if at <= 0:
        return 0
    file.seek(at - 1)
    file.readline()
    places, lines = [file.tell()], []
    while places[0] < size:
        while len(lines) < 3 and (line := file.readline()):
            lines.append(line[:1])
            places.append(file.tell())
        if len(lines) < 3:
            return size
        if lines[0] == b"@" and lines[2] == b"+":
            return places[0]
        lines.pop(0)
        places.pop(0)
    return size


def fastq_range(path: str, start: int, end: int) -> tuple[int, int, int]:
    """(first byte, last byte, records) of the records that begin in a range of bytes."""
    size = os.path.getsize(path)
    with open(path, "rb") as file:
        first, last = fastq_start(file, start, size), fastq_start(file, end, size)
        lines, at, tail = 0, first, b"\n"
        file.seek(first)
        while at < last:
            tail = file.read(min(BLOCK, last - at))
            lines, at = lines + tail.count(b"\n"), at + len(tail)
    return first, last, (lines + (not tail.endswith(b"\n"))) // 4


def _counted(spark: SparkSession, ranges: list[tuple], count, schema: str) -> dict[tuple[str, int], tuple]:
    """What count(path, start, end) gives for each range, (path, start) -> numbers; only those of ranges come to the driver."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(p, a, *count(p, a, b)) for p, a, b in zip(frame["path"], frame["start"], frame["end"])], columns=["path", "start", *columns])

    if not ranges:
        return {}
    rows = spark.createDataFrame([r[1:4] for r in ranges], "path string, start long, end long").repartition(min(len(ranges), 10_000))
    return {(r[0], r[1]): tuple(r)[2:] for r in rows.mapInPandas(run, f"path string, start long, {schema}").collect()}


class _Range(InputPartition):
    def __init__(self, spec: list) -> None:
        self.spec = spec


class _Source(DataSource):
    """Sources whose partitions the caller has worked out: option `ranges`, a JSON list."""

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return self.made(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = {k: v for k, v in options.items() if k != "ranges"}
        self.ranges = json.loads(options["ranges"])

    def __getstate__(self) -> dict:
        """Without the ranges: each task gets its own, so what is sent does not grow with their square."""
        return {"options": self.options}

    def partitions(self) -> list[InputPartition]:
        return [_Range(r) for r in self.ranges]


def _opened(path: str, at: int = 0):
    file = gzip.open(path, "rb") if zipped(path) else open(path, "rb")
    if at:
        file.seek(at)
    return file


def fastq_records(path: str, first: int, n: int | None, index: int, skip: int = 0) -> Iterator[tuple[bytes, bytes, bytes, bytes]]:
    """n records (all if None) from a byte on, `skip` left out before them. A record that the end of the file cuts short is dropped, any other that is none is an error."""
    with _opened(path, first) as file:
        for _ in islice(file, 4 * skip):
            pass
        lines = (line.rstrip(b"\r\n") for line in file)
        for name, seq, plus, qual in islice(zip(lines, lines, lines, lines), n):
            if name[:1] != b"@" or plus[:1] != b"+" or len(seq) != len(qual):
                raise ValueError(f"{path}: record {index} is no FASTQ record")
            yield name[1:], seq, plus, qual
            index += 1


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array([x.decode() if isinstance(x, bytes) else x for x in c], f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


FASTQ = "file string, idx long, qname string, seq string, plus string, qual string"
PAIRS = "pair int, idx long, qname string, seq1 string, qual1 string, seq2 string, qual2 string"
FASTA = "chrom string, offset long, seq string"


class _FastqReader(_Reader):
    def read(self, partition: _Range):
        path, first, n, index = partition.spec
        rows = ((path, index + k, *record) for k, record in enumerate(fastq_records(path, first, n, index)))
        yield from _batches(rows, _schema(FASTQ))


class FastqSource(_Source):
    made = _FastqReader

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return FASTQ


class _PairReader(_Reader):
    def read(self, partition: _Range):
        pair, index, n, (one, at_one), (two, at_two, skip) = partition.spec
        both = zip(fastq_records(one, at_one, n, index), fastq_records(two, at_two, n, index, skip))
        rows = ((pair, index + k, a[0], a[1], a[3], b[1], b[3]) for k, (a, b) in enumerate(both))
        yield from _batches(rows, _schema(PAIRS))


class PairSource(_Source):
    made = _PairReader

    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self) -> str:
        return PAIRS


def _placed(spark: SparkSession, paths: list[str], split: int) -> list[list[tuple[int, int | None, int]]]:
    """For each file its ranges in order: (first byte, records, records before); the records of a gzip file are not counted (None)."""
    ranges = cut(paths, split)
    counts = _counted(spark, [r for r in ranges if r[3] >= 0], fastq_range, "first long, last long, n long")
    out: list[list] = [[] for _ in paths]
    for k, path, start, end in ranges:
        first, _, n = counts[path, start] if end >= 0 else (0, 0, None)
        before = sum(out[k][-1][1:3]) if out[k] else 0
        if n is None or n:
            out[k].append((first, n, before))
    return out


def _loaded(spark: SparkSession, source: type[_Source], ranges: list) -> DataFrame:
    spark.dataSource.register(source)
    if not ranges:
        return spark.createDataFrame([], source({}).schema())
    return spark.read.format(source.name()).option("ranges", json.dumps(ranges)).load()


def read_fastq(spark: SparkSession, *paths: str, split: int = SPLIT) -> DataFrame:
    """FASTQ files (FASTQ), or folders of them; idx is a record's number in its file. A plain file is read by a task for each range of `split` bytes."""
    files = files_of(*paths)
    return _loaded(spark, FastqSource, [(path, first, n, before) for path, ranges in zip(files, _placed(spark, files, split)) for first, n, before in ranges])


def read_pairs(spark: SparkSession, one: list[str], two: list[str], split: int = SPLIT) -> DataFrame:
    """Pairs (PAIRS) of two lists of FASTQ files, or folders of as many, in turn; a longer file's rest is left out.

    A task reads a range of the first file and the same records of the second, found by the counts of that file's ranges: pairs
    meet without a shuffle. Where either file is gzip, one task reads both.
    """
    left, right = files_of(*one), files_of(*two)
    if len(left) != len(right):
        raise ValueError(f"{len(left)} files cannot pair with {len(right)}")
    at_left, at_right = _placed(spark, left, split), _placed(spark, right, split)
    out = []
    for pair, (a, b, xs, ys) in enumerate(zip(left, right, at_left, at_right)):
        if any(n is None for _, n, _ in (*xs, *ys)):
            out.append((pair, 0, None, (a, 0), (b, 0, 0)))
            continue
        total = sum(n for _, n, _ in ys)
        for first, n, before in xs:
            if before < total:
                at, _, base = max((y for y in ys if y[2] <= before), key=lambda y: y[2])
                out.append((pair, before, min(n, total - before), (a, first), (b, at, before - base)))
    return _loaded(spark, PairSource, out)


def fasta_start(file, at: int, size: int) -> tuple[int, bool]:
    """(first byte, whether a line begins there) of what a range that begins at `at` reads: a header belongs to the range in which it begins, bases to that in which they lie."""
    if at <= 0 or at >= size:
        return min(max(at, 0), size), True
    back = min(HEADER, at)
    file.seek(at - back)
    before = file.read(back)
    line = before.rfind(b"\n") + 1
    if line == len(before):
        return at, True
    if before[line : line + 1] != b">" or (line == 0 and back < at):
        return at, False
    file.seek(at)
    file.readline()
    return file.tell(), True


def fasta_parts(path: str, start: int, end: int) -> Iterator[tuple[str | None, bytes]]:
    """(name of a header, b"") or (None, bases) in the order of a range; end -1 is the file's."""
    size = os.path.getsize(path)
    if end < 0:
        at, fresh, last = 0, True, None
    else:
        with open(path, "rb") as file:
            (at, fresh), (last, _) = fasta_start(file, start, size), fasta_start(file, end, size)
    with _opened(path, at) as file:
        while (last is None or at < last) and (data := file.read(BLOCK if last is None else min(BLOCK, last - at))):
            at, place = at + len(data), 0
            while place < len(data):
                if fresh and data[place : place + 1] == b">":
                    behind = data.find(b"\n", place) + 1
                    line = data[place + 1 : behind or len(data)]
                    while not line.endswith(b"\n") and (more := file.readline(BLOCK)):
                        line, at = line + more, at + len(more)
                    place = behind or len(data)
                    yield (line.split() or [b""])[0].decode(), b""
                    continue
                # All lines up to the next header at once.
                behind = data.find(b"\n>", place) + 1 or len(data)
                bases = data[place:behind].translate(None, WHITE)
                fresh, place = data[behind - 1 : behind] == b"\n", behind
                if bases:
                    yield None, bases


def fasta_range(path: str, start: int, end: int) -> tuple[int, str | None, int]:
    """(bases before the first header of a range, the name of its last header, bases behind that)."""
    before, name, behind = 0, None, 0
    for header, bases in fasta_parts(path, start, end):
        if header is not None:
            name, behind = header, 0
        elif name is None:
            before += len(bases)
        else:
            behind += len(bases)
    return before, name, behind


class _FastaReader(_Reader):
    def read(self, partition: _Range):
        path, start, end, name, offset = partition.spec
        window = int(self.options["window"])

        def windows() -> Iterator[tuple]:
            chrom, at, held = name, offset, b""
            for header, bases in fasta_parts(path, start, end):
                if header is not None:
                    if held:
                        yield chrom, at, held
                    chrom, at, held = header, 0, b""
                    continue
                if chrom is None:
                    raise ValueError(f"{path}: bases before the first header")
                held, place = held + bases, 0
                while len(held) - place >= (room := window - at % window):
                    yield chrom, at, held[place : place + room]
                    at, place = at + room, place + room
                held = held[place:]
            if held:
                yield chrom, at, held

        yield from _batches(windows(), _schema(FASTA))


class FastaSource(_Source):
    made = _FastaReader

    @classmethod
    def name(cls) -> str:
        return "fasta_windows"

    def schema(self) -> str:
        return FASTA


def read_fasta_windows(spark: SparkSession, *paths: str, window: int = WINDOW, split: int = SPLIT) -> DataFrame:
    """(chrom, offset, seq) of FASTA files: sequences in windows that begin at multiples of `window`, and anew where a range of the file does.

    A name ends at white space; `>` begins a record only at the begin of a line. No row is longer than a window, whatever
    the lines and chromosomes, and a chromosome is read by as many tasks as it has ranges.
    """
    ranges, out = cut(files_of(*paths), split), []
    summary = _counted(spark, [r for r in ranges if r[3] >= 0], fasta_range, "before long, name string, behind long")
    name, offset, last = None, 0, None
    for k, path, start, end in ranges:
        if k != last:
            name, offset, last = None, 0, k
        out.append((path, start, end, name, offset))
        if end >= 0:
            before, header, behind = summary[path, start]
            name, offset = (name, offset + before) if header is None else (header, behind)
    spark.dataSource.register(FastaSource)
    if not out:
        return spark.createDataFrame([], FASTA)
    return spark.read.format("fasta_windows").option("ranges", json.dumps(out)).option("window", str(window)).load()
