"""WARC archives: written with revisit records, indexed by an external merge, and read back through the index.

Each task writes archives of its own and, for each, a run of index entries sorted by URL key and time. Runs are cut at common
borders, taken from regular samples of all runs; a task for each range merges the k slices of its range with a loser tree. The
ranges in turn are one order of all captures, in which those of one URL are its history. Records are read back by the offsets of
that index, in parts of a file, so that several tasks may read one archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import time
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import materialize, partitions, shared_folder
from .text import portions

#: Payloads of fewer bytes are always written whole.
LEAST = 1_000
#: Parts into which rows of one digest are dealt, so that no task has all copies of a page.
SALTS = 256
#: Records and bytes after which an archive is closed. Its run of index entries has no more entries.
RECORDS, ROTATE = 50_000, 1 << 30
#: Keys of a run that are sampled for the borders of ranges, and how many of all these reach the driver at most.
REGULAR, SAMPLE = 32, 20_000
#: Bytes of an archive that one task reads back in a row, and that are read at once.
PART, BLOCK = 64 << 20, 4 << 20

ENTRY = "urlkey string, timestamp string, page long, file string, offset long, length long, kind string"
NAMES = [c.split()[0] for c in ENTRY.split(", ")]
RECORD = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, html binary"


def url_key(url: Column) -> Column:
    """A URL as a sortable key: its host's labels from last to first, then path and query, without scheme, user, port, leading www and fragment, in lower case; other strings as they are, null as empty."""
    host = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), r"^[wW]{3}\.", "")
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", ""), r"(?s)#.*$", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))
    return F.coalesce(F.lower(F.when(host == "", url).otherwise(key)), F.lit(""))


def with_originals(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (page_id, html ...) with payload_bytes, payload_digest and refers_to, the largest page_id with the same payload; null where that is their own, the payload is short, or there is no id.

    The largest id of a digest is found by parts (SALTS) and then over them, and goes back to each part, so copies of one page are
    dealt out over many tasks.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    digested = pages.withColumn("payload_bytes", F.octet_length(html).cast("long")).withColumn("payload_digest", F.sha1(html))
    digested = digested.withColumn("_part", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    parts = digested.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull()).groupBy("payload_digest", "_part").agg(F.max("page_id").alias("m"), F.min("page_id").alias("l"))
    whole = parts.groupBy("payload_digest").agg(F.max("m").alias("_original"), F.min("l").alias("l")).where("_original > l")
    back = parts.select("payload_digest", "_part").join(whole.drop("l"), "payload_digest")
    # Null ids have no part of their own digest, or meet one of it and are spared by the comparison.
    out = digested.join(back, ["payload_digest", "_part"], "left")
    return out.withColumn("refers_to", F.when((F.col("page_id") < F.col("_original")) & (F.col("payload_bytes") >= least), F.col("_original"))).drop("_part", "_original")


def _record_id(page_id: str | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _header(fields: Iterable[tuple[str, str | None]]) -> bytes:
    clean = lambda v: re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", v)
    return "".join(f"{k}: {clean(v) if k == 'WARC-Target-URI' else v}\r\n" for k, v in fields if v is not None).encode("utf-8", "surrogatepass")


def record_bytes(page_id: str | None, url: str | None, html: bytes, size: int, digest: str, seconds: int, refers_to: str | None) -> bytes:
    """A response record, or with refers_to a revisit record, which has the head of the HTTP response only. Both name the size and digest of the whole payload."""
    head = b"HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))]) + b"\r\n"
    block = head if refers_to is not None else head + html
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Target-URI", url),
        ("WARC-Date", time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(seconds))), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to is not None else None),
        ("WARC-Refers-To", _record_id(refers_to) if refers_to is not None else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + _header(fields) + b"\r\n" + block + b"\r\n\r\n"


def _file_system(folder: str):
    from pyarrow import fs

    if "://" in folder and not folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), re.sub("^file:(//)?(?=/)", "", folder)


class Archive:
    """A file of gzip members, one for each record, behind one that describes the file. `entries` are the records' places."""

    def __init__(self, folder: str) -> None:
        system, path = _file_system(folder)
        self.name = f"{uuid.uuid4().hex}.warc.gz"
        system.create_dir(path, recursive=True)
        self.file = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.at, self.entries = 0, []
        about = b"software: brindle\r\nformat: WARC File Format 1.1\r\n"
        self.put(b"WARC/1.1\r\n" + _header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(about)))]) + b"\r\n" + about + b"\r\n\r\n")

    def put(self, record: bytes) -> tuple[int, int]:
        member = gzip.compress(record, compresslevel=4, mtime=0)
        self.file.write(member)
        self.at += len(member)
        return self.at - len(member), len(member)

    def close(self) -> dict:
        """The run of this archive's index entries, sorted."""
        self.file.close()
        self.entries.sort()
        n = len(self.entries)
        sample = [{"urlkey": e[0], "timestamp": e[1], "page": e[2]} for e in self.entries[n // (2 * REGULAR) :: max(1, n // REGULAR)]]
        return {"run": self.name, "n": n, "sample": sample, "entries": _pack(self.entries)}


SCHEMA = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in (c.split() for c in ENTRY.split(", "))])
RUN = "run string, n long, sample array<struct<urlkey:string,timestamp:string,page:long>>, entries binary"


def _pack(entries: list[tuple]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, SCHEMA) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*entries) if entries else [[]] * len(NAMES), SCHEMA)], schema=SCHEMA))
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> Iterator[tuple]:
    table = pa.ipc.open_stream(data).read_all()
    return zip(*(c.to_pylist() for c in table.columns))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Archives of records (page_id, url, html, seconds, payload_bytes, payload_digest, refers_to) in a folder; returns their index runs (RUN), which name the archives that belong to the result.

    A task that is run again writes archives of other names; those of the lost attempt are in no run and are never read.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = None
        for frame in portions(frames, "html"):
            for r in frame.itertuples(index=False):
                archive = archive or Archive(folder)
                html = b"" if r.html is None else r.html.encode("utf-8", "surrogatepass")
                at, length = archive.put(record_bytes(r.page_id, r.url, html, r.payload_bytes, r.payload_digest, r.seconds, r.refers_to))
                stamp = time.strftime("%Y%m%d%H%M%S", time.gmtime(r.seconds))
                archive.entries.append((r.urlkey, stamp, -1 if r.page_id is None else int(r.page_id), archive.name, at, length, "revisit" if r.refers_to is not None else "response"))
                if len(archive.entries) >= RECORDS or archive.at >= ROTATE:
                    yield pd.DataFrame([archive.close()])
                    archive = None
        if archive is not None:
            yield pd.DataFrame([archive.close()])

    text = lambda c: F.col(c).cast("string").alias(c)
    whole = F.when(F.col("refers_to").isNull(), F.col("html")).alias("html")
    slim = records.select(text("page_id"), "url", whole, F.coalesce(F.col("seconds").cast("long"), F.lit(0)).alias("seconds"), "payload_bytes", "payload_digest", text("refers_to"), url_key(F.col("url")).alias("urlkey"))
    return slim.mapInPandas(run, RUN)


class LoserTree:
    """The merge of sorted iterators: inner nodes hold the losers of their matches, so the next head plays only those on its way up."""

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs, k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [0] * k
        won = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            one, two = won[2 * node], won[2 * node + 1]
            won[node], self.losers[node] = (one, two) if self._first(one, two) else (two, one)
        self.winner = won[1] if k > 1 else 0

    def _first(self, one: int, two: int) -> bool:
        a, b = self.heads[one], self.heads[two]
        return b is None or (a is not None and a <= b)

    def __iter__(self) -> Iterator[tuple]:
        k, w = len(self.runs), self.winner
        while k and self.heads[w] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            node = (w + k) >> 1
            while node:
                if not self._first(w, self.losers[node]):
                    w, self.losers[node] = self.losers[node], w
                node >>= 1
        self.winner = w


INDEX = "part int, at long, seen long, " + ENTRY


def merged_index(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """All entries of sorted runs in ranges of their keys: (part, at, seen) and ENTRY, all of a part before those of the next; `at` numbers the entries of a part in order, `seen` the captures of a URL within it, both from 0.

    The borders are keys (URL key, time, page), so a URL of very many captures is dealt out over ranges too. A task holds one
    range at a time, which has about as many entries as the others.
    """
    spark = runs.sparkSession
    ranges = ranges or partitions(spark)
    keys = runs.select(F.inline("sample")).orderBy(F.xxhash64("urlkey", "timestamp", "page")).limit(SAMPLE).collect()
    keys = sorted({tuple(r) for r in keys})
    borders = sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["run"], frame["entries"]):
                entries = list(_unpack(data))
                ends = [bisect_right(entries, b, key=lambda e: e[:3]) for b in borders]
                cuts = [0, *ends, len(entries)]
                rows = [(k, name, _pack(entries[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                yield pd.DataFrame(rows, columns=["part", "run", "entries"])

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = None, []
        for frame in frames:
            for k, data in zip(frame["part"], frame["entries"]):
                if held and k != part:
                    yield from _merged(part, held)
                    held = []
                part = k
                held.append(data)
        if held:
            yield from _merged(part, held)

    slices = runs.select("run", "entries").mapInPandas(cut, "part int, run string, entries binary")
    return slices.repartition(ranges, "part").sortWithinPartitions("part", "run").mapInPandas(merge, INDEX)


def _merged(part: int, slices: list[bytes]) -> Iterator[pd.DataFrame]:
    names, out, url, seen = ["part", "at", "seen", *NAMES], [], None, 0
    for at, entry in enumerate(LoserTree([_unpack(s) for s in slices])):
        seen, url = (seen + 1 if entry[0] == url else 0), entry[0]
        out.append((part, at, seen, *entry))
        if len(out) == 10_000:
            yield pd.DataFrame(out, columns=names)
            out = []
    yield pd.DataFrame(out, columns=names)


def histories(index: DataFrame) -> DataFrame:
    """A merged index with position (a capture's place in the order of all, from 0) and capture (its place in its URL's history).

    Only each part's size and its first and last URL go beyond the part: two rows for each of the ranges.
    """
    bounds = index.groupBy("part").agg(F.count("*").alias("n"), F.min("urlkey").alias("low"), F.max("urlkey").alias("high"))
    before = lambda *by: Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = bounds.withColumn("base", F.coalesce(F.sum("n").over(before()), F.lit(0)))
    edges = index.join(F.broadcast(bounds.select("part", "low", "high")), "part").where("urlkey = low OR urlkey = high").groupBy("part", "urlkey").agg(F.count("*").alias("n"))
    earlier = edges.select("part", "urlkey", F.coalesce(F.sum("n").over(before("urlkey")), F.lit(0)).alias("earlier"))
    out = index.join(F.broadcast(base.select("part", "base")), "part").join(F.broadcast(earlier), ["part", "urlkey"], "left")
    return out.select((F.col("base") + F.col("at")).alias("position"), (F.col("seen") + F.coalesce("earlier", F.lit(0))).alias("capture"), *NAMES)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields (in lower case) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is not as long as it says")
    return fields, rest[:size]


def _page_of(uri: str | None) -> str | None:
    return uri.removeprefix("<urn:page:").removesuffix(">") if uri and uri.startswith("<urn:page:") else None


def record_row(raw: bytes) -> tuple | None:
    """A RECORD of a response or revisit record, else None. A payload that is not what its digest and size say is an error."""
    fields, block = parse_record(raw)
    if fields["warc-type"] not in ("response", "revisit"):
        return None
    head, _, html = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", head)[1])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    whole = fields["warc-type"] == "response"
    if whole and (len(html) != size or hashlib.sha1(html).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    return _page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, fields["warc-type"], _page_of(fields.get("warc-refers-to")), html if whole else None


class _Source:
    """Bytes of an archive by offset, read ahead in blocks."""

    def __init__(self, folder: str, name: str) -> None:
        system, path = _file_system(folder)
        self.file, self.start, self.data = system.open_input_file(f"{path}/{name}"), 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.start <= at and at + n <= self.start + len(self.data)):
            self.file.seek(at)
            self.start, self.data = at, self.file.read(max(n, BLOCK))
        return self.data[at - self.start : at - self.start + n]


def read_indexed(index: DataFrame, folder: str, payloads: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records (RECORD, html null unless payloads) of an index (file, offset, length ...), with its columns `keep`. Parts of PART bytes of a file are read by one task, in order."""
    kept = index.select("file", "offset", "length", *keep)
    types = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, source = None, None
        for frame in frames:
            rows, size = [], 0
            for r in frame.itertuples(index=False):
                if r.file != name:
                    name, source = r.file, _Source(folder, r.file)
                *values, html = record_row(zlib.decompress(source.get(r.offset, r.length), wbits=31))
                rows.append((*values, html if payloads else None, *r[3:]))
                size += len(html or b"") * payloads
                if size > 8_000_000:
                    yield pd.DataFrame(rows, columns=[*names, *keep])
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=[*names, *keep])

    parts = kept.repartition("file", F.expr(f"offset div {PART}")).sortWithinPartitions("file", "offset")
    return parts.mapInPandas(run, ", ".join([RECORD, *(f"`{c}` {types[c]}" for c in keep)]))


def scan_archives(spark, folder: str) -> DataFrame:
    """The records (RECORD) of all archives of a folder without an index: each file streams through one task, member by member."""
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                system, where = _file_system(folder)
                with system.open_input_stream(f"{where}/{path.rsplit('/', 1)[1]}", compression=None) as file:
                    inflate, record = zlib.decompressobj(31), b""
                    while data := file.read(BLOCK):
                        while data:
                            record += inflate.decompress(data)
                            data = inflate.unused_data
                            if inflate.eof:
                                row = record_row(record)
                                if row is not None:
                                    yield pd.DataFrame([row], columns=names)
                                inflate, record = zlib.decompressobj(31), b""

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path")
    return files.repartition(partitions(spark)).mapInPandas(run, RECORD)


def cdx_lines(index: DataFrame) -> DataFrame:
    """(value): lines of an index file, in the order of histories()."""
    return index.orderBy("position").select(F.concat_ws(" ", "urlkey", "timestamp", "kind", F.col("length").cast("string"), F.col("offset").cast("string"), "file").alias("value"))


def archive_report(pages: DataFrame, folder: str | None = None, seconds: Column | None = None) -> DataFrame:
    """Writes all pages (page_id, url, html) as archives, merges their index, reads them back: page_id, url, payload_bytes, payload_digest, record_type, refers_to, urlkey, capture, position.

    `seconds` is the time of a capture, by default that of its id in seconds from 2020 on. A null html is empty. Of equal payloads
    of at least LEAST bytes that of the largest page_id is a response (also if the id repeats), others are revisits that refer to it.
    Rows without an id are responses with a null page_id, to which nothing refers. Repeated rows give a record each.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
    if seconds is None:
        seconds = F.lit(1_577_836_800) + F.pmod(F.col("page_id"), F.lit(1_000_000_000))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), seconds.cast("long").alias("seconds"))
    runs = materialize(write_archives(with_originals(slim), folder), "runs")
    index = materialize(merged_index(runs), "index")
    back = read_indexed(histories(index), folder, keep=("urlkey", "capture", "position"))
    return back.select(F.col("page_id").cast("long").alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"), "urlkey", "capture", "position")
