"""BAM files: read by ranges of compressed blocks, written by every task, in the columns of SAM text.

A BAM file is a row of gzip blocks of 64 KiB at most, whose sizes stand in their heads, so a reader can begin at any of them. Records go on
over blocks; a range reads those that begin in its blocks. Where the first of them begins is not written anywhere: it is the first
place from which so many bytes as there are make plausible records, one behind another. Files lie on a file system that every executor mounts.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .folder import local
from .ranges import files_of

# Fixed values of the format: the head of a block up to the extra field with its size, the empty block that ends a file,
# the letters of packed bases and of CIGAR operations, the operations that move on the reference, and the numbers' formats.
HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00"
END = HEAD + b"\x1b\x00\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
BASES = "=ACMGRSVTWYHKDBN"
OPERATIONS = "MIDNSHP=X"
ON_REFERENCE = "MDN=X"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}

#: Bytes of a range of a file, uncompressed bytes of a block that is written, and records of an Arrow batch.
SPLIT, BLOCK, BATCH = 32 << 20, 0xFF00, 10_000
#: Records in a row that must be plausible for the first of them to count, or as many as are left.
CHAIN = 8
#: Bytes of whole records that are decoded at once.
TOGETHER = 1 << 21
#: Bytes of a record at most.
LONGEST = 1 << 28
COLUMNS = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>, types map<string,string>, ref_start long, ref_end long"
TEXT = pa.map_(pa.string(), pa.string())
SCHEMA = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}.get(k, TEXT)) for n, k in (c.split(" ", 1) for c in COLUMNS.split(", "))])


def blocks(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the blocks from one that begins at `at`."""
    while at < size:
        file.seek(at)
        head = file.read(18)
        if not (head[:4] == HEAD[:4] and head[12:16] == HEAD[12:16]):
            raise ValueError(f"no block begins at {at}")
        length = int.from_bytes(head[16:18], "little") + 1
        data = file.read(length - 18)
        yield at, zlib.decompress(data[:-8], wbits=-15)
        at += length


def first_block(file, at: int, size: int) -> int:
    """The first block at or behind a byte, or the file's size: a head whose size leads to another head, or to the end."""
    if at <= 0:
        return 0
    while at < size:
        file.seek(at)
        data = file.read(1 << 17)
        for found in re.finditer(re.escape(HEAD[:4]), data):
            place = at + found.start()
            file.seek(place)
            head = file.read(18)
            if len(head) == 18 and head[12:16] == HEAD[12:16]:
                behind = place + int.from_bytes(head[16:18], "little") + 1
                file.seek(behind)
                if behind == size or file.read(4) == HEAD[:4]:
                    return place
        at += len(data) - 3 if len(data) > 3 and at + len(data) < size else len(data)
    return size


@dataclass
class Header:
    text: str
    names: list[str]
    lengths: list[int]
    #: Where records begin: a block's place, and bytes of its content before.
    block: int
    offset: int


def read_header(path: str) -> Header:
    size, data, starts = os.path.getsize(path), b"", []

    def need(n: int) -> None:
        nonlocal data
        while len(data) < n:
            at, content = next(stream)
            starts.append((at, len(data)))
            data += content

    with open(path, "rb") as file:
        stream = blocks(file, 0, size)
        need(8)
        if data[:4] != b"BAM\x01":
            raise ValueError(f"{path} is no BAM file")
        n = struct.unpack_from("<i", data, 4)[0]
        need(12 + n)
        text, at, names, lengths = data[8 : 8 + n].rstrip(b"\0").decode(), 12 + n, [], []
        for _ in range(struct.unpack_from("<i", data, 8 + n)[0]):
            need(at + 4)
            k = struct.unpack_from("<i", data, at)[0]
            need(at + 8 + k)
            names.append(data[at + 4 : at + 3 + k].decode())
            lengths.append(struct.unpack_from("<i", data, at + 4 + k)[0])
            at += 8 + k
    block, before = max((s for s in starts if s[1] <= at), key=lambda s: s[1])
    return Header(text, names, lengths, block, at - before)


def plausible(data: bytes, at: int, references: int) -> int | None:
    """Where the next record begins, if one may begin at `at`, where 36 bytes are; None if it cannot."""
    length, ref, pos, n_name, _, _, n_cigar, _, n_seq, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < references and -1 <= next_ref < references and pos >= -1 and next_pos >= -1 and n_name >= 1 and n_seq >= 0):
        return None
    if not 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq <= length <= LONGEST:
        return None
    name = data[at + 36 : at + 36 + n_name]
    if len(name) == n_name and (name[-1] != 0 or not re.fullmatch(rb"[!-?A-~]*", name[:-1])):
        return None
    return at + 4 + length


def first_record(data: bytes, start: int, references: int, final: bool) -> tuple[int, bool]:
    """(place, True) of the first record at or behind `start`: CHAIN plausible ones begin with it, or all up to the end of the final data.

    Else (place, False): up to there none begins, and at it one may, which only more data can tell.
    """
    at = start
    while at + 36 <= len(data):
        place, k = at, 0
        while place is not None and k < CHAIN and place + 36 <= len(data):
            place, k = plausible(data, place, references), k + 1
        if place is not None and (k == CHAIN or (final and place == len(data))):
            return at, True
        if place is not None and not final:
            return at, False
        at += 1
    return (len(data) if final else at), False


def _tags(data: bytes) -> tuple[dict[str, str], dict[str, str]]:
    values, types, at = {}, {}, 0
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in NUMBERS:
            value = struct.unpack_from("<" + NUMBERS[kind], data, at)[0]
            at += struct.calcsize(NUMBERS[kind])
            text, shown = (f"{value:g}", "f") if kind == "f" else (str(value), "i")
        elif kind == "A":
            text, shown, at = chr(data[at]), "A", at + 1
        elif kind in "ZH":
            end = data.index(0, at)
            text, shown, at = data[at:end].decode(), kind, end + 1
        elif kind == "B":
            sub, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            items = struct.unpack_from(f"<{n}{NUMBERS[sub]}", data, at + 5)
            text, shown = ",".join([sub, *(f"{x:g}" if sub == "f" else str(x) for x in items)]), "B"
            at += 5 + n * struct.calcsize(NUMBERS[sub])
        else:
            raise ValueError(f"tag {name} has the unknown type {kind}")
        values.setdefault(name, text)
        types.setdefault(name, shown)
    return values, types


def decoded(data: bytes, at: int, length: int, names: list[str]) -> tuple:
    """The columns of the record whose body lies at `at`."""
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, next_ref, next_pos, size = struct.unpack_from("<iiBBHHHiiii", data, at)
    place = at + 32
    qname = data[place : place + n_name - 1].decode()
    place += n_name
    steps = struct.unpack_from(f"<{n_cigar}I", data, place)
    place += 4 * n_cigar
    packed = data[place : place + (n_seq + 1) // 2].hex().translate(str.maketrans("0123456789abcdef", BASES))
    place += (n_seq + 1) // 2
    quality = data[place : place + n_seq]
    tags, types = _tags(data[place + n_seq : at + length])
    span = sum(s >> 4 for s in steps if OPERATIONS[s & 15] in ON_REFERENCE)
    name = lambda k: names[k] if k >= 0 else "*"
    return (
        qname, flag, name(ref), pos + 1, mapq, "".join(f"{s >> 4}{OPERATIONS[s & 15]}" for s in steps) or "*",
        "=" if next_ref == ref and ref >= 0 else name(next_ref), next_pos + 1, size, packed[:n_seq] or "*",
        "*" if not n_seq or quality[0] == 255 else bytes(q + 33 for q in quality).decode(), list(tags.items()), list(types.items()), pos, pos + span,
    )


#: The first bytes of a record's body, and with its length before them.
FIXED = np.dtype([("ref", "<i4"), ("pos", "<i4"), ("n_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2"), ("n_seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("size", "<i4")])
WHOLE = np.dtype([("length", "<i4"), *FIXED.descr])
WHOLE_NUMBERS = {k: "<" + {"b": "i1", "B": "u1", "h": "i2", "H": "u2", "i": "i4", "I": "u4"}[v] for k, v in NUMBERS.items() if v != "f"}


def _before(lengths: np.ndarray) -> np.ndarray:
    """0 and the running sums of lengths."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of pieces, one behind another."""
    ends = _before(lengths)
    return np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])


def _strings(letters: np.ndarray, lengths: np.ndarray) -> pa.Array:
    out = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(_before(lengths).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(letters, np.uint8)))
    out.validate(full=True)
    return out


def _tag_columns(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> list[pa.Array] | None:
    """Tags and types of records, a tag of all of them at a time; None if a tag is a float, an array, unknown or repeated."""
    zeros, owners, names, values, kinds, at = np.flatnonzero(data == 0), [], [], [], [], at.copy()
    while len(open_ := np.flatnonzero(at < end)):
        found = data[at[open_] + 2]
        for kind in map(chr, np.unique(found)):
            rows = open_[found == ord(kind)]
            first = at[rows] + 3
            if kind in WHOLE_NUMBERS:
                size = int(WHOLE_NUMBERS[kind][2])
                value = pc.cast(pa.array(data[first[:, None] + np.arange(size)].view(WHOLE_NUMBERS[kind]).ravel().astype(np.int64)), pa.string())
                behind = first + size
            elif kind in "AZH":
                stop = first + 1 if kind == "A" else np.append(zeros, len(data))[np.searchsorted(zeros, first)]
                value, behind = _strings(data[_spread(first, stop - first)], stop - first), stop + (kind != "A")
            else:
                return None
            if (behind > end[rows]).any():
                return None
            owners.append(rows)
            names.append(data[(first - 3)[:, None] + np.arange(2)])
            values.append(value)
            kinds.append(pa.array(["i" if kind in WHOLE_NUMBERS else kind] * len(rows), pa.string()))
            at[rows] = behind
    offsets = np.zeros(len(at) + 1, np.int32)
    if not owners:
        empty = pa.array([], pa.string())
        return [pa.MapArray.from_arrays(pa.array(offsets), empty, empty)] * 2
    owner, name = np.concatenate(owners), np.concatenate(names)
    if len(np.unique(owner << 16 | name[:, 0].astype(np.int64) << 8 | name[:, 1])) < len(owner):
        return None
    order, offsets = np.argsort(owner, kind="stable"), pa.array(_before(np.bincount(owner, minlength=len(at))).astype(np.int32))
    keys = _strings(name[order].ravel(), np.full(len(order), 2))
    return [pa.MapArray.from_arrays(offsets, keys, pa.concat_arrays(x).take(pa.array(order))) for x in (values, kinds)]


def decoded_together(content: bytes, places: list[int], names: list[str]) -> pa.RecordBatch:
    """The columns of records whose bodies lie at places, their lengths before them."""
    data, at = np.frombuffer(content, np.uint8), np.array(places, np.int64)
    length = data[(at - 4)[:, None] + np.arange(4)].view("<i4").ravel().astype(np.int64)
    fixed = data[at[:, None] + np.arange(32)].view(FIXED).ravel()
    n_name, n_cigar, n_seq = (fixed[c].astype(np.int64) for c in ("n_name", "n_cigar", "n_seq"))
    cigar_at, n_packed = at + 32 + n_name, (n_seq + 1) // 2
    seq_at = cigar_at + 4 * n_cigar
    quality_at = seq_at + n_packed
    tags = _tag_columns(data, quality_at + n_seq, at + length)
    if tags is None:
        rows = [decoded(content, a, int(n), names) for a, n in zip(places, length)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)
    steps = data[_spread(cigar_at, 4 * n_cigar)].view("<u4")
    ends, spans = _before(n_cigar), _before(np.where(np.isin(steps & 15, [OPERATIONS.index(o) for o in ON_REFERENCE]), steps >> 4, 0))
    span, known, raw = spans[ends[1:]] - spans[ends[:-1]], {b"": "*"}, steps.tobytes()
    cigars = [raw[a:b] for a, b in zip((4 * ends[:-1]).tolist(), (4 * ends[1:]).tolist())]
    for cigar in set(cigars) - known.keys():
        known[cigar] = "".join(f"{x >> 4}{OPERATIONS[x & 15]}" for x in struct.unpack(f"<{len(cigar) // 4}I", cigar))
    packed = data[_spread(seq_at, n_packed)]
    letters = np.frombuffer(BASES.encode(), np.uint8)[np.stack([packed >> 4, packed & 15], 1)].ravel()
    none, missing = n_seq == 0, data[np.minimum(quality_at, len(data) - 1)] == 255
    n_quality = np.where(missing, 0, n_seq)
    quality = data[_spread(quality_at, n_quality)]
    if (quality > 222).any():
        raise ValueError("a quality is above 222")
    star, ref, next_ref = pa.scalar("*"), fixed["ref"], fixed["next_ref"]
    chroms = pa.array([*names, "*", "="])
    named = lambda k: chroms.take(pa.array(np.where(k < 0, len(names), k)))
    pos = fixed["pos"].astype(np.int64)
    columns = [
        _strings(data[_spread(at + 32, n_name - 1)], n_name - 1), fixed["flag"].astype(np.int32), named(ref), pos + 1, fixed["mapq"].astype(np.int32), pa.array([known[c] for c in cigars], pa.string()),
        named(np.where((next_ref == ref) & (ref >= 0), len(names) + 1, next_ref)), fixed["next_pos"].astype(np.int64) + 1, fixed["size"].astype(np.int64),
        pc.if_else(pa.array(none), star, _strings(letters[_spread(2 * _before(n_packed)[:-1], n_seq)], n_seq)), pc.if_else(pa.array(none | missing), star, _strings(quality + 33, n_quality)), *tags, pos, pos + span,
    ]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, bytes) of strings."""
    column = pa.concat_arrays([column.cast(pa.large_string())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    content = column.buffers()[2]
    return offsets[:-1], np.diff(offsets), np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)


def _tag_pieces(tags: pa.Array, types: pa.Array | None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(record, length, bytes) of tags in order of record and name; None if one is a float, an array, or no tag."""

    def entries(maps: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray] | None:
        ends = maps.offsets.to_numpy()
        names, n = maps.keys.slice(ends[0], ends[-1] - ends[0]), len(maps)
        starts, lengths, letters = _flat(names)
        if (lengths != 2).any():
            return None
        code = np.repeat(np.arange(n), np.diff(ends)) << 16 | letters[starts].astype(np.int64) << 8 | letters[starts + 1]
        return code, maps.items.slice(ends[0], ends[-1] - ends[0]), np.argsort(code, kind="stable")

    own, other = entries(tags), entries(types) if types is not None else None
    if own is None or (types is not None and other is None):
        return None
    code, values, order = own
    code, values, kind = code[order], values.take(pa.array(order)), np.full(len(code), ord("Z"), np.uint8)
    if other is not None and len(other[0]):
        shown, known = other[1].take(pa.array(other[2])), other[0][other[2]]
        starts, lengths, letters = _flat(shown)
        if shown.null_count or (lengths != 1).any():
            return None
        place = np.minimum(np.searchsorted(known, code), len(known) - 1)
        kind = np.where(known[place] == code, letters[starts][place], kind)
    if values.null_count or not np.isin(kind, list(b"iZHA")).all():
        return None
    number, (starts, lengths, letters) = kind == ord("i"), _flat(values)
    try:
        whole = pc.cast(values.filter(pa.array(number)), pa.int64()).to_numpy(zero_copy_only=False)
    except pa.ArrowInvalid:
        return None
    if ((whole < -(1 << 31)) | (whole >= 1 << 32)).any():
        return None
    kind = kind.copy()
    kind[np.flatnonzero(number)[whole >= 1 << 31]] = ord("I")
    size = 3 + np.where(number, 4, lengths + ((kind == ord("Z")) | (kind == ord("H"))))
    at, out = _before(size)[:-1], np.zeros(size.sum(), np.uint8)
    out[at], out[at + 1], out[at + 2] = code >> 8 & 255, code & 255, kind
    out[at[number][:, None] + np.arange(3, 7)] = (whole & 0xFFFFFFFF).astype("<u4").view(np.uint8).reshape(-1, 4)
    text = ~number
    out[_spread(at[text] + 3, lengths[text])] = letters[_spread(starts[text], lengths[text])]
    return code >> 16, size, out


def encoded_together(batch: pa.RecordBatch, places: dict[str, int]) -> bytes:
    """The records of a batch in the format. Those that numpy does not write as `encoded` does, wrong ones among them, are written by that."""
    made = _encoded_plain(batch, places)
    return b"".join(encoded(record, places) for record in batch.to_pylist()) if made is None else made


def _encoded_plain(batch: pa.RecordBatch, places: dict[str, int]) -> bytes | None:
    n, column = batch.num_rows, {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
    types = column.get("types")
    if not n or any(column[c].null_count for c in ("qname", "flag", "rname", "pos", "mapq", "rnext", "pnext", "tlen", "tags")) or (types is not None and types.null_count):
        return None if n else b""
    tags = _tag_pieces(column["tags"], types)
    ranks = {"*": -1} | places
    chroms = [pc.dictionary_encode(column[c]) for c in ("rname", "rnext")]
    if tags is None or any(x not in ranks for x in chroms[0].dictionary.to_pylist()) or any(x not in ranks and x != "=" for x in chroms[1].dictionary.to_pylist()):
        return None
    ref, following = (np.array([ranks.get(x, -2) for x in c.dictionary.to_pylist()], np.int64)[c.indices.to_numpy()] for c in chroms)
    ref, following = ref, np.where(following == -2, ref, following) if "=" not in ranks else following
    cigars = pc.dictionary_encode(pc.fill_null(column["cigar"], ""))
    parsed = [[(int(k), OPERATIONS.index(o)) for k, o in re.findall(r"(\d+)([MIDNSHP=X])", c)] for c in cigars.dictionary.to_pylist()]
    if any(k >= 1 << 28 for c in parsed for k, _ in c):
        return None
    which, steps = cigars.indices.to_numpy(), np.array([k << 4 | o for c in parsed for k, o in c], "<u4").view(np.uint8)
    counts = np.array([len(c) for c in parsed], np.int64)
    n_cigar, cigar_from = counts[which], 4 * _before(counts)[:-1][which]
    span = np.array([sum(k for k, o in c if OPERATIONS[o] in ON_REFERENCE) for c in parsed], np.int64)[which]
    names_at, n_name, names = _flat(column["qname"])
    seqs, qualities = (pc.fill_null(column[c], "*") for c in ("seq", "qual"))
    seq_at, n_seq, letters = _flat(pc.if_else(pc.equal(seqs, "*"), "", seqs))
    bare = pc.equal(qualities, "*").to_numpy(zero_copy_only=False) | (n_seq == 0)
    quality_from, n_quality, marks = _flat(qualities)
    codes = np.full(256, 255, np.uint8)
    for k, base in enumerate(BASES.encode()):
        codes[[base, ord(chr(base).lower())]] = k
    bases = codes[letters[_spread(seq_at, n_seq)]]
    quality = marks[_spread(quality_from[~bare], n_quality[~bare])]
    number = {c: column[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("flag", "pos", "mapq", "pnext", "tlen")}
    pos = number["pos"] - 1
    inside = lambda x, low, high: ((x >= low) & (x < high)).all()
    whole = (-(1 << 31), 1 << 31)
    if (bases == 255).any() or (n_quality != n_seq)[~bare].any() or (quality < 33).any() or (quality > 127).any():
        return None
    if not (inside(pos, *whole) and inside(number["pnext"] - 1, *whole) and inside(number["tlen"], *whole) and inside(number["flag"], 0, 1 << 16) and inside(number["mapq"], 0, 256) and inside(n_name, 0, 255) and inside(n_cigar, 0, 1 << 16)):
        return None
    begin = np.maximum(pos, 0)
    stop, bins = begin + np.maximum(span, 1) - 1, np.zeros(n, np.int64)
    for level, shift in reversed(list(enumerate((14, 17, 20, 23, 26)))):
        bins = np.where(begin >> shift == stop >> shift, ((1 << 3 * (5 - level)) - 1) // 7 + (begin >> shift), bins)
    if (bins >= 1 << 16).any():
        return None
    owner, tag_size, tag_bytes = tags
    n_packed, n_tags = (n_seq + 1) // 2, np.bincount(owner, tag_size, n).astype(np.int64)
    body = 32 + n_name + 1 + 4 * n_cigar + n_packed + n_seq + n_tags
    at = _before(4 + body)
    out, at, fixed = np.zeros(at[-1], np.uint8), at[:-1], np.zeros(n, WHOLE)
    for c, value in {"length": body, "ref": ref, "pos": pos, "n_name": n_name + 1, "mapq": number["mapq"], "bin": bins, "n_cigar": n_cigar, "flag": number["flag"], "n_seq": n_seq, "next_ref": following, "next_pos": number["pnext"] - 1, "size": number["tlen"]}.items():
        fixed[c] = value
    out[at[:, None] + np.arange(36)] = fixed.view(np.uint8).reshape(n, 36)
    out[_spread(at + 36, n_name)] = names[_spread(names_at, n_name)]
    cigar_at = at + 37 + n_name
    out[_spread(cigar_at, 4 * n_cigar)] = steps[_spread(cigar_from, 4 * n_cigar)]
    packed_at, both = cigar_at + 4 * n_cigar, np.zeros(2 * n_packed.sum(), np.uint8)
    both[_spread(2 * _before(n_packed)[:-1], n_seq)] = bases
    out[_spread(packed_at, n_packed)] = both[0::2] << 4 | both[1::2]
    quality_at = packed_at + n_packed
    out[_spread(quality_at[bare], n_seq[bare])] = 255
    out[_spread(quality_at[~bare], n_seq[~bare])] = quality - 33
    out[_spread(quality_at + n_seq, n_tags)] = tag_bytes
    return out.tobytes()


def _tag_bytes(name: str, kind: str, value: str) -> bytes:
    head = name.encode()
    if kind == "A":
        return head + b"A" + value.encode()
    if kind == "i":
        return head + (b"i" + struct.pack("<i", int(value)) if -(1 << 31) <= int(value) < 1 << 31 else b"I" + struct.pack("<I", int(value)))
    if kind == "f":
        return head + b"f" + struct.pack("<f", float(value))
    if kind == "B":
        sub, *items = value.split(",")
        return head + b"B" + sub.encode() + struct.pack("<i", len(items)) + struct.pack(f"<{len(items)}{NUMBERS[sub]}", *[float(x) if sub == "f" else int(x) for x in items])
    if kind in "ZH":
        return head + kind.encode() + value.encode() + b"\0"
    raise ValueError(f"tag {name} has the unknown type {kind}")


def _bin(start: int, end: int) -> int:
    """The bin of an interval in the format's index: the smallest of nested ones that holds it."""
    for level, shift in enumerate((14, 17, 20, 23, 26)):
        if start >> shift == (end - 1) >> shift:
            return ((1 << 3 * (5 - level)) - 1) // 7 + (start >> shift)
    return 0


def encoded(record: dict, places: dict[str, int]) -> bytes:
    """A record in the format, its length before it. Tags are in order of their names, strings where their type is not known."""
    cigar = [(int(n), OPERATIONS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", record["cigar"] or "")]
    seq = "" if record["seq"] in (None, "*") else record["seq"]
    packed = bytes.fromhex((seq.upper() + "=" * (len(seq) % 2)).translate(str.maketrans(BASES, "0123456789abcdef")))
    quality = b"\xff" * len(seq) if record["qual"] in (None, "*") or not seq else bytes(c - 33 for c in record["qual"].encode())
    name = record["qname"].encode() + b"\0"
    ref = places[record["rname"]] if record["rname"] != "*" else -1
    following = ref if record["rnext"] == "=" else places[record["rnext"]] if record["rnext"] != "*" else -1
    pos = record["pos"] - 1
    span = sum(n for n, k in cigar if OPERATIONS[k] in ON_REFERENCE)
    tags, types = dict(record["tags"] or ()), dict(record.get("types") or ())
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), record["mapq"], _bin(max(pos, 0), max(pos, 0) + max(span, 1)), len(cigar), record["flag"], len(seq), following, record["pnext"] - 1, record["tlen"])
    body += name + struct.pack(f"<{len(cigar)}I", *[n << 4 | k for n, k in cigar]) + packed + quality + b"".join(_tag_bytes(t, types.get(t, "Z"), tags[t]) for t in sorted(tags))
    return struct.pack("<i", len(body)) + body


class _Blocks(InputPartition):
    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


class _BamReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.files, self.split = json.loads(options["files"]), int(options["split"])

    def partitions(self) -> list[InputPartition]:
        return [_Blocks(p, a, min(a + self.split, size)) for p in self.files for size in [os.path.getsize(p)] for a in range(0, size, self.split)] or [_Blocks("", 0, 0)]

    def read(self, partition: _Blocks):
        if not partition.path:
            return
        yield from batches_of(partition.path, partition.start, partition.end)


def records_of(path: str, start: int, end: int) -> Iterator[tuple]:
    """The records whose first byte lies in a block that begins in a range of bytes."""
    for batch in batches_of(path, start, end):
        yield from zip(*(c.to_pylist() for c in batch.columns))


def batches_of(path: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
    """The records of records_of, in batches of about TOGETHER bytes."""
    header, size = read_header(path), os.path.getsize(path)
    with open(path, "rb") as file:
        first, last = max(first_block(file, start, size), header.block), first_block(file, end, size)
        if first >= last:
            return
        stream, data, own, at, places = blocks(file, first, size), bytearray(), 0, None, []

        def more() -> bool:
            """Another block behind the data; `own` is how many bytes of the data lie in this range's blocks."""
            nonlocal data, own
            place, content = next(stream, (None, b""))
            if place is None:
                return False
            data += content
            own = len(data) if place < last else own
            return True

        if first == header.block:
            at = header.offset
            more()
        place = 0
        while at is None:
            going = [more() for _ in range(4)][-1]
            place, found = first_record(data, place, len(header.names), not going)
            if found:
                at = place
            elif not going or own <= place < len(data) and own < len(data):
                return
        while True:
            while len(data) < at + 4 and more():
                pass
            if at >= own and (at >= len(data) or own < len(data) or not more()):
                if places:
                    yield decoded_together(bytes(data[:at]), places, header.names)
                return
            if at >= own:
                continue
            length = struct.unpack_from("<i", data, at)[0]
            while len(data) < at + 4 + length:
                if not more():
                    raise ValueError(f"{path} ends within a record")
            places.append(at + 4)
            at += 4 + length
            if at > TOGETHER or len(places) == BATCH:
                yield decoded_together(bytes(data[:at]), places, header.names)
                del data[:at]
                own, at, places = own - at, 0, []


class _BamWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.folder, self.text = local(options["path"]), options.get("header", "")
        found = [dict(f.split(":", 1) for f in line.split("\t")[1:]) for line in self.text.splitlines() if line.startswith("@SQ\t")]
        self.sizes = [(f["SN"], int(f["LN"])) for f in found]

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        os.makedirs(self.folder, exist_ok=True)
        name = f".{uuid.uuid4().hex}.bam"
        places = {n: k for k, (n, _) in enumerate(self.sizes)}
        text = self.text.encode()
        with open(f"{self.folder}/{name}", "wb") as file:
            held = bytearray(b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.sizes)))
            for n, size in self.sizes:
                held += struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size)
            for batch in batches:
                held += encoded_together(batch, places)
                while len(held) >= BLOCK:
                    file.write(block_of(bytes(held[:BLOCK])))
                    del held[:BLOCK]
            if held:
                file.write(block_of(bytes(held)))
            file.write(END)
        return _Part(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of attempts that ended get visible names, in the order of partitions; those of lost ones keep theirs."""
        for k, part in enumerate(messages):
            if part is not None:
                os.rename(f"{self.folder}/{part.name}", f"{self.folder}/part-{k:05d}{part.name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for part in messages:
            if part is not None and os.path.exists(f"{self.folder}/{part.name}"):
                os.remove(f"{self.folder}/{part.name}")


@dataclass
class _Part(WriterCommitMessage):
    name: str


def block_of(content: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = squeeze.compress(content) + squeeze.flush()
    if len(data) > 0xFFFF - 26:
        squeeze = zlib.compressobj(0, zlib.DEFLATED, -15)
        data = squeeze.compress(content) + squeeze.flush()
    return HEAD + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(content), len(content))


class BamSource(DataSource):
    """format("bam"), for read_bam and write_bam."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BamReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _BamWriter(self.options)


def read_bam(spark: SparkSession, *paths: str, split: int = SPLIT) -> DataFrame:
    """Records of BAM files, or folders of them, with the columns of read_sam: tags and types, ref_start, ref_end. A task reads `split` bytes of a file."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("files", json.dumps(files_of(*paths))).option("split", str(split)).load()


def write_bam(records: DataFrame, header: list[str], path: str) -> None:
    """Records (the columns of read_sam; types may be missing) as a folder of BAM files with the header's lines, one for each partition. A chromosome that the header lacks is an error."""
    spark = records.sparkSession
    spark.dataSource.register(BamSource)
    names = [f.name for f in SCHEMA][:12] + ["types"] * ("types" in records.columns)
    records.select(*names).write.format("bam").mode("append").option("header", "".join(f"{line}\n" for line in header)).save(path)


def bam_header(path: str) -> list[str]:
    """The lines of a BAM file's header."""
    return read_header(files_of(path)[0]).text.splitlines()
