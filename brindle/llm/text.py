"""Words, fingerprints and grouped iteration shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

U64 = np.uint64
#: Spark's regular expression for what separates words: ASCII space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; bytes.split() separates at exactly the six characters of SPACE."""
    return text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []


def hash_words(items: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, items), dtype=U64, count=len(items))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """A fingerprint for each run of n word hashes, in text order; empty if there are fewer."""
    size = len(h) - n + 1
    if size <= 0:
        return np.empty(0, dtype=U64)
    out = np.zeros(size, dtype=U64)
    for i in range(n):
        out = out * U64(0x9E3779B97F4A7C15) + h[i : i + size]
    return mix(out)


def released_memory() -> None:
    """Gives back what a Python worker has freed, since it lives on and its memory counts beside that of others."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of text whose words a task holds at once; a longer text is held alone.
PORTION = 4_000_000


def portions(frames: Iterator[pd.DataFrame], column: str, growth: int = 1) -> Iterator[pd.DataFrame]:
    """The rows of frames in slices of about PORTION bytes of a column, which unpacks to growth times its length."""
    for frame in frames:
        sizes = np.cumsum([growth * len(x) if x is not None else 0 for x in frame[column]])
        part = sizes // PORTION
        cuts = [0, *(np.nonzero(np.diff(part))[0] + 1).tolist(), len(frame)]
        for a, b in zip(cuts, cuts[1:]):
            yield frame.iloc[a:b].reset_index(drop=True)
    released_memory()


@F.pandas_udf(BinaryType())
def squeezed(text: pd.Series) -> pd.Series:
    """Texts as zstd frames, for the way through a shuffle; null stays null."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return pd.Series([pack(t.encode("utf-8", "surrogatepass")) if isinstance(t, str) else None for t in text], dtype=object)


def released(frames: pd.Series) -> list[bytes | None]:
    """The UTF-8 of squeezed texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(z) if z is not None else None for z in frames]


def window_minimum(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of each `span` consecutive values."""
    out, width = values, 1
    while 2 * width <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[: len(out) - (span - width)], out[span - width :]) if width < span else out


def groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Complete groups of a partition that Spark has sorted by keys, joined over the borders of Arrow batches."""
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        values = frame[keys].to_numpy()
        cuts = [0, *(np.nonzero((values[1:] != values[:-1]).any(axis=1))[0] + 1).tolist(), len(frame)]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(values[start])
            if held and key != last:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held = []
            held.append(frame.iloc[start:end])
            last = key
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
    released_memory()


class FirstSeen:
    """For each key of a stream, the first document that had it. Memory follows the distinct keys of the partition, not their repeats."""

    def __init__(self) -> None:
        self.keys = np.empty(0, dtype=U64)
        self.owner = np.empty(0, dtype=np.int64)

    def feed(self, keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, owners and documents of the entries whose key another document had before."""
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        owner = docs[first].copy()
        owner[known] = self.owner[at[known]]
        self.keys = np.insert(self.keys, at[~known], distinct[~known])
        self.owner = np.insert(self.owner, at[~known], owner[~known])
        own = owner[inverse]
        again = own != docs
        return keys[again], own[again], docs[again]


def packed(keys: list[np.ndarray], docs: list[int], buckets: int) -> pd.DataFrame:
    """packed_flat() for an array of keys of each document."""
    key = np.concatenate(keys) if keys else np.empty(0, dtype=U64)
    return packed_flat(key, np.repeat(np.array(docs, dtype=np.int64), [len(k) for k in keys]), buckets)


def packed_flat(key: np.ndarray, doc: np.ndarray, buckets: int) -> pd.DataFrame:
    """Entries (key, document) of a batch as one row for each bucket of keys: bucket, lo (its first document), keys, docs."""
    bucket = (key % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    key, doc, bucket = key[order], doc[order], bucket[order]
    cuts = np.r_[0, np.nonzero(np.diff(bucket))[0] + 1, len(bucket)] if len(bucket) else np.array([0])
    rows = [(int(bucket[a]), int(doc[a]), key[a:b].tobytes(), doc[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    return pd.DataFrame(rows, columns=["bucket", "lo", "keys", "docs"])


PACKED = "bucket long, lo long, keys binary, docs binary"
#: Entries that are looked up at once.
GATHER = 200_000


def unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The entries of packed() rows, sorted by bucket: (bucket, keys, docs) in gatherings of at least GATHER where a bucket has as many."""
    bucket, keys, docs, n = None, [], [], 0
    for frame in frames:
        for b, k, d in zip(frame["bucket"], frame["keys"], frame["docs"]):
            if keys and (b != bucket or n >= GATHER):
                yield bucket, np.concatenate(keys), np.concatenate(docs)
                keys, docs, n = [], [], 0
            bucket = b
            keys.append(np.frombuffer(k, dtype=U64))
            docs.append(np.frombuffer(d, dtype=np.int64))
            n += len(keys[-1])
    if keys:
        yield bucket, np.concatenate(keys), np.concatenate(docs)
    released_memory()
