"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A document gives whole sequences and a remainder. Remainders fall in reciprocal-capacity classes: class k has lengths above
capacity / (k + 1) and up to capacity / k, and a bin takes k of them. What is then left of the bin is shorter than any
member of the class, so the next one is cut to fill it, and its rest is a remainder of a smaller class: a full bin has no
padding, and a remainder is cut at most where a bin closes. Every task fills the bins of its own documents, with no shuffle.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import portions

#: Characters that every Unicode version and regular expression library classes alike.
PLAIN = re.compile("[\t\n\r\x20-\x7e\u00a1-\u017f\u2010-\u2027\u20ac]*")


class Encoder:
    """Ids of a file of the tokenizers library.

    For a byte-level BPE file the same vocabulary as ranks and its pre-tokenizer's pattern may be given; plain texts without
    special tokens are then coded by tiktoken, which gives the same ids sooner. All others go to the library.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library, self.quick = Tokenizer.from_file(path), None
        with open(path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file).get("added_tokens", [])]
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.quick = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> list[int]:
        if self.quick is not None and PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.quick(text)
        return self.library.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def _encoder(path: str, ranks: str | None, pattern: str | None) -> Encoder:
    return Encoder(path, ranks, pattern)


class Bins:
    """Open bins of one task: one for each class. A piece is (doc_id, start, ids, tokens of its document). Sequence ids carry the task's number, so tasks need not agree."""

    def __init__(self, task: int, capacity: int) -> None:
        self.capacity, self.next = capacity, task << 33
        self.open: dict[int, list[tuple]] = {}

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        """Pieces with their sequence and offset."""
        out, at = [], 0
        for piece in pieces:
            out.append((*piece, self.next, at))
            at += len(piece[2])
        self.next += 1
        return out

    @staticmethod
    def _cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
        doc, start, ids, tokens = piece
        return (doc, start, ids[:at], tokens), (doc, start + at, ids[at:], tokens)

    def put(self, piece: tuple) -> list[tuple]:
        """The pieces of the sequences that a document's ids fill, the remainders held before included."""
        out = []
        while len(piece[2]) >= self.capacity:
            head, piece = self._cut(piece, self.capacity)
            out += self._close([head])
        while len(piece[2]):
            k = self.capacity // len(piece[2])
            held = self.open.setdefault(k, [])
            if len(held) < k:
                held.append(piece)
                if sum(len(p[2]) for p in held) < self.capacity:
                    break
                piece = (None, 0, (), 0)
            else:
                head, piece = self._cut(piece, self.capacity - sum(len(p[2]) for p in held))
                held.append(head)
            self.open[k] = []
            out += self._close(held)
        return out

    def rest(self) -> list[tuple]:
        """What is left in open bins, one after another, in sequences of the capacity and then of smaller powers of two, which need no padding."""
        held = [p for k in sorted(self.open) for p in self.open[k]]
        total, out = sum(len(p[2]) for p in held), []
        while total:
            room = min(self.capacity, 1 << (total.bit_length() - 1))
            total -= room
            pieces = []
            while room:
                piece = held.pop(0)
                if len(piece[2]) > room:
                    piece, later = self._cut(piece, room)
                    held.insert(0, later)
                pieces.append(piece)
                room -= len(piece[2])
            out += self._close(pieces)
        return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, capacity: int = 1024, with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of all documents in sequences: SCHEMA, and with with_ids the token ids of each piece.

    A document has the ids of its text (null: empty) and one id 0 at its end. tokenizer is the path of a file of the
    tokenizers library on the executors; ranks and pattern are its vocabulary and pre-tokenizer, if it is byte-level BPE.
    Offsets of a sequence are gapless from 0. A sequence holds `capacity` ids, a power of two, or, of what is left at the end
    of a task, a smaller power of two: none has padding. Null ids give rows with a null doc_id; repeated rows are packed as often as they occur; an empty
    table gives none. Sequence ids are unique, and the same on each run over the same input partitions.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, bins = _encoder(tokenizer, ranks, pattern), Bins(TaskContext.get().partitionId(), capacity)

        def frame_of(pieces: list[tuple]) -> pd.DataFrame:
            rows = [(doc, start, len(ids), zlib.crc32(part := ids.tobytes()), tokens, at, offset, part) for doc, start, ids, tokens, at, offset in pieces]
            out = pd.DataFrame(rows, columns=[*names, "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out if with_ids else out[names]

        for frame in portions(frames, "text"):
            pieces = []
            for i, text in zip(frame["doc_id"].astype("Int64").tolist(), frame["text"]):
                ids = np.array([*(encoder.ids(text) if isinstance(text, str) else ()), 0], dtype="<u4")
                pieces += bins.put((None if i is pd.NA else i, 0, ids, len(ids)))
            yield frame_of(pieces)
        yield frame_of(bins.rest())

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return slim.mapInPandas(run, SCHEMA + (", ids binary" if with_ids else ""))
