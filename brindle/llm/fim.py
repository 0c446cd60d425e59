"""Fill-in-the-middle transformation by secondary sort.

A document is cut in prefix, middle and suffix, and each of these in chunks. Chunks are keyed by document and by their
position in the output; one shuffle brings a document's chunks together and sorts them within the partition, so the output
streams by, chunk after chunk, into a digest that takes it bit by bit. The same stream tells the place that each chunk has in the
original; a second sort within the partition, with no shuffle, restores the text. No task holds a document as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import portions

#: What stands before prefix, suffix and middle in an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The place of a part in the original text.
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
#: The order of the parts in an output.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE), "plain": ("",)}
#: Code points of a chunk.
CHUNK = 8_192

#: Ids travel as decimal text, so that nulls beside them turn none into a float.
PIECES = "doc_id string, digest binary, form string, at long, text string"
PLACED = "doc_id string, digest binary, form string, place long, text string, copies long"
REPORT = "doc_id string, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def draw(doc_id: str | None, text: str, seed: int, plain_from: int, spm_below: int) -> tuple[str, int, int]:
    """(form, end of the prefix, end of the middle) of a document, from the hash of seed and id; without an id it stays plain."""
    n = len(text)
    if doc_id is None or not text or any(mark in text for mark in PLACE):
        return "plain", 0, 0
    code = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    one, two, plain, kind = (int(code[k : k + 8], 16) for k in (0, 8, 16, 24))
    if plain % 100 >= plain_from:
        return "plain", 0, 0
    return "spm" if kind % 100 < spm_below else "psm", *sorted((one % (n + 1), two % (n + 1)))


def _cut(doc_id: str | None, text: str, chunk: int, *how: int) -> Iterator[tuple]:
    """The chunks of a document's output; the mark of a part stands at the head of its first chunk."""
    form, a, b = draw(doc_id, text, *how)
    ends = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text)), "": (0, len(text))}
    digest, at = hashlib.md5(text.encode("utf-8", "surrogatepass")).digest(), 0
    for mark in FORMS[form]:
        start, end = ends[mark]
        for k in range(start, max(end, start + 1), chunk):
            part = (mark if k == start else "") + text[k : min(k + chunk, end)]
            yield doc_id, digest, form, at, part
            at += len(part)


def fim_pieces(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, chunk: int = CHUNK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The outputs of all documents as chunks (PIECES), each document's in one partition and in the order of `at`, its code points before.

    A null text is empty. A text that is empty or holds a mark stays as it is (plain), as do those without an id and those that
    the hash of their id leaves out. Rows that repeat id and text give each chunk as often as they occur; rows of one id with
    different texts are documents of their own.
    """
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text"):
            rows = [row for i, t in zip(frame["doc_id"], frame["text"]) for row in _cut(i, t if isinstance(t, str) else "", chunk, seed, plain_from, spm_below)]
            yield pd.DataFrame(rows, columns=names)

    slim = docs.select(F.col(id_column).cast("long").cast("string").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return slim.mapInPandas(run, PIECES).repartition("doc_id", "digest").sortWithinPartitions("doc_id", "digest", "at")


def _documents(frames: Iterator[pd.DataFrame], place: str) -> Iterator[tuple[tuple, bool, tuple, int]]:
    """The rows of a sorted stream as (key, whether a document begins, row, copies); equal rows of a repeated document come once."""
    key = row = None
    copies, fresh = 0, False
    for frame in frames:
        for new in frame.itertuples(index=False):
            now = (new.doc_id, new.digest)
            if row is not None and now == key and getattr(new, place) == getattr(row, place):
                copies += 1
                continue
            if row is not None:
                yield key, fresh, row, copies
            fresh, key, row, copies = now != key, now, new, 1
    if row is not None:
        yield key, fresh, row, copies


def _placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of outputs with their place in the original, and behind each document's a row with the digest of its output."""
    columns = [c.split()[0] for c in PLACED.split(", ")]
    out: list[tuple] = []
    size, state, last, times = 0, None, None, 0

    def end() -> None:
        out.append((*last, len(PLACE) << 40, state.hexdigest(), times))

    for key, fresh, row, copies in _documents(frames, "at"):
        if fresh:
            if state is not None:
                end()
            state, part, k, times = hashlib.sha256(), 0, 0, copies
        last, text = (*key, row.form), row.text
        state.update(text.encode("utf-8", "surrogatepass"))
        if row.form != "plain" and text[:3] in PLACE:
            part, k, text = PLACE[text[:3]], 0, text[3:]
        out.append((*last, (part << 40) + k, text, 1))
        k, size = k + 1, size + len(text)
        if size > 4_000_000 or len(out) >= 10_000:
            yield pd.DataFrame(out, columns=columns)
            out, size = [], 0
    if state is not None:
        end()
    yield pd.DataFrame(out, columns=columns)


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of REPORT, from chunks in the order of the original."""
    columns = [c.split()[0] for c in REPORT.split(", ")]
    out: list[tuple] = []
    state, sizes = None, [0, 0, 0]
    for (doc_id, _), fresh, row, _ in _documents(frames, "place"):
        if fresh:
            state, sizes = hashlib.sha256(), [0, 0, 0]
        part = row.place >> 40
        if part < len(PLACE):
            state.update(row.text.encode("utf-8", "surrogatepass"))
            sizes[part] += len(row.text)
            continue
        cut = (None, None) if row.form == "plain" else (sizes[0], sizes[1])
        out += [(doc_id, sum(sizes), row.form, *cut, row.text, state.hexdigest())] * row.copies
        if len(out) >= 10_000:
            yield _report(out, columns)
            out = []
    yield _report(out, columns)


def _report(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    for c in ("prefix_chars", "middle_chars"):
        out[c] = out[c].astype("Int64")
    return out


def restored_pieces(pieces: DataFrame) -> DataFrame:
    """Chunks of outputs, as fim_pieces gives them, in the order of the original: (doc_id, digest, form, place, text, copies).

    What an output's parts are is read from its marks. The last row of a document holds the SHA-256 of its output and how many
    rows had it. Partitions stay as they are, so this sorts again but shuffles nothing.
    """
    return pieces.mapInPandas(_placed, PLACED).sortWithinPartitions("doc_id", "digest", "place")


def fim_report(docs: DataFrame, **how) -> DataFrame:
    """One row (REPORT) for each document: its form, the sizes of its parts (null where plain), and digests of its output and of the text restored from it."""
    return restored_pieces(fim_pieces(docs, **how)).mapInPandas(_digests, REPORT).withColumn("doc_id", F.col("doc_id").cast("long"))


def fim_texts(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, form, output) of all documents: the outputs as whole texts, put together from their chunks as these stream by."""
    columns = ["doc_id", "form", "output"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, last, times = [], None, 0
        for (doc_id, _), fresh, row, copies in _documents(frames, "at"):
            if fresh:
                if last is not None:
                    yield pd.DataFrame([(*last, "".join(parts))] * times, columns=columns)
                parts, last, times = [], (doc_id, row.form), copies
            parts.append(row.text)
        if last is not None:
            yield pd.DataFrame([(*last, "".join(parts))] * times, columns=columns)

    return fim_pieces(docs, **how).mapInPandas(run, "doc_id string, form string, output string").withColumn("doc_id", F.col("doc_id").cast("long"))
