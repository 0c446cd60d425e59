"""Exact substring de-duplication with suffix automata.

Every window of `length` words belongs to a shard: the smallest hash among its runs of ANCHOR words, so that equal windows
fall in equal shards wherever they are. Only shards whose anchor two documents have are read further; from those come the
pieces of text (maximal runs of windows with one anchor), equal pieces collapsed. In each shard the pieces pass in order of
their first documents: matching statistics against the suffix automaton of the pieces before, then insertion of what is new.
A shard of more than SHARD distinct pieces is split by a second key: its pieces fall into windows, and equal windows meet by name.
A corpus that is its own reference has as many shards as it has data, so pieces are shuffled to their shard; broadcasting
each shard's automaton to every document would make the work grow with the square of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import bounded, materialize, partitions
from .text import PACKED, U64, FirstSeen, hash_words, ngrams, packed_flat, portions, released, squeezed, unpacked, window_minimum, words

#: Words of an anchor, and windows of a piece at most (its marks fit a long).
ANCHOR, PIECE = 4, 40
#: Distinct pieces of a shard that one automaton holds at most, and pieces that share a window in one task.
SHARD = 500


class SuffixAutomaton:
    """Of word sequences added one after another; `first` has the earliest document of each state's substrings."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.first = [-1], [0], [-1]

    def _state(self, edges: dict[bytes, int], link: int, size: int, first: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        self.first.append(first)
        return len(self.size) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        clone = self._state(dict(self.next[q]), self.link[q], self.size[p] + 1, self.first[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[bytes], document: int) -> None:
        """Documents must come in ascending order."""
        last = 0
        for word in sequence:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, word, q)
                continue
            state = self._state({}, 0, self.size[last] + 1, document)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[state] = q if self.size[q] == self.size[p] + 1 else self._split(p, word, q)
            last = state

    def earliest(self, sequence: list[bytes], length: int) -> list[int | None]:
        """For each window of `length` words of the sequence, the first document that has it, from matching statistics."""
        state, matched, out = 0, 0, []
        for i, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.size[state]
            q = self.next[state].get(word)
            state, matched = (q, matched + 1) if q is not None else (0, 0)
            while matched > length and self.size[self.link[state]] >= length:
                state = self.link[state]
                matched = self.size[state]
            if i >= length - 1:
                out.append(self.first[state] if matched >= length else None)
        return out


def anchors(texts: list[list[bytes]], length: int) -> pd.DataFrame:
    """(text, anchor, start, windows) of the runs, of PIECE windows at most, of consecutive windows of a text with one smallest anchor."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    h = ngrams(hash_words([w for t in texts for w in t]), min(ANCHOR, length))
    if len(h) < length - min(ANCHOR, length) + 1:
        return pd.DataFrame({"text": [], "anchor": [], "start": [], "windows": []}, dtype=np.int64)
    least = window_minimum(h, length - min(ANCHOR, length) + 1)
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    start = np.arange(len(least)) - begin[text]
    whole = start + length <= sizes[text]
    least, text, start = least[whole], text[whole], start[whole]
    if not len(least):
        return pd.DataFrame({"text": [], "anchor": [], "start": [], "windows": []}, dtype=np.int64)
    breaks = np.r_[True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])]
    run = np.maximum.accumulate(np.where(breaks, np.arange(len(breaks)), 0))
    at = np.nonzero((np.arange(len(breaks)) - run) % PIECE == 0)[0]
    return pd.DataFrame({"text": text[at], "anchor": least[at].view(np.int64), "start": start[at], "windows": np.diff(np.r_[at, len(least)])})


def _pieces_of(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, piece, doc_id, start, windows, body) for anchors that two documents have; piece is a 128-bit name of body."""
    parts = partitions(docs.sparkSession)
    buckets = 4 * parts

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text"):
            runs = anchors([words(t) for t in frame["text"]], length)[["text", "anchor"]].drop_duplicates()
            yield packed_flat(runs["anchor"].to_numpy(np.int64).view(U64), frame["doc_id"].to_numpy(np.int64)[runs["text"].to_numpy(np.int64)], buckets)

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, bucket, told = FirstSeen(), None, np.empty(0, dtype=U64)
        for b, keys, ids in unpacked(frames):
            if b != bucket:
                seen, bucket, told = FirstSeen(), b, np.empty(0, dtype=U64)
            again, owner, member = seen.feed(keys, ids)
            fresh, at = np.unique(again, return_index=True)
            new = ~np.isin(fresh, told, assume_unique=True)
            told = np.union1d(told, fresh)
            yield pd.DataFrame({"doc_id": np.r_[member, owner[at[new]]], "anchor": np.r_[again, fresh[new]].view(np.int64)})

    posted = docs.mapInPandas(post, PACKED).repartition(parts, "bucket").sortWithinPartitions("bucket", "lo", F.xxhash64("keys"))
    shared = posted.mapInPandas(meet, "doc_id long, anchor long").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "z", growth=3):
            texts = [z.split() for z in released(frame["z"])]
            runs = anchors(texts, length)
            wanted = pd.DataFrame({"text": np.repeat(np.arange(len(texts)), [len(a) for a in frame["anchors"]]), "anchor": np.concatenate(frame["anchors"].tolist())})
            runs = runs.merge(wanted, on=["text", "anchor"])
            bodies = [b" ".join(texts[t][at : at + n + length - 1]) for t, at, n in zip(runs["text"].tolist(), runs["start"].tolist(), runs["windows"].tolist())]
            runs["body"], runs["piece"] = bodies, [xxhash.xxh3_128_digest(b) for b in bodies]
            runs["doc_id"] = frame["doc_id"].to_numpy(np.int64)[runs["text"].to_numpy(np.int64)]
            # A piece's body goes on once from each batch, with the batch's first document.
            runs = runs.sort_values("doc_id", kind="stable")
            runs.loc[runs.duplicated(["anchor", "piece"]), "body"] = None
            yield runs[["anchor", "piece", "doc_id", "start", "windows", "body"]]

    texts = docs.where("text IS NOT NULL").select("doc_id", squeezed("text").alias("z"))
    return texts.join(shared, "doc_id").mapInPandas(cut, "anchor long, piece binary, doc_id long, start int, windows int, body binary")


def _judge(pieces: list[tuple[bytes, list[bytes], int]], length: int) -> list[tuple[bytes, int, int]]:
    """(piece, first, mask) of a shard's distinct pieces (piece, words, first document), in order of their first documents."""
    reference, out = SuffixAutomaton(), []
    for k, (piece, sequence, first) in enumerate(pieces):
        found = reference.earliest(sequence, length) if k else [None] * (len(sequence) - length + 1)
        out.append((piece, first, sum(1 << i for i, f in enumerate(found) if f is not None and f < first)))
        if None in found and k + 1 < len(pieces):
            low, high = found.index(None), len(found) - found[::-1].index(None)
            reference.add(sequence[low : high + length - 1], first)
    return out


def large_shards(bodies: DataFrame) -> DataFrame:
    """The anchors of more than SHARD distinct pieces, of bodies (anchor, piece); each piece is there at least once."""
    # Most anchors have too few rows, which the anchors alone tell.
    likely = materialize(bodies.groupBy("anchor").count().where(F.col("count") > SHARD).select("anchor"), "likely")
    distinct = bodies.join(bounded(likely), "anchor", "left_semi").select("anchor", "piece").distinct()
    return distinct.groupBy("anchor").count().where(F.col("count") > SHARD).select("anchor")


def _judge_windows(bodies: DataFrame, length: int) -> DataFrame:
    """What _judge() finds, of bodies (doc_id, piece, body) of any number: each window by its 128-bit name, and the smallest id that has it."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for piece, doc, body in zip(frame["piece"], frame["doc_id"].tolist(), frame["body"]):
                items = body.split()
                rows += [(piece, doc, i, xxhash.xxh3_128_digest(b" ".join(items[i : i + length]))) for i in range(len(items) - length + 1)]
            yield pd.DataFrame(rows, columns=["piece", "doc_id", "at", "window"])

    windows = materialize(bodies.select("piece", "doc_id", "body").mapInPandas(cut, "piece binary, doc_id long, at int, window binary"), "windows")
    firsts = windows.groupBy("window").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    firsts = materialize(firsts, "firsts")
    # A window that many pieces have would be one task of a join; as long as such windows are few, they go to the pieces.
    common = bounded(firsts.where(F.col("n") > SHARD).select("window", "least"))
    rest = windows.join(common, "window", "left_anti").join(firsts.where(F.col("n") <= SHARD).select("window", "least"), "window", "left")
    again = F.when(F.col("least") < F.col("doc_id"), F.expr("shiftleft(1L, at)")).otherwise(F.lit(0).cast("long"))
    masks = windows.join(common, "window").unionByName(rest).groupBy("piece", "doc_id").agg(F.bit_or(again).alias("mask"))
    return masks.groupBy("piece").agg(F.min(F.struct("doc_id", "mask")).alias("m")).select("piece", F.col("m.doc_id").alias("first"), "m.mask")


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, starts, masks) of documents (doc_id, text): bit i of a mask tells that the window at start + i also starts in one of smaller id."""
    parts = partitions(docs.sparkSession)
    pieces = materialize(_pieces_of(docs, length), "pieces")

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, shard_pieces, seen, out = None, [], set(), []
        for frame in frames:
            for anchor, piece, first, body in zip(frame["anchor"].tolist(), frame["piece"], frame["doc_id"].tolist(), frame["body"]):
                if anchor != shard:
                    out += _judge(shard_pieces, length)
                    shard, shard_pieces, seen = anchor, [], set()
                if piece not in seen:
                    seen.add(piece)
                    shard_pieces.append((piece, body.split(), first))
            yield pd.DataFrame(out, columns=["piece", "first", "mask"])
            out = []
        yield pd.DataFrame(_judge(shard_pieces, length), columns=["piece", "first", "mask"])

    bodies = pieces.where("body IS NOT NULL").select("anchor", "doc_id", "piece", "body")
    large = materialize(large_shards(bodies), "large")
    hot = bounded(large)
    small = bodies.join(hot, "anchor", "left_anti")
    judged = small.repartition(parts, "anchor").sortWithinPartitions("anchor", "doc_id", "piece").mapInPandas(stream, "piece binary, first long, mask long")
    if large.limit(1).count():
        judged = judged.unionByName(_judge_windows(bodies.join(hot, "anchor", "left_semi"), length))
    judged = materialize(judged, "judged")
    full = F.expr("shiftleft(1L, windows) - 1L")
    hits = pieces.select("piece", "doc_id", "start", "windows").join(judged, "piece").withColumn("mask", F.when(F.col("doc_id") > F.col("first"), full).otherwise(F.col("mask"))).where("mask <> 0")
    return hits.groupBy("doc_id").agg(F.collect_set(F.struct("start", "mask")).alias("hits")).select("doc_id", F.col("hits.start").alias("starts"), F.col("hits.mask").alias("masks"))


def kept_words(n: int, starts: np.ndarray | None, masks: np.ndarray | None, length: int) -> np.ndarray:
    """Which of n words stay when the marked windows are removed."""
    edge = np.zeros(n + 1, dtype=np.int64)
    if starts is not None:
        window = (np.asarray(starts)[:, None] + np.arange(PIECE))[(np.asarray(masks)[:, None] >> np.arange(PIECE)) & 1 == 1]
        window = window[window + length <= n]
        np.add.at(edge, window, 1)
        np.add.at(edge, window + length, -1)
    return np.cumsum(edge[:-1]) == 0


def substring_dedup(docs: DataFrame, length: int = 13, digest: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with its text cut to the words that stay, and n_words and n_removed (long).

    A window is `length` (at least 2) consecutive words of one text. A word goes if a window that covers
    it also starts in a row of smaller id. Windows are judged on the whole input. Where words go, the rest are joined by
    one space; texts that lose nothing stay as they are, and null stays null.

    Rows without an id, which have no place in the order, are left out. Rows that repeat an id count as one document;
    they must have one text. Empty tables and texts give empty results. Other columns pass through; n_words and n_removed
    replace columns of those names. digest: with kept_sha256, of the kept words joined by one space, and an empty text.
    """
    if length < 2:
        raise ValueError("length must be at least 2")
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("doc_id IS NOT NULL")
    starts = repeated_windows(slim, length)
    own = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_sha256")]
    columns = [(squeezed(F.col(text_column).cast("string")) if c == text_column else F.col(c)).alias(f"c{k}") for k, c in enumerate(own)]
    wide = docs.select(*columns, F.col(id_column).cast("long").alias("doc_id")).where("doc_id IS NOT NULL")

    @F.pandas_udf("text string, n_words long, n_removed long, kept_sha256 string")
    def cut(frames: pd.Series, starts: pd.Series, masks: pd.Series) -> pd.DataFrame:
        rows = []
        unpack = zstandard.ZstdDecompressor().decompress
        for z, s, m in zip(frames, starts, masks):
            t = unpack(z) if z is not None else None
            items = t.split() if t is not None else []
            stay = kept_words(len(items), s, m, length)
            kept = b" ".join([w for w, k in zip(items, stay.tolist()) if k])
            name = hashlib.sha256(kept).hexdigest() if digest else None
            text = "" if digest else None if t is None else (t if stay.all() else kept).decode("utf-8", "surrogatepass")
            rows.append((text, len(items), int(len(items) - stay.sum()), name))
        return pd.DataFrame(rows, columns=["text", "n_words", "n_removed", "kept_sha256"])

    at = own.index(text_column)
    out = wide.join(starts, "doc_id", "left").withColumn("cut", cut(f"c{at}", "starts", "masks"))
    return out.select(*[F.col("cut.text" if k == at else f"c{k}").alias(c) for k, c in enumerate(own)], F.col("cut.n_words").alias("n_words"), F.col("cut.n_removed").alias("n_removed"), *([F.col("cut.kept_sha256").alias("kept_sha256")] if digest else []))
