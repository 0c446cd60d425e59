"""Alignment of two tokenizers over the same texts, and how often their tokens go together in the corpus.

Both token sequences cover the same bytes, so each is a rising array of end offsets, and tokens correspond where ends are equal.
Along a stretch of one-to-one tokens the shift between the two arrays' indexes does not change: it is jumped by comparing ever
longer runs of ends at the present shift. Where a run differs, one irregular group is resolved end by end and the shift updated.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .packing import PLAIN
from .storage import materialize
from .text import portions

#: A single space between other characters: no token of either kind goes on behind the character before such a space.
BREAK = re.compile(r"(?<=\S) (?=\S)")
#: Code points after which a text is cut at its next BREAK, so that no more is aligned at once.
SEGMENT = 1 << 18
#: Pairs whose counts go to every task at most: those of the highest counts. The others are joined.
FREQUENT = 1 << 18
#: Entries that are counted at once.
GATHER = 1 << 21


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable bytes are their own, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    letters.update((chr(0x100 + k), b) for k, b in enumerate(b for b in range(0x100) if b not in own))
    return letters


class TwoTokenizers:
    """Tokens of a byte-level BPE file of the tokenizers library (A; with the same vocabulary as ranks and its pattern if given) and of a sentencepiece model (B)."""

    def __init__(self, a: str, ranks: str | None, pattern: str | None, b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.library, self.quick = Tokenizer.from_file(a), None
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(x): int(y) for x, y in map(bytes.split, file)}
            self.quick = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_to_numpy
        letters = byte_letters()
        entries = self.library.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for token, k in entries.items():
            self.bytes_a[k] = bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        n = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(k) for k in range(n)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]
        # A text may be cut before a space only if no piece goes on over a space behind another character.
        self.divisible = not any("▁" in p.lstrip("▁") for p in names)
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))

    def _spelled(self, ids: list[int], raw: bytes, spell: list[bytes]) -> bool:
        return b"".join(map(spell.__getitem__, ids)) == raw

    def _tokens_a(self, text: str) -> np.ndarray | None:
        whole = " " + text
        if self.quick is not None and PLAIN.fullmatch(text):
            return self.quick(whole, disallowed_special=()).astype(np.int64)  # ranks of bytes: it spells what it reads
        ids = self.library.encode(whole, add_special_tokens=False).ids
        return np.array(ids, dtype=np.int64) if self._spelled(ids, whole.encode("utf-8", "surrogatepass"), self.bytes_a) else None

    def _tokens_b(self, text: str) -> np.ndarray | None:
        ids = self.pieces.encode(text)
        return np.array(ids, dtype=np.int64) if self._spelled(ids, b" " + text.encode("utf-8", "surrogatepass"), self.bytes_b) else None

    def segments(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The tokens of a text, which both read with a space before it, in parts that end where a token of both ends; None where a part's bytes are not the text's."""
        start = 0
        while start <= len(text):
            cut = BREAK.search(text, start + SEGMENT) if self.divisible and len(text) - start > SEGMENT else None
            end = cut.start() if cut else len(text)
            part = text[start:end]
            a = self._tokens_a(part)
            b = self._tokens_b(part) if a is not None else None
            if a is None or b is None:
                yield None
                return
            yield a, b
            start = end + 1


def diagonals(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, list[int], list[int], np.ndarray]:
    """(straight, a, b, irregular) of two strictly rising arrays with the same last end.

    straight are rows (i, j, n): n tokens from i of A and from j of B that go one to one. a and b are the indexes of overlapping
    tokens of all other groups, and irregular rows (i, j) of the last tokens of each of these.
    """
    i = j = 0
    n, straight, irregular = len(ends_a), [], []
    link_a: list[int] = []
    link_b: list[int] = []
    while i < n:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            # Ends at this shift, in runs each twice as long as the last; behind the first that differs, half as long each.
            first, second = i, j
            i, j, width = i + 1, j + 1, 2
            while ends_a[i : i + width] == ends_b[j : j + width] and i + width <= n:
                i, j, width = i + width, j + width, 2 * width
            while width > 1:
                width >>= 1
                if i + width <= n and ends_a[i : i + width] == ends_b[j : j + width]:
                    i, j = i + width, j + width
            straight += (first, second, i - first)
            if i == n:
                break
            x, y = ends_a[i], ends_b[j]
        # An irregular group, end by end up to the next common one; the shift is then another, or the same again.
        link_a.append(i)
        link_b.append(j)
        while x != y:
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
            link_a.append(i)
            link_b.append(j)
        irregular += (i, j)
        i, j = i + 1, j + 1
    return np.array(straight, dtype=np.int64).reshape(-1, 3), link_a, link_b, np.array(irregular, dtype=np.int64).reshape(-1, 2)


def straight_tokens(straight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A's indexes, B's indexes) of one-to-one groups."""
    size = straight[:, 2]
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(straight[:, 0], size) + within, np.repeat(straight[:, 1], size) + within


def names(size: int, last: str) -> np.ndarray:
    """Decimal ids with a comma, and behind them the same with what stands behind the last of a group."""
    return np.array([f"{k}{mark}" for mark in (",", last) for k in range(size)], dtype=object)


def group_text(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, names_a: np.ndarray, names_b: np.ndarray) -> str:
    """Groups as `a1,a2|b1;a3|b2,b3`: each token goes behind its own side's earlier ones and what the other side has up to its group."""
    out = np.empty(len(a) + len(b), dtype=object)
    end_a, end_b = np.flatnonzero(last_a) + 1, np.r_[0, np.flatnonzero(last_b) + 1]
    out[np.arange(len(a)) + end_b[np.cumsum(last_a) - last_a]] = names_a[a + len(names_a) // 2 * last_a]
    out[np.arange(len(b)) + end_a[np.cumsum(last_b) - last_b]] = names_b[b + len(names_b) // 2 * last_b]
    return "".join(out.tolist())[:-1]


@lru_cache(maxsize=2)
def _tokenizers(*files: str | None) -> tuple[TwoTokenizers, np.ndarray, np.ndarray]:
    both = TwoTokenizers(*files)
    return both, names(len(both.bytes_a), "|"), names(len(both.bytes_b), ";")


ALIGNED = "row long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def _aligned(text: str | None, both: TwoTokenizers, names_a: np.ndarray, names_b: np.ndarray, with_groups: bool) -> tuple:
    """(tokens of A, of B, groups, links, digest, pair codes and how often each is linked) of a text, and with_groups the groups."""
    nothing = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64), "")
    if not text:
        return nothing
    n_a = n_b = n_groups = n_links = 0
    state, codes, shown = hashlib.sha256(), [], []
    for part in both.segments(text):
        if part is None:
            return nothing
        a, b = part
        ends_a, ends_b = np.cumsum(both.size_a[a]).tolist(), np.cumsum(both.size_b[b]).tolist()
        straight, more_a, more_b, irregular = diagonals(ends_a, ends_b)
        one_a, one_b = straight_tokens(straight)
        last_a, last_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        last_a[one_a] = last_b[one_b] = True
        last_a[irregular[:, 0]] = last_b[irregular[:, 1]] = True
        groups = group_text(a, b, last_a, last_b, names_a, names_b)
        state.update((";" * bool(n_a) + groups).encode())
        if with_groups:
            shown.append(groups)
        codes += [a[one_a] * len(both.bytes_b) + b[one_b], a[np.array(more_a, dtype=np.int64)] * len(both.bytes_b) + b[np.array(more_b, dtype=np.int64)]]
        n_a, n_b, n_links, n_groups = n_a + len(a), n_b + len(b), n_links + len(one_a) + len(more_a), n_groups + int(last_a.sum())
    pairs, times = np.unique(np.concatenate(codes), return_counts=True)
    return n_a, n_b, n_groups, n_links, state.hexdigest(), pairs, times, ";".join(shown)


@lru_cache(maxsize=1)
def _squeezer() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One of each for a worker: a new one costs more than a document's pairs."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pair codes as steps, and their counts."""
    steps = np.diff(pairs, prepend=0).astype("<u8")
    return _squeezer()[0].compress(steps.tobytes() + times.astype("<u4").tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = _squeezer()[1].decompress(data)
    n = len(raw) // 12
    return np.cumsum(np.frombuffer(raw, "<u8", n).astype(np.int64)), np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64)


def aligned(docs: DataFrame, a: str, ranks: str | None, pattern: str | None, b: str, with_groups: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (ALIGNED) for each document; with_groups the groups as text too.

    a is a byte-level BPE file of the tokenizers library, which reads a space and the text, with its vocabulary as ranks and its
    pre-tokenizer's pattern if they are known; b is a sentencepiece model that adds the space. Strings of special tokens are plain text.
    Null and empty texts, and those that the tokens of A or B do not spell byte by byte, have zeros, an empty digest and no pairs.
    `row` numbers the rows of a run; rows with null or repeated ids are rows like others.
    """
    names = [c.split()[0] for c in ALIGNED.split(", ")] + ["groups"] * with_groups

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, at = _tokenizers(a, ranks, pattern, b), TaskContext.get().partitionId() << 33
        for frame in portions(frames, "text"):
            rows = []
            for i, text in zip(frame["doc_id"], frame["text"]):
                *counts, digest, pairs, times, groups = _aligned(text, *both, with_groups)
                rows.append((at, i, *counts, digest, _packed(pairs, times), *([groups] * with_groups)))
                at += 1
            yield pd.DataFrame(rows, columns=names)

    slim = docs.select(F.col(id_column).cast("long").cast("string").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return slim.mapInPandas(run, ALIGNED + ", groups string" * with_groups)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, a, b, n, best) of aligned rows: how many documents hold each pair linked, and whether no pair of its A token has more.

    Documents' pairs are counted in gatherings within tasks, then summed by a shuffle. A token has as many pairs as B has tokens at most.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def counted() -> pd.DataFrame:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"pair": pairs, "n": n.astype(np.int64)})

        for frame in frames:
            for data in frame["pairs"]:
                held.append(_unpacked(data)[0])
                size += len(held[-1])
                if size >= GATHER:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = rows.select("pairs").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("a", F.expr(f"pair div {size_b}")).withColumn("b", F.expr(f"pair % {size_b}"))
    return counts.select("pair", "a", "b", "n", (F.col("n") == F.max("n").over(Window.partitionBy("a"))).alias("best"))


def _frequent(counts: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(least count, pairs, counts, best) of the most frequent pairs, FREQUENT at most: steps of counts are taken whole, from the highest down."""
    level = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(level.alias("level")).agg(F.count("*").alias("k"), F.min("n").alias("least")).orderBy(F.desc("level")).collect()
    least = 1 << 62
    for row, total in zip(steps, accumulate(r["k"] for r in steps)):
        if total > FREQUENT:
            break
        least = row["least"]
    found = counts.where(F.col("n") >= least).select("pair", "n", "best").toPandas().sort_values("pair")
    return least, found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool)


LOOKED_UP = "row long, doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, rest array<struct<pair:long,times:long>>"


def alignment_report(docs: DataFrame, a: str, ranks: str | None, pattern: str | None, b: str, size_b: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link's count is the number of documents of the corpus that hold its pair of ids linked; n_best are the links whose count is
    the highest of their A id (ties included), count_sum is the sum over links. The most frequent pairs (FREQUENT at most)
    are looked up where documents lie; a document's other pairs meet their counts by a join. size_b is the size of B's vocabulary.
    """
    rows = materialize(aligned(docs, a, ranks, pattern, b, False, id_column, text_column), "aligned")
    counts = materialize(pair_counts(rows, size_b), "pairs")
    least, *table = _frequent(counts)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    names = [c.split()[0] for c in LOOKED_UP.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, n, best = shared.value
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                own, times = _unpacked(row.pairs)
                at = np.searchsorted(pairs, own)
                at[at == len(pairs)] = 0
                hit = pairs[at] == own if len(pairs) else np.zeros(len(own), dtype=bool)
                found, k = at[hit], times[hit]
                rest = [{"pair": p, "times": t} for p, t in zip(own[~hit].tolist(), times[~hit].tolist())]
                out.append((*row[:6], int(k[best[found]].sum()), int((k * n[found]).sum()), row.groups_sha256, rest))
            yield pd.DataFrame(out, columns=names)

    known = materialize(rows.mapInPandas(run, LOOKED_UP), "known")
    rare = counts.where(F.col("n") < least).select("pair", "n", "best")
    sums = known.select("row", F.inline("rest")).join(rare, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    out = known.drop("rest").join(sums, "row", "left")
    plus = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"), plus("count_sum", "more"), "groups_sha256")
