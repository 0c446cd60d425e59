"""Trims of reads (seq, qual): adapters by semi-global alignment, anchored oligos, quality; single reads and pairs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Costs are held above, start positions below this many bits of one number, so that the smaller number is the better alignment.
BITS = 24
#: Reads that are aligned at once.
BLOCK = 4_096


def _pieces(sequence: str, n: int) -> list[str]:
    """n parts of about one length."""
    cuts = [k * len(sequence) // n for k in range(n + 1)]
    return [sequence[a:b] for a, b in zip(cuts, cuts[1:])]


class Adapter:
    """One 3' adapter: whole anywhere in a read, or by a prefix at the read's end. A 5' adapter is this one for reversed reads.

    An alignment of the first i letters of the adapter with d edits (a letter changed, missing or added) counts if i is `overlap`
    at least and d is error * i at most. It scores i - 2 d; of equal scores that which begins first is taken.
    """

    def __init__(self, sequence: str, error: float, overlap: int) -> None:
        self.letters = np.frombuffer(sequence.encode(), dtype=np.uint8)
        m = len(sequence)
        self.allowed = np.floor(error * np.arange(m + 1) + 1e-9).astype(np.int64)
        self.allowed[: min(overlap, m + 1)] = -1
        # With d edits, one of d + 1 pieces of what is aligned stands unchanged in the read; reads without one are not aligned.
        self.whole = _pieces(sequence, int(self.allowed[m]) + 1) if self.allowed[m] >= 0 else []
        self.exact_ends = tuple(sequence[:i] for i in range(m) if self.allowed[i] == 0)
        self.ends = [(i + int(self.allowed[i]), _pieces(sequence[:i], int(self.allowed[i]) + 1)) for i in range(m) if self.allowed[i] > 0]

    def may_hold(self, read: str) -> bool:
        return any(p in read for p in self.whole) or read.endswith(self.exact_ends) or any(p in read[-n:] for n, pieces in self.ends for p in pieces)

    def align(self, reads: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, starts) for rows of letters of given sizes; the score is below 0 where nothing counts.

        Columns of the edit distance table follow the reads' letters, all reads at once; along a column the running minimum of
        cost less row gives what missing letters cost. Each entry carries where its alignment starts.
        """
        m, n = len(self.letters), len(reads)
        one, rows = 1 << BITS, np.arange(m + 1, dtype=np.int64) << BITS
        column = np.tile(rows, (n, 1))
        score, start = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)

        def take(who: np.ndarray, values: np.ndarray, i: np.ndarray) -> None:
            cost, begin = values >> BITS, values & (one - 1)
            points = np.where(cost <= self.allowed[i], i - 2 * cost, -1)
            better = (points > score[who]) | ((points == score[who]) & (points >= 0) & (begin < start[who]))
            score[who[better]], start[who[better]] = points[better], begin[better]

        for j in range(int(sizes.max(initial=0)) + 1):
            if j:
                step = np.minimum(column[:, :-1] + ((reads[:, j - 1, None] != self.letters) * one), column[:, 1:] + one)
                column = np.concatenate([np.full((n, 1), j, dtype=np.int64), step], axis=1)
                column = np.minimum.accumulate(column - rows, axis=1) + rows
            inside = np.nonzero(j <= sizes)[0]
            take(inside, column[inside, m], np.full(len(inside), m))
            ending = np.nonzero(j == sizes)[0]
            for i in np.nonzero(self.allowed[:m] >= 0)[0] if len(ending) else ():
                take(ending, column[ending, i], np.full(len(ending), i))
        return score, start


def _letters(reads: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Reads as rows of bytes, padded at the end, and their sizes."""
    raw = [r.encode("ascii", "replace") for r in reads]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    out = np.zeros((len(raw), int(sizes.max(initial=0))), dtype=np.uint8)
    for row, r in zip(out, raw):
        row[: len(r)] = np.frombuffer(r, dtype=np.uint8)
    return out, sizes


def best_adapters(reads: list[str], adapters: list[tuple[Adapter, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the best adapter in the list, or -1; what stays: from, to) of each read. adapters: (adapter, whether it is a 5' one, made of reversed letters).

    The highest score wins, then the adapter listed first.
    """
    n = len(reads)
    best, score = np.full(n, -1), np.full(n, -1, dtype=np.int64)
    low, high = np.zeros(n, dtype=np.int64), np.array([len(r) for r in reads], dtype=np.int64)
    reversed_reads = [r[::-1] for r in reads] if any(five for _, five in adapters) else []
    for place, (adapter, five) in enumerate(adapters):
        own = reversed_reads if five else reads
        who = np.array([k for k, r in enumerate(own) if adapter.may_hold(r)], dtype=np.int64)
        for at in range(0, len(who), BLOCK):
            part = who[at : at + BLOCK]
            points, start = adapter.align(*_letters([own[k] for k in part]))
            wins = points > score[part]
            part, start = part[wins], start[wins]
            best[part], score[part] = place, points[wins]
            size = np.array([len(reads[k]) for k in part], dtype=np.int64)
            low[part], high[part] = (size - start, size) if five else (0, start)
    return best, low, high


def trim_adapters(reads: DataFrame, adapters: Sequence[str], five: Sequence[str] = (), error: float = 0.1, overlap: int = 3, least: int = 20, columns: tuple[str, str] = ("seq", "qual"), found: str | None = None) -> DataFrame:
    """reads without their best adapter, of all that `adapters` (3') and `five` (5', not anchored) list, and of `least` bases at least.

    A 3' adapter goes with all behind it, a 5' one with all before it; the read's end may cut a 3' adapter, its beginning a 5' one.
    See Adapter for what counts; ties go to the adapter listed first, 3' before 5', and then to the longer cut. A null read
    stays null and is dropped unless least is 0. `found` names a column for the adapter that was cut, null where none was.
    """
    seq, qual = columns
    listed = [*adapters, *five]
    made = [(Adapter(a, error, overlap), False) for a in adapters] + [(Adapter(a[::-1], error, overlap), True) for a in five]
    if not all(listed):
        raise ValueError("empty adapter")

    @F.pandas_udf("adapter int, low int, high int")
    def place(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for sequences in parts:
            best, low, high = best_adapters([s if isinstance(s, str) else "" for s in sequences], made)
            yield pd.DataFrame({"adapter": best, "low": low, "high": high}).astype("int32")

    out = reads.withColumn("_cut", place(seq))
    for c in (seq, qual):
        out = out.withColumn(c, F.expr(f"substring(`{c}`, _cut.low + 1, _cut.high - _cut.low)"))
    if found:
        out = out.withColumn(found, F.try_element_at(F.array(*map(F.lit, listed)), F.nullif(F.col("_cut.adapter") + 1, F.lit(0))))
    return out.drop("_cut").where(F.coalesce(F.length(seq), F.lit(0)) >= least)


def trim_anchored(reads: DataFrame, oligos: list[str]) -> DataFrame:
    """reads (seq, qual) without an oligo of the list that they begin with; others pass. Of several the longest goes."""
    cut = F.lit(0)
    for oligo in sorted(oligos, key=len):
        cut = F.when(F.col("seq").startswith(oligo), len(oligo)).otherwise(cut)
    out = reads.withColumn("_cut", cut)
    return out.withColumn("seq", F.expr("substring(seq, _cut + 1)")).withColumn("qual", F.expr("substring(qual, _cut + 1)")).drop("_cut")


def trim_quality(reads: DataFrame, cutoff: int = 20, base: int = 33, columns: tuple[str, str] = ("seq", "qual")) -> DataFrame:
    """reads without the 3' end where the running sum of cutoff less quality is largest."""
    seq, qual = columns
    points = F.transform(F.reverse(F.split(qual, "")), lambda c: F.lit(cutoff + base) - F.ascii(c))
    # The state is (sum, best sum, bases cut at the best, bases seen, stopped).
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("b"), F.lit(0).alias("k"), F.lit(0).alias("i"), F.lit(False).alias("stop"))

    def step(a: Column, x: Column) -> Column:
        total = a["s"] + x
        stop = a["stop"] | (total < 0)
        better = ~stop & (total > a["b"])
        return F.struct(F.when(stop, a["s"]).otherwise(total).alias("s"), F.when(better, total).otherwise(a["b"]).alias("b"), F.when(better, a["i"] + 1).otherwise(a["k"]).alias("k"), (a["i"] + 1).alias("i"), stop.alias("stop"))

    out = reads.withColumn("_keep", F.length(seq) - F.when(F.length(qual) > 0, F.aggregate(F.filter(points, lambda x: x.isNotNull()), start, step)["k"]).otherwise(0))
    for c in (seq, qual):
        out = out.withColumn(c, F.expr(f"substring(`{c}`, 1, _keep)"))
    return out.drop("_keep")


def trim_pairs(pairs: DataFrame, adapters: Sequence[str], cutoff: int = 20, error: float = 0.1, overlap: int = 1, least: int = 20) -> DataFrame:
    """pairs (seq1, qual1, seq2, qual2) with both reads cut by quality, then by 3' adapter; a pair goes if either read has fewer than `least` bases left."""
    for k in (1, 2):
        columns = (f"seq{k}", f"qual{k}")
        pairs = trim_adapters(trim_quality(pairs, cutoff, columns=columns), adapters, (), error, overlap, 0, columns)
    short = lambda c: F.coalesce(F.length(c), F.lit(0)) < least
    return pairs.where(~(short("seq1") | short("seq2")))
