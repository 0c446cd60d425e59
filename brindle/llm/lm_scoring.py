"""Cross-entropy difference under two matched bigram models.

The target and the background model have the same order, the same additive smoothing and one vocabulary, all words of both
corpora: P(w | v) = (c(v w) + alpha) / (c(v) + alpha * V). The bigrams of every document go once to the bucket of their first
word, where counts of both corpora meet and each document's share of the loss difference is summed. First words so frequent
that a bucket would be too large are dealt out by the second word instead, with their totals from the vocabulary count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize, partitions
from .text import U64, hash_words, ngrams, portions, words

#: Bigrams of a bucket, about, and parts in which a bucket is scored.
BUCKET = 1_000_000
SLICES = 8
#: Buckets whose sums meet in one task at the end; a sum is small beside the bigrams behind it.
GATHERED = 16
_ENTRIES = "bucket long, target boolean, docs binary, firsts binary, runs binary, pairs binary, pair_runs binary, which binary, counts binary"
_SUMS = "bucket long, docs binary, gain binary, counts binary"


def _place(n: int) -> type:
    """The integers that hold a place among n documents, and numbers up to n."""
    return np.uint16 if n < 2**16 else np.uint32


def _bigrams(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, bigram, text) of every bigram of a batch."""
    lists = [words(t) for t in texts]
    h = hash_words([w for items in lists for w in items])
    text = np.repeat(np.arange(len(lists)), [len(items) for items in lists])
    same = text[1:] == text[:-1]
    return h[:-1][same], ngrams(h, 2)[same], text[:-1][same]


def _contexts(rows: DataFrame) -> DataFrame:
    """(word, n_target, n_background): how often each word is followed by another, of all words of both corpora."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text"):
            lists = [words(t) for t in frame["text"]]
            h = hash_words([w for items in lists for w in items])
            side = np.repeat(frame["target"].to_numpy(bool), [len(items) for items in lists])
            last = np.zeros(len(h), dtype=bool)
            ends = np.cumsum([len(items) for items in lists])
            last[ends[[bool(items) for items in lists]] - 1] = True
            word, at = np.unique(h, return_inverse=True)
            yield pd.DataFrame({"word": word.view(np.int64), "n_target": np.bincount(at, side & ~last, len(word)).astype(np.int64), "n_background": np.bincount(at, ~side & ~last, len(word)).astype(np.int64)})

    counted = rows.mapInPandas(run, "word long, n_target long, n_background long")
    return materialize(counted.groupBy("word").agg(F.sum("n_target").alias("n_target"), F.sum("n_background").alias("n_background")), "vocabulary")


def cross_entropy_difference(docs: DataFrame, target: DataFrame, alpha: float = 0.01, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score) of each id of docs: the mean over its words after the first of log P_target - log P_background.

    target has a text column of the same name; docs are the background corpus. Higher: more like the target. Texts
    of fewer than two words, empty and null ones score 0 with n_tokens 0. Rows without an id count in the background but are
    not scored; rows that repeat an id are scored as one. Empty tables are allowed on either side.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.lit(False).alias("target"), F.col(text_column).cast("string").alias("text"))
    rows = rows.unionByName(target.select(F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("target"), F.col(text_column).cast("string").alias("text")))
    vocabulary = _contexts(rows)
    size, total = vocabulary.agg(F.count("*"), F.coalesce(F.sum(F.col("n_target") + F.col("n_background")), F.lit(0))).first()
    # A bucket is held by one task, so there are as many as the data need.
    parts = max(parts, int(total) // BUCKET)
    goals = max(partitions(spark), parts // GATHERED)
    # At most 4 * parts words can each have more than a 4 * parts-th of all bigrams.
    hot = vocabulary.where((F.col("n_target") + F.col("n_background")) * 4 * parts > total).orderBy("word").toPandas()
    hot_word = hot["word"].to_numpy(np.int64).view(U64)
    order = np.argsort(hot_word)
    hot_word, hot_total = hot_word[order], hot[["n_target", "n_background"]].to_numpy(float)[order]

    def is_hot(first: np.ndarray) -> np.ndarray:
        return np.isin(first, hot_word)

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text"):
            ids, known = frame["doc_id"].fillna(0).to_numpy(np.int64), frame["doc_id"].notna().to_numpy()
            first, pair, text = _bigrams(frame["text"])
            bucket = (np.where(is_hot(first), pair, first) % U64(parts)).astype(np.int64)
            order = np.lexsort((text, pair, first, bucket))
            first, pair, text, bucket = first[order], pair[order], text[order], bucket[order]
            new = np.ones(len(pair), dtype=bool)
            new[1:] = (pair[1:] != pair[:-1]) | (text[1:] != text[:-1]) | (bucket[1:] != bucket[:-1])
            at = np.nonzero(new)[0]
            counts = np.diff(np.r_[at, len(pair)]).astype(np.uint32) if len(at) else np.empty(0, np.uint32)
            first, pair, text, bucket = first[at], pair[at], text[at], bucket[at]
            out = []
            side = frame["target"].to_numpy(bool)
            for target_side in (False, True):
                chosen = side[text] == target_side
                f, p, t, b, c = first[chosen], pair[chosen], text[chosen], bucket[chosen], counts[chosen]
                cuts = np.r_[0, np.nonzero(np.diff(b))[0] + 1, len(b)] if len(b) else np.array([0])
                for lo, hi in zip(cuts, cuts[1:]):
                    heads = np.r_[0, np.nonzero(np.diff(f[lo:hi]))[0] + 1]
                    pair_heads = np.r_[0, np.nonzero(np.diff(p[lo:hi]))[0] + 1]
                    used, local = np.unique(t[lo:hi], return_inverse=True)
                    small = _place(len(used))
                    named = np.where(known[used], ids[used], np.iinfo(np.int64).min)
                    runs, pair_runs = (np.diff(np.r_[h, hi - lo]) for h in (heads, pair_heads))
                    out.append((int(b[lo]), target_side, named.tobytes(), f[lo:hi][heads].tobytes(), runs.astype(np.uint32).tobytes(), p[lo:hi][pair_heads].tobytes(), pair_runs.astype(small).tobytes(), local.astype(small).tobytes(), c[lo:hi].tobytes()))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in _ENTRIES.split(", ")])

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for frame in frames:
            for r in frame.itertuples(index=False):
                if held and r.bucket != held[0].bucket:
                    yield judged(held)
                    held = []
                held.append(r)
        if held:
            yield judged(held)

    def difference(side: np.ndarray, first: np.ndarray, pair: np.ndarray, count: np.ndarray) -> np.ndarray:
        kinds, at = np.unique(pair, return_inverse=True)
        pairs = [np.bincount(at, np.where(side == s, count, 0), len(kinds))[at] for s in (True, False)]
        kinds, at = np.unique(first, return_inverse=True)
        firsts = [np.bincount(at, np.where(side == s, count, 0), len(kinds)) for s in (True, False)]
        where = np.nonzero(is_hot(kinds))[0]
        for k in (0, 1):
            firsts[k][where] = hot_total[np.searchsorted(hot_word, kinds[where]), k]
        room = alpha * size
        return count * (np.log(pairs[0] + alpha) - np.log(firsts[0][at] + room) - np.log(pairs[1] + alpha) + np.log(firsts[1][at] + room))

    def judged(held: list[tuple]) -> pd.DataFrame:
        side = np.concatenate([np.full(len(r.counts) // 4, r.target) for r in held])
        first = np.concatenate([np.repeat(np.frombuffer(r.firsts, U64), np.frombuffer(r.runs, np.uint32)) for r in held])
        pair = np.concatenate([np.repeat(np.frombuffer(r.pairs, U64), np.frombuffer(r.pair_runs, _place(len(r.docs) // 8))) for r in held])
        count = np.concatenate([np.frombuffer(r.counts, np.uint32) for r in held])
        # A slice of the bucket at a time, so that temporary arrays stay small; a slice has all of a first word, or of a pair.
        part = ((np.where(is_hot(first), pair, first) >> U64(40)) % U64(SLICES)).astype(np.uint8)
        gain = np.zeros(len(pair))
        for k in range(SLICES):
            own = np.nonzero(part == k)[0]
            gain[own] = difference(side[own], first[own], pair[own], count[own].astype(float))
        docs_, sums, counts, start = [], [], [], 0
        for r in held:
            n = len(r.counts) // 4
            if not r.target:
                ids = np.frombuffer(r.docs, np.int64)
                which = np.frombuffer(r.which, _place(len(ids)))
                docs_.append(ids)
                sums.append(np.bincount(which, gain[start : start + n], len(ids)))
                counts.append(np.bincount(which, count[start : start + n], len(ids)))
            start += n
        if not docs_:
            return pd.DataFrame([], columns=["bucket", "docs", "gain", "counts"])
        ids, total_gain, total_count = np.concatenate(docs_), np.concatenate(sums), np.concatenate(counts)
        chosen = ids != np.iinfo(np.int64).min
        ids, total_gain, total_count = ids[chosen], total_gain[chosen], total_count[chosen]
        # Documents of several batches add up here, so each goes on once.
        ids, at = np.unique(ids, return_inverse=True)
        total_gain, total_count = np.bincount(at, total_gain, len(ids)), np.bincount(at, total_count, len(ids)).astype(np.uint32)
        goal = ids % goals
        order = np.lexsort((ids, goal))
        ids, goal, total_gain, total_count = ids[order], goal[order], total_gain[order], total_count[order]
        cuts = np.r_[0, np.nonzero(np.diff(goal))[0] + 1, len(goal)] if len(goal) else np.array([0])
        return pd.DataFrame([(int(goal[a]), ids[a:b].tobytes(), total_gain[a:b].tobytes(), total_count[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])], columns=["bucket", "docs", "gain", "counts"])

    def total_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, both = np.empty(0, np.int64), np.empty((0, 2))
        for frame in frames:
            ids = np.concatenate([ids, *(np.frombuffer(d, np.int64) for d in frame["docs"])])
            both = np.concatenate([both, *(np.stack([np.frombuffer(g, float), np.frombuffer(c, np.uint32)], axis=1) for g, c in zip(frame["gain"], frame["counts"]))])
            ids, at = np.unique(ids, return_inverse=True)
            both = np.stack([np.bincount(at, both[:, k], len(ids)) for k in (0, 1)], axis=1)
        yield pd.DataFrame({"doc_id": ids, "n_tokens": both[:, 1].astype(np.int64), "score": both[:, 0] / np.maximum(both[:, 1], 1)})

    entries = rows.mapInPandas(post, _ENTRIES).repartition(parts, "bucket").sortWithinPartitions("bucket", "target", F.xxhash64("docs", "pairs"))
    sums = entries.mapInPandas(score, _SUMS).repartition(goals, "bucket").sortWithinPartitions("bucket", F.xxhash64("docs", "gain"))
    scored = sums.mapInPandas(total_of, "doc_id long, n_tokens long, score double")
    every = rows.where("NOT target AND doc_id IS NOT NULL").select("doc_id").distinct()
    return every.join(scored, "doc_id", "left").select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), F.coalesce("score", F.lit(0.0)).alias("score"))
