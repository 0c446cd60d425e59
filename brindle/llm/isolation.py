"""Quality rules with an isolation forest on rule statistics."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .text import hash_words, ngrams, portions, words

STATISTICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_marks long, n_upper long, n_distinct long"
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MARKS = re.compile(r"[!?]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SCHEMA = STATISTICS + ", base_failed boolean"
#: Trees of the forest, each grown on all rows, splits from a root to a leaf at most, and ratios of features().
TREES, HEIGHT, WIDTH = 100, 5, 5
#: Steps of the scores between 0 and 1: few enough that labels are counted by score.
STEPS = 2**18
#: Rows that go down the trees at once.
ROWS = 20_000
#: What the share of good rows that are lost costs against the share of bad ones that are caught.
COST = 10


def rule_statistics(text: str | None) -> tuple[int, ...]:
    """The statistics of STATISTICS after doc_id, for one text."""
    items = words(text)
    n = len(items)
    if not n:
        return (0,) * 8 if not text else (0, 0, len(_SYMBOLS.findall(text)), 0, 0, len(_MARKS.findall(text)), 0, 0)
    h = hash_words(items)
    repeated = np.zeros(n, dtype=bool)
    if n >= 4:
        _, inverse, counts = np.unique(ngrams(h, 3), return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        for i in range(3):
            repeated[i : n - 2 + i] |= again
    lines = [line for line in text.split("\n") if line.strip("\x20\t\n\x0b\x0c\r")]
    spaces = len(text) - sum(text.count(c) for c in "\x20\t\n\x0b\x0c\r")
    return n, spaces, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), int(repeated.sum()), len(_MARKS.findall(text)), len(_UPPER.findall(text)), len(np.unique(h))


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """STATISTICS of every whole text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text"):
            rows = [(i, *rule_statistics(t)) for i, t in zip(frame["doc_id"].tolist(), frame["text"])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in STATISTICS.split(", ")])

    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("doc_id IS NOT NULL")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return slim.mapInPandas(run, STATISTICS).withColumn("base_failed", base)


#: The columns that features() reads.
USED = ("n_words", "word_chars", "n_symbols", "n_marks", "n_upper")


def features(frame: pd.DataFrame) -> np.ndarray:
    """Ratios of the statistics, by which texts of any length compare."""
    n, chars = np.maximum(frame["n_words"].to_numpy(float), 1), np.maximum(frame["word_chars"].to_numpy(float), 1)
    # Repeats are the base rules' affair; a tenth of capitals is usual in prose of short lines and titles.
    columns = [frame["word_chars"] / n, frame["n_symbols"] / chars, frame["n_symbols"] / n, frame["n_marks"] / chars, np.maximum(frame["n_upper"] / chars, 0.1)]
    return np.stack([np.asarray(c, dtype=float) for c in columns], axis=1)


def _average_path(n: int) -> float:
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def _leaves(trees: list, x: np.ndarray) -> Iterator[np.ndarray]:
    """For each tree, the nodes where the rows of x end."""
    for feature, cut, left in trees:
        feature, cut, left = np.array(feature), np.array(cut), np.array(left)
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            f = feature[at]
            inner = np.nonzero(f >= 0)[0]
            if not len(inner):
                break
            node = at[inner]
            at[inner] = left[node] + (x[inner, f[inner]] >= cut[node])
        yield at


def extents(trees: list, parts: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, smallest, largest values by feature) at each leaf, the nodes of all trees one behind another."""
    ends = np.cumsum([0, *[len(feature) for feature, _, _ in trees]])
    n, low, high = np.zeros(ends[-1], dtype=np.int64), np.full((WIDTH, ends[-1]), np.inf), np.full((WIDTH, ends[-1]), -np.inf)
    for x in parts:
        for start, end, at in zip(ends, ends[1:], _leaves(trees, x)):
            n[start:end] += np.bincount(at, minlength=end - start)
            for f in range(WIDTH):
                np.minimum.at(low[f, start:end], at, x[:, f])
                np.maximum.at(high[f, start:end], at, x[:, f])
    return n, low, high


def grown(measure: Callable[[list], tuple[np.ndarray, np.ndarray, np.ndarray]], seed: int = 7) -> dict:
    """Isolation trees as flat arrays: feature (-1 at a leaf, where cut has the path length), cut, left; right is left + 1.

    measure gives the extents of trees over all rows. It is asked once for each level, whose leaves are then split together.
    """
    rng = np.random.default_rng(seed)
    trees = [([-1], [0.0], [0]) for _ in range(TREES)]
    todo = [(k, 0) for k in range(TREES)]
    total = 0
    for depth in range(HEIGHT + 1):
        if not todo:
            break
        ends = np.cumsum([0, *[len(feature) for feature, _, _ in trees]])
        n, low, high = measure(trees)
        if not depth:
            total = int(n[0])
        following = []
        for k, node in todo:
            at, (feature, cut, left) = ends[k] + node, trees[k]
            wide = np.nonzero(high[:, at] > low[:, at])[0]
            if depth == HEIGHT or not len(wide):
                cut[node] = depth + _average_path(int(n[at]))
                continue
            f = int(rng.choice(wide))
            feature[node], cut[node], left[node] = f, float(rng.uniform(low[f, at], high[f, at])), len(feature)
            for _ in range(2):
                following.append((k, len(feature)))
                feature.append(-1)
                cut.append(0.0)
                left.append(0)
        todo = following
    return {"trees": [list(t) for t in trees] if total else [], "norm": _average_path(total) or 1.0}


def fit_forest(x: np.ndarray, seed: int = 7) -> dict:
    """The forest over the rows of an array."""
    return grown(lambda trees: extents(trees, [x]), seed)


def _gathered(frames: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """The features of frames, about ROWS rows at once."""
    held: list[np.ndarray] = []
    for frame in frames:
        held.append(features(frame))
        if sum(map(len, held)) >= ROWS:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def forest(rows: DataFrame, seed: int = 7) -> dict:
    """The forest over all rows of a written table of statistics, equal to fit_forest() of them whatever the partitions: for each level, tasks sum up the extents of their rows, and only those of nodes meet."""

    def measure(trees: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            n, low, high = extents(trees, _gathered(frames))
            at = np.nonzero(n)[0]
            for f in range(WIDTH):
                yield pd.DataFrame({"node": at, "feature": f, "n": n[at], "low": low[f, at], "high": high[f, at]})

        found = rows.mapInPandas(run, "node long, feature int, n long, low double, high double").groupBy("node", "feature")
        found = found.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
        n, low, high = extents(trees, [])
        node, f = found["node"].to_numpy(), found["feature"].to_numpy()
        n[node], low[f, node], high[f, node] = found["n"], found["low"], found["high"]
        return n, low, high

    return grown(measure, seed)


def anomaly(model: dict, x: np.ndarray) -> np.ndarray:
    """2 ** (-mean path length / expected one) in STEPS: near 1 for what few random splits isolate, 0 without trees."""
    if not model["trees"] or not len(x):
        return np.zeros(len(x))
    total = np.zeros(len(x))
    for (_, cut, _), at in zip(model["trees"], _leaves(model["trees"], x)):
        total += np.array(cut)[at]
    return np.round(STEPS * 2.0 ** (-total / len(model["trees"]) / model["norm"])) / STEPS


def calibrate(score: np.ndarray, good: np.ndarray, n: np.ndarray | int = 1) -> float:
    """The threshold with the best balance of bad rows above it and good rows above it, each counted n times; 1, which rejects none, without both kinds."""
    if good.all() or not good.any():
        return 1.0
    order = np.argsort(-score, kind="stable")
    s, g, n = score[order], good[order], np.broadcast_to(n, len(score))[order]
    caught, lost = np.cumsum(~g * n) / (~g * n).sum(), np.cumsum(g * n) / (g * n).sum()
    ends = np.r_[np.nonzero(np.diff(s))[0], len(s) - 1]
    gain = caught[ends] - COST * lost[ends]
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return 1.0
    k = ends[best]
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(np.nextafter(s[k], 0))


def fitted(table: DataFrame, labels: DataFrame) -> tuple[str, float]:
    """(forest as JSON, threshold) of a written table of statistics: all rows that pass the base rules, and all labelled ones of them."""
    passed = table.where(~F.col("base_failed"))
    slim = passed.select("doc_id", *USED)
    text = json.dumps(forest(slim.drop("doc_id")))
    marked = labels.where("quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = json.loads(text)
        for frame in frames:
            yield pd.DataFrame({"score": anomaly(model, features(frame)), "quality": frame["quality"]})

    # At most STEPS scores for each label, which are counted, so that the driver's rows do not grow with the table.
    known = slim.join(marked, "doc_id").mapInPandas(scored, "score double, quality int").groupBy("score", "quality").count().toPandas()
    return text, calibrate(known["score"].to_numpy(float), known["quality"].to_numpy() == 1, known["count"].to_numpy())


def quality_rules(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """SCHEMA plus anomaly double and kept boolean for each row with an id; null texts count as empty.

    Base rules (at least 50 words, at most half of them in repeated 3-word windows) come first. Each tree of the forest
    is grown on all rows that pass them, and its threshold is calibrated on all labelled ones of these
    (labels: doc_id, quality 0 or 1; others are ignored), where a lost share of good rows counts COST times
    the same share of bad ones. Without labels of both kinds only the base rules decide. Empty tables give empty results; repeated
    rows give repeated results; other columns are ignored.
    """
    table = materialize(statistics(docs, id_column, text_column), "statistics")
    text, threshold = fitted(table, labels)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = json.loads(text)
        for frame in frames:
            frame["anomaly"] = anomaly(forest, features(frame))
            frame["kept"] = ~frame["base_failed"].astype(bool) & (frame["anomaly"] <= threshold)
            yield frame

    return table.mapInPandas(judge, SCHEMA + ", anomaly double, kept boolean")


def kept_documents(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns: each is judged by its own text where it lies, so no text is shuffled.

    Rows without an id take no part in the fit, but are judged like others; rows that repeat an id are judged each by its own text.
    """
    text, threshold = fitted(materialize(statistics(docs, id_column, text_column), "statistics"), labels)
    names = [c.split()[0] for c in STATISTICS.split(", ")][1:]

    @F.pandas_udf("boolean")
    def kept(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forest = json.loads(text)
        for part in parts:
            frame = pd.DataFrame([rule_statistics(t) for t in part], columns=names)
            failed = (frame["n_words"] < 50) | (100 * frame["n_repeat_words"] > 50 * frame["n_words"])
            yield ~failed & (anomaly(forest, features(frame)) <= threshold)

    return docs.where(kept(F.col(text_column).cast("string")))
