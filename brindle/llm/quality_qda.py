"""Quality classifier: regularised quadratic discriminant on transformed document statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .isolation import statistics
from .storage import materialize

#: Shrinkage of a class covariance: towards the pooled one, then towards its mean variance.
POOL, RIDGE = 0.3, 0.05
#: Newton steps at most that scale the scores to probabilities, and the length, as a share of the coefficients, below which a step is the last.
STEPS, STILL = 30, 1e-9


def transformed(frame: pd.DataFrame) -> np.ndarray:
    """Statistics as features: logarithms of size and density, square roots of shares."""
    raw = {c: frame[c].to_numpy(float) for c in frame.columns if c.startswith("n_") or c == "word_chars"}
    n, chars = np.maximum(raw["n_words"], 1), np.maximum(raw["word_chars"], 1)
    return np.stack(
        [
            np.log1p(raw["n_words"]),
            raw["word_chars"] / n,
            np.sqrt(raw["n_symbols"] / chars),
            np.sqrt(raw["n_marks"] / chars),
            np.sqrt(raw["n_upper"] / chars),
            np.sqrt(raw["n_dup_lines"] / n),
            np.sqrt(raw["n_repeat_words"] / n),
            np.log(np.maximum(raw["n_distinct"], 1)) / np.log(n + 1),
        ],
        axis=1,
    )


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> dict:
    """Means, inverse Cholesky factors of the shrunk covariances, and log determinants, of counts, sums and sums of products."""
    total = sum(n for n, _, _ in moments.values())
    means = {c: s / n for c, (n, s, _) in moments.items()}
    scatter = {c: p - n * np.outer(means[c], means[c]) for c, (n, _, p) in moments.items()}
    pooled = sum(scatter.values()) / max(total - len(moments), 1)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
    out = {}
    for c, (n, _, _) in moments.items():
        own = scatter[c] / max(n - 1, 1) if n > 1 else pooled
        mixed = ((1 - POOL) * own + POOL * pooled) / np.outer(scale, scale)
        mixed = (1 - RIDGE) * mixed + RIDGE * np.eye(len(scale)) * max(np.trace(mixed) / len(scale), 1e-6)
        factor = np.linalg.cholesky(mixed)
        out[c] = {"mean": means[c] / scale, "inverse": np.linalg.inv(factor), "logdet": 2 * np.log(np.diag(factor)).sum(), "prior": np.log(n / total)}
    return {"scale": scale, "classes": out}


def margin(model: dict, x: np.ndarray) -> np.ndarray:
    """Log density of class 1 less that of class 0, with priors."""
    part = {}
    for c, k in model["classes"].items():
        z = (x / model["scale"] - k["mean"]) @ k["inverse"].T
        part[c] = k["prior"] - 0.5 * (k["logdet"] + (z * z).sum(axis=1))
    return part[1] - part[0]


def squash(z: np.ndarray) -> np.ndarray:
    return np.sign(z) * np.log1p(np.abs(z))


def scale_fit(measure: Callable[[float, float], tuple[float, ...]]) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through squashed margins, by Newton steps with a little ridge.

    measure gives the sums over all rows, at a slope and an intercept, of error * z, error, weight * z * z, weight * z and
    weight: error is the probability less the label, weight its variance. It is asked once for each step.
    """
    w = np.array([1.0, 0.0])
    for _ in range(STEPS):
        ez, e, wzz, wz, ww = measure(float(w[0]), float(w[1]))
        gradient = np.array([ez, e]) + 1e-3 * w
        curvature = np.array([[wzz, wz], [wz, ww]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() <= STILL * (1 + np.abs(w).max()):
            break
    return float(w[0]), float(w[1])


def scaled(margins: DataFrame) -> tuple[float, float]:
    """scale_fit() over all rows of a written table of squashed margins z and labels y; only five sums a step reach the driver."""

    def measure(slope: float, level: float) -> tuple[float, ...]:
        line = F.lit(slope) * F.col("z") + F.lit(level)
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))
        rows = margins.select("z", (p - F.col("y")).alias("e"), (p * (1 - p)).alias("w"))
        return tuple(rows.agg(F.sum(F.expr("e * z")), F.sum("e"), F.sum(F.expr("w * z * z")), F.sum(F.expr("w * z")), F.sum("w")).first())

    return scale_fit(measure)


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row with an id: score is the probability of quality 1, predicted 1 from 0.3.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out: their labels are never read. Class moments are summed over
    all other labelled rows, and all of them scale the scores. Labels other than 0 and 1 are ignored, of
    several for an id the larger counts. If a class has no label, every score is the share of label 1 (0.5 without
    labels). Null and empty texts are scored as texts without words. Repeated rows repeat; an empty table gives no rows.
    """
    table = statistics(docs, id_column, text_column).drop("base_failed").withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    table = materialize(table, "statistics")
    marked = labels.where("quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    known = materialize(table.where("NOT held_out").join(marked, "doc_id"), "known")

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = transformed(frame)
            for c in (0, 1):
                own = x[frame["quality"].to_numpy() == c]
                flat = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                yield pd.DataFrame({"quality": c, "place": np.arange(len(flat)), "value": flat})

    sums = known.mapInPandas(moments, "quality int, place int, value double").groupBy("quality", "place").agg(F.sum("value").alias("value")).toPandas()
    found = {}
    for c, part in sums.sort_values("place").groupby("quality"):
        v = part["value"].to_numpy()
        d = int(np.sqrt(len(v) - 0.75) - 0.5)
        if v[0] > 0:
            found[int(c)] = (v[0], v[1 : d + 1], v[d + 1 :].reshape(d, d))
    model = discriminant(found) if len(found) == 2 else None
    flat = sum(n for c, (n, _, _) in found.items() if c == 1) / max(sum(n for n, _, _ in found.values()), 1) if found else 0.5
    slope, level = 1.0, 0.0
    if model:

        def margins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield pd.DataFrame({"z": squash(margin(model, transformed(frame))), "y": frame["quality"].to_numpy(float)})

        slope, level = scaled(materialize(known.mapInPandas(margins, "z double, y double"), "margins"))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            score = 1 / (1 + np.exp(-np.clip(slope * squash(margin(model, transformed(frame))) + level, -40, 40))) if model else np.full(len(frame), flat)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "score": score, "predicted": (score >= 0.3).astype(np.int32)})

    return table.mapInPandas(judge, "doc_id long, held_out boolean, score double, predicted int")
