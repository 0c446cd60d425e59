"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by fast Hadamard pseudo-rotations (three rounds of random signs and a Walsh-Hadamard transform); the
nearest signed axis is the hash. A table joins as many hashes, the last of fewer axes, as make cells of about CELL
vectors. A query probes the cells whose axes are nearest in each table; candidates are ranked by exact distance there. How many
cells is measured on each table: SAMPLE queries are compared with every vector, and probes double until the cells that
they name hold RECALL of the true neighbours, at most all cells. Cells of many members or queries are split into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import materialize, partitions

#: Tables, probes to begin with, and vectors of a cell.
TABLES, PROBES, CELL = 12, 40, 32
#: Share of true neighbours that the probed cells must hold, and queries on which it is measured.
RECALL, SAMPLE = 0.95, 128
#: Members and queries of a block; a cell of more is split, and each block of members meets each block of queries.
MEMBERS, QUERIES = 4096, 1024
#: Vectors of a cell that are compared at once; cells that are ranked, and rows that are sent, at once.
CHUNK, WORK, ROWS = 4096, 1_000_000, 50_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


class Polytopes:
    """The cells of one table."""

    def __init__(self, width: int, vectors: int, table: int, seed: int = 3) -> None:
        self.width = 1 << max(0, width - 1).bit_length()
        rng = np.random.default_rng((seed, table))
        self.axes: list[int] = []
        wanted = vectors / CELL
        while wanted >= 2 and len(self.axes) < 8:
            d = 1
            while d < self.width and 4 * d <= wanted:
                d *= 2
            self.axes.append(d)
            wanted /= 2 * d
        self.signs = [[rng.choice([-1.0, 1.0], self.width) for _ in range(3)] for _ in self.axes]
        self.cells = int(np.prod([2 * d for d in self.axes], dtype=float)) if self.axes else 1

    def _turned(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        unit = np.zeros((len(x), self.width))
        unit[:, : x.shape[1]] = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        for d, signs in zip(self.axes, self.signs):
            y = unit
            for s in signs:
                y = hadamard(y * s)
            yield 2 * d, np.concatenate([y[:, :d], -y[:, :d]], axis=1)

    def cell(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int64)
        for n, sides in self._turned(x):
            out = out * n + sides.argmax(axis=1)
        return out

    def probes(self, x: np.ndarray, most: int) -> list[np.ndarray]:
        """The `most` cells of each row whose axes together are nearest; all cells, if there are no more."""
        step = max(1, WORK // (min(most, self.cells) * 2 * max(self.axes, default=1)))
        return [cells for a in range(0, len(x), step) for cells in self._probes(x[a : a + step], most)]

    def _probes(self, x: np.ndarray, most: int) -> list[np.ndarray]:
        cells, loss = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
        for n, sides in self._turned(x):
            gap = sides.max(axis=1, keepdims=True) - sides
            near = np.argsort(gap, axis=1, kind="stable")[:, :most]
            total = (loss[:, :, None] + np.take_along_axis(gap, near, axis=1)[:, None, :]).reshape(len(x), -1)
            code = (cells[:, :, None] * n + near[:, None, :]).reshape(len(x), -1)
            keep = np.argsort(total, axis=1, kind="stable")[:, :most]
            cells, loss = np.take_along_axis(code, keep, axis=1), np.take_along_axis(total, keep, axis=1)
        return list(cells)


def _classes(vectors: DataFrame, k: int) -> DataFrame:
    """(vector, ids) of distinct vectors: the k + 1 smallest ids of each, more of which no query can need."""
    parts = partitions(vectors.sparkSession)
    schema = "signature binary, vector binary, ids array<long>"

    def merged(rows: Iterator[tuple[bytes, bytes, list]]) -> pd.DataFrame:
        found: dict[bytes, tuple[bytes, set]] = {}
        for signature, vector, ids in rows:
            if signature in found:
                found[signature] = (vector, set(sorted(found[signature][1] | set(ids))[: k + 1]))
            else:
                found[signature] = (vector, set(ids))
        return pd.DataFrame([(s, v, sorted(i)) for s, (v, i) in found.items()], columns=["signature", "vector", "ids"])

    def batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # Adding 0.0 makes -0.0 and 0.0 one.
            bodies = [(np.asarray(v, dtype=float) + 0.0).tobytes() for v in frame["vector"]]
            yield merged((xxhash.xxh3_128_digest(b), b, [i]) for i, b in zip(frame["vec_id"].tolist(), bodies))

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, tuple[bytes, list]] = {}
        last = None
        for frame in frames:
            rows = []
            for s, v, ids in zip(frame["signature"], frame["vector"], frame["ids"]):
                if s != last and last is not None:
                    rows.append((last, *held.pop(last)))
                last = s
                held[s] = (v, sorted({*(held[s][1] if s in held else ()), *ids})[: k + 1])
            yield pd.DataFrame(rows, columns=["signature", "vector", "ids"])
        yield pd.DataFrame([(s, *x) for s, x in held.items()], columns=["signature", "vector", "ids"])

    return vectors.mapInPandas(batch, schema).repartition(parts, "signature").sortWithinPartitions("signature").mapInPandas(join, schema).drop("signature")


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=float).reshape(len(column), width)


def _bodies(column: pd.Series) -> list[bytes]:
    return [np.asarray(v, dtype=float).tobytes() for v in column]


def _probes_for(queries: DataFrame, classes: DataFrame, width: int, count: int, k: int, tables: int, probes: int) -> int:
    """The probes, `probes` doubled as often as it takes, whose cells hold RECALL of the true neighbours of SAMPLE queries."""
    made = [Polytopes(width, count, t) for t in range(tables)]
    most = min(probes, made[0].cells)
    if most == made[0].cells:
        return most
    sample = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    ids, q = [r["vec_id"] for r in sample], np.array([r["vector"] for r in sample], dtype=float).reshape(len(sample), width)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[list] = [[] for _ in ids]
        for frame in frames:
            x = _matrix(frame["vector"], width)
            rough = (x * x).sum(axis=1)[None, :] - 2 * q @ x.T
            bodies, members = frame["vector"].tolist(), frame["ids"].tolist()
            for i, own in enumerate(ids):
                near = np.argpartition(rough[i], k)[: k + 1].tolist() if len(x) > k + 1 else range(len(x))
                found = [(float(rough[i, j]), m, bodies[j]) for j in near for m in members[j] if m != own]
                best[i] = sorted(best[i] + found, key=lambda f: f[:2])[:k]
        yield pd.DataFrame([(i, *f) for i, found in enumerate(best) for f in found], columns=["row", "apart", "id", "vector"])

    nearest = F.row_number().over(Window.partitionBy("row").orderBy("apart", "id"))
    true = classes.mapInPandas(scan, "row int, apart double, id long, vector binary").withColumn("rank", nearest).where(F.col("rank") <= k).select("row", "vector").toPandas()
    if not len(true):
        return most
    x, row = _matrix(true["vector"], width), true["row"].to_numpy()
    homes = [p.cell(x) for p in made]
    while most < made[0].cells:
        held = np.zeros(len(x), dtype=bool)
        for p, home in zip(made, homes):
            # One query's cells at a time: with many probes all of them would fill the driver.
            for i in np.unique(row):
                mine = row == i
                held[mine] |= np.isin(home[mine], p.probes(q[i : i + 1], most)[0])
        if held.mean() >= RECALL:
            break
        most = min(2 * most, made[0].cells)
    return most


def _blocks(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the cells with more members or queries than a block: their numbers in order, and the blocks of both."""
    full = F.ceil(F.col("members") / MEMBERS).alias("members"), F.ceil(F.col("queries") / QUERIES).alias("queries")
    hot = counts.groupBy("cell").agg(F.sum("members").alias("members"), F.sum("queries").alias("queries"))
    # A cell that only one side has is compared with nothing.
    hot = hot.where((F.col("members") > 0) & (F.col("queries") > 0) & ((F.col("members") > MEMBERS) | (F.col("queries") > QUERIES)))
    found = hot.select("cell", *full).orderBy("cell").toPandas()
    return tuple(found[c].to_numpy(np.int64) for c in ("cell", "members", "queries"))


def _spread(cells: np.ndarray, names: np.ndarray, side: int, hot: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, block) for each block of its cell where a row goes: members to their own row of blocks, queries to their own column."""
    high, wide = np.ones(len(cells), dtype=np.int64), np.ones(len(cells), dtype=np.int64)
    if len(hot[0]):
        at = np.minimum(np.searchsorted(hot[0], cells), len(hot[0]) - 1)
        known = hot[0][at] == cells
        high[known], wide[known] = hot[1][at[known]], hot[2][at[known]]
    copies = wide if side else high
    row = np.repeat(np.arange(len(cells)), copies)
    other = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
    if side:
        return row, (names % high)[row] * wide[row] + other
    return row, other * wide[row] + (names % wide)[row]


def _search(queries: DataFrame, classes: DataFrame, width: int, count: int, k: int, tables: int, probes: int | None) -> DataFrame:
    """(query_id, vec_id, score): the k nearest of each cell that a query probes; probes None: every cell."""
    parts = partitions(queries.sparkSession)
    schema = "cell long, block long, side int, id long, vector binary, ids array<long>"

    def matrix(column: pd.Series) -> np.ndarray:
        return _matrix(column, width)

    def names(bodies) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(b) >> 1 for b in bodies), dtype=np.int64, count=len(bodies))

    def homes(frame: pd.DataFrame, made: list[Polytopes]) -> Iterator[np.ndarray]:
        x = matrix(frame["vector"])
        for t, p in enumerate(made):
            yield t * p.cells + p.cell(x)

    def asked_of(x: np.ndarray, made: list[Polytopes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for t, p in enumerate(made):
            most = min(probes or p.cells, p.cells)
            step = max(1, ROWS // most)
            for a in range(0, len(x), step):
                found = p.probes(x[a : a + step], most)
                yield np.repeat(np.arange(a, a + len(found)), [len(c) for c in found]), t * p.cells + np.concatenate(found)

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [Polytopes(width, count, t) for t in range(tables)]
        for frame in frames:
            for cells in homes(frame, made):
                cell, n = np.unique(cells, return_counts=True)
                yield pd.DataFrame({"cell": cell, "members": n, "queries": 0})

    def tally_asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [Polytopes(width, count, t) for t in range(tables)]
        for frame in frames:
            for _, cells in asked_of(matrix(pd.Series(_bodies(frame["vector"]))), made):
                cell, n = np.unique(cells, return_counts=True)
                yield pd.DataFrame({"cell": cell, "members": 0, "queries": n})

    numbers = "cell long, members long, queries long"
    hot = _blocks(classes.mapInPandas(tally, numbers).unionByName(queries.mapInPandas(tally_asked, numbers)))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [Polytopes(width, count, t) for t in range(tables)]
        for frame in frames:
            own = names(frame["vector"])
            for cells in homes(frame, made):
                row, block = _spread(cells, own, 1, hot)
                for a in range(0, len(row), ROWS):
                    r = row[a : a + ROWS]
                    yield pd.DataFrame({"cell": cells[r], "block": block[a : a + ROWS], "side": 1, "id": 0, "vector": frame["vector"].to_numpy()[r], "ids": frame["ids"].to_numpy()[r]})

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [Polytopes(width, count, t) for t in range(tables)]
        for frame in frames:
            bodies = np.array(_bodies(frame["vector"]), dtype=object)
            ids = frame["vec_id"].to_numpy(np.int64)
            own = names([i.tobytes() for i in ids])
            for at, cells in asked_of(matrix(pd.Series(bodies)), made):
                row, block = _spread(cells, own[at], 0, hot)
                for a in range(0, len(row), ROWS):
                    r = row[a : a + ROWS]
                    yield pd.DataFrame({"cell": cells[r], "block": block[a : a + ROWS], "side": 0, "id": ids[at[r]], "vector": bodies[at[r]], "ids": None})

    def nearest(ids: np.ndarray, q: np.ndarray, x: np.ndarray, members: list) -> list[tuple]:
        rows = []
        rough = (x * x).sum(axis=1)[None, :] - 2 * q @ x.T + (q * q).sum(axis=1)[:, None]
        for i in range(len(q)):
            near = np.arange(len(x))
            if len(x) > k + 1:
                # The rough distance may be off in its last digits; what could be within the exact k + 1 stays.
                bound = np.partition(rough[i], k)[k]
                near = np.nonzero(rough[i] <= bound + 1e-9 * (1 + abs(bound) + (q[i] * q[i]).sum() + rough[i].max(initial=0)))[0]
            exact = np.sqrt(((x[near] - q[i]) ** 2).sum(axis=1))
            pairs = sorted((d, m) for d, j in zip(exact.tolist(), near.tolist()) for m in members[j] if m != ids[i])
            rows += [(int(ids[i]), m, d) for d, m in pairs[:k]]
        return rows

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, ids, asked = None, [], []
        for frame in frames:
            rows = []
            values, side = frame[["cell", "block"]].to_numpy(), frame["side"].to_numpy()
            cuts = np.r_[0, np.nonzero((values[1:] != values[:-1]).any(axis=1) | (side[1:] != side[:-1]))[0] + 1, len(frame)]
            for a, b in zip(cuts, cuts[1:]):
                part = frame.iloc[a:b]
                if tuple(values[a]) != cell:
                    cell, ids, asked = tuple(values[a]), [], []
                if side[a] == 0:
                    ids.append(part["id"].to_numpy())
                    asked.append(matrix(part["vector"]))
                elif ids:
                    who, q = np.concatenate(ids), np.concatenate(asked)
                    for c in range(0, len(part), CHUNK):
                        piece = part.iloc[c : c + CHUNK]
                        rows += nearest(who, q, matrix(piece["vector"]), piece["ids"].tolist())
            yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    dealt = classes.mapInPandas(deal, schema).unionByName(queries.mapInPandas(ask, schema))
    return dealt.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "side").mapInPandas(compare, "query_id long, vec_id long, score double")


def nearest_neighbours(embeddings: DataFrame, k: int = 10, every: int = 100, tables: int = TABLES, probes: int = PROBES, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the k nearest others that are found.

    score is the Euclidean distance of the original vectors in double precision; ties go to the smaller id. `probes` cells of each table, or as many
    more as RECALL takes on a sample, are compared; where that is every cell, one table does, and the result is exact. A query that finds
    fewer than k though there are more is compared with every cell. Vectors that are null, zero, hold null or non-finite
    components, or have not the most frequent length, and rows without an id take no part. Equal vectors are one class, so
    large groups of copies cost one row. Of rows that repeat an id the nearest counts. Empty tables give no rows.
    """
    vector = F.col(vector_column).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    vectors = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector")).where(F.col("vec_id").isNotNull() & F.coalesce(sound.alias("s"), F.lit(False)))
    lengths = vectors.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = lengths["n"] if lengths else 1
    vectors = vectors.where(F.size("vector") == width)
    classes = materialize(_classes(vectors, k), "classes")
    count = classes.count()
    queries = vectors.where(F.col("vec_id") % every == 0)
    probes = _probes_for(queries, classes, width, count, k, tables, probes)
    if probes >= Polytopes(width, count, 0).cells:
        tables = 1
    found = materialize(_search(queries, classes, width, count, k, tables, probes).groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), "found")
    others = vectors.select("vec_id").distinct().count() - 1
    short = queries.select("vec_id").distinct().join(found.groupBy(F.col("query_id").alias("vec_id")).count(), "vec_id", "left").where(F.coalesce("count", F.lit(0)) < min(k, others))
    names = materialize(short.select("vec_id"), "short")
    if names.limit(1).count():
        rest = _search(queries.join(names, "vec_id", "left_semi"), classes, width, count, k, 1, None)
        found = found.unionByName(rest).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
