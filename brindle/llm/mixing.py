"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents, permuted pseudorandomly, form one stream of words that is cut into equal blocks and repeats when it
ends. A source's quota is a number of blocks. The quotas are split exactly and recursively among the output shards: at each
node the left half of the shards gets a multivariate-hypergeometric draw of the node's blocks. A shard then has, of each
source, its own range of the permuted blocks, so documents stay whole but at its ends, and shuffles its rows locally.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from .storage import materialize
from .text import WORD, released, squeezed

#: Blocks of a source at most; the words taken of a source are within half a block of its target.
BLOCKS = 4096
#: Rows of a range of a source's hashed order; ranges are ranked apart.
RANGE = 20_000
#: Shards at least and at most, and words of a shard from which there are more.
SHARDS, MOST_SHARDS, SHARD_WORDS = 64, 4096, 100_000_000
#: Numbers (8 bytes: an edge for each source and shard, and a few more) up to which the sources' plan is broadcast; beyond it the join shuffles.
MOST_NUMBERS = 1 << 22


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Words for each source: the total by weight, at most `most` times a size; the excess goes to the others by weight, until none is above."""
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        whole = sum(weights[i] for i in open_)
        above = [i for i in sorted(open_) if left * weights[i] / whole > most * sizes[i]]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / whole
            break
        for i in above:
            out[i] = most * float(sizes[i])
        open_ -= set(above)
        left -= sum(out[i] for i in above)
    return out


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources) blocks: column sums are the quotas, row sums differ by at most one."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    total = int(sum(quotas))
    room = [total // shards + (j < total % shards) for j in range(shards)]

    def node(first: int, last: int, have: np.ndarray) -> None:
        if last - first == 1:
            out[first] = have
            return
        middle = (first + last) // 2
        rng = np.random.default_rng((seed, first, last))
        left = rng.multivariate_hypergeometric(have, sum(room[first:middle]), method="marginals") if have.sum() else have
        node(first, middle, left)
        node(middle, last, have - left)

    node(0, shards, np.array(quotas, dtype=np.int64))
    return out


def measure(docs: DataFrame, *more: str, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """(doc_id, source, size, mark) of each row, and the columns named in more: size is the number of words of its whole text, 0 for null; mark tells texts of one id apart."""
    text = F.col(text_column).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).cast("string").alias("source"), size.alias("size"), F.xxhash64(text).alias("mark"), *more)


def _plan(spark: SparkSession, rows: list, weights: tuple[float, ...], shards: int, seed: int) -> DataFrame:
    """One row for each source, in code point order, null last: source_size, target, and edges, the ends of the shards' ranges of its stream."""
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["source_size"]) for r in rows]
    target = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))])
    block = [max(1, -(-s // BLOCKS)) for s in sizes]
    split = split_quotas([round(t / b) for t, b in zip(target, block)], shards, seed)
    ends = np.cumsum(split, axis=0)
    facts = [(r["name"], s, t, [min(int(e) * b, 3 * s) for e in ends[:, i]]) for i, (r, s, t, b) in enumerate(zip(rows, sizes, target, block))]
    return spark.createDataFrame(facts, "name string, source_size long, target double, edges array<long>")


def shards_of(words: int) -> int:
    return min(MOST_SHARDS, max(SHARDS, words // SHARD_WORDS))


def _ranked(named: DataFrame, rows: int, seed: int) -> DataFrame:
    """named with start: the words before a row in its source's pseudorandom order. Rows are ranked in ranges of about RANGE rows, so no task has a whole source."""
    ranges = 1 << max(4, (rows // RANGE).bit_length())
    dealt = named.withColumn("order", F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))).withColumn("range", F.pmod(F.shiftright("order", 20), F.lit(ranges)))
    sums = dealt.groupBy("name", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("name", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("name", "range").orderBy("order", "doc_id", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    # Both sides are dealt out by name and range, so the rows are not shuffled again.
    return ranked.join(base, ["name", "range"]).withColumn("start", F.col("base") + F.col("inside")).drop("range", "order", "inside", "base", "mark")


def mix_sources(measured: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), shards: int | None = None, seed: int = 11) -> DataFrame:
    """measured (doc_id, source, size, mark, others) with source_size, target, and draws: array of (shard, place, first, length), without mark.

    A draw is a run of words that a shard takes of a document; place is its position in the shard's local shuffle. target
    is the words that the row's source shall give: shares of all words by weight, weights repeating over the sources in
    code point order, null last, none above three times its size. A source gives its target to within half a block.
    shards None: SHARDS, and one for each SHARD_WORDS words beyond, at most MOST_SHARDS.

    The driver holds one row of numbers for each source, never documents. Rows without words have no draws; a null source is
    a source; rows that repeat an id count each; an empty table gives no rows. Reruns give the same draws.
    """
    spark = measured.sparkSession
    # A null source has a name of its own, so that plain equality joins it.
    named = measured.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    sizes = named.groupBy("name", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).collect()
    if shards is None:
        shards = shards_of(sum(r["source_size"] for r in sizes))
    facts = _plan(spark, sizes, weights, shards, seed)
    if len(sizes) * (shards + 4) <= MOST_NUMBERS:
        facts = F.broadcast(facts)
    known = _ranked(named, max((r["n"] for r in sizes), default=0), seed).join(facts, "name").drop("name")

    def drawn(turn: Column) -> Column:
        """The draws of a row's words at their turn: its source's stream repeats, and the row lies there from `at` on."""
        at = turn * F.col("source_size") + F.col("start")
        first = F.size(F.filter("edges", lambda e: e <= at))
        last = F.size(F.filter("edges", lambda e: e < at + F.col("size")))

        def draw(shard: Column) -> Column:
            low = F.greatest(at, F.when(shard == 0, F.lit(0).cast("long")).otherwise(F.get("edges", shard - 1)))
            length = F.least(F.get("edges", shard), at + F.col("size")) - low
            return F.struct(shard.alias("shard"), F.xxhash64("doc_id", turn, low, F.lit(seed)).alias("place"), (low - at).alias("first"), length.alias("length"))

        found = F.filter(F.transform(F.sequence(first, F.least(last, F.lit(shards - 1))), draw), lambda d: d["length"] > 0)
        return F.when((F.col("size") > 0) & (first < shards), found).otherwise(F.array().cast("array<struct<shard:int,place:bigint,first:bigint,length:bigint>>"))

    turns = F.concat(*[drawn(F.lit(t)) for t in range(3)])
    return known.withColumn("draws", turns).drop("edges", "start")


def mixture_report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, draws) of every row: taken is the words that the mixture takes of it, repeats counted."""
    mixed = mix_sources(materialize(measure(docs), "sizes"), **options)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["length"])
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.size("draws").cast("long").alias("draws"))


@F.pandas_udf(StringType())
def _cut(z: pd.Series, size: pd.Series, first: pd.Series, length: pd.Series) -> pd.Series:
    """`length` words of squeezed texts from word `first` on; the whole text, if these are all of its words."""
    out = []
    for text, n, a, k in zip(released(z), size, first, length):
        out.append((text if k == n else b" ".join(text.split()[a : a + k])).decode("utf-8", "surrogatepass"))
    return pd.Series(out, dtype=object)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as rows of docs (doc_id, text, source and others), one for each draw; text is cut to the words drawn.

    Each shard is a partition, in the order of its places. Texts pass two shuffles, squeezed: to the range where their row is
    ranked, and to their shards. Each row keeps its own text: null and repeated ids are rows like others. Rows without words
    are in no draw.
    """
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    slim = docs.select("doc_id", "text", "source", squeezed(F.col("text").cast("string")).alias("z"), F.struct(F.lit(0).alias("_"), *own).alias("rest"))
    measured = materialize(measure(slim, "z", "rest"), "sizes")
    shards = options.pop("shards", None) or shards_of(measured.agg(F.sum("size")).first()[0] or 0)
    mixed = mix_sources(measured, shards=shards, **options).select("doc_id", "size", "z", "rest", F.explode_outer("draws").alias("draw")).where("draw IS NOT NULL")
    dealt = mixed.repartitionById(shards, F.col("draw.shard")).sortWithinPartitions("draw.place")
    values = {"doc_id": F.col("doc_id"), "text": _cut("z", "size", "draw.first", "draw.length")}
    return dealt.select(*[values.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])
