"""A corpus pipeline: quality rules, near-duplicate removal, substring removal, mixing and packing, each over all that the last kept.

A stage's result is written before the next stage is called, so each stage begins by deleting the tables that the former ones left (unless its input is not written and still reads them).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.isolation import kept_documents
from brindle.llm.jaccard import ngram_jaccard_join
from brindle.llm.mixing import mixed_documents
from brindle.llm.packing import pack
from brindle.llm.queries import TOKENIZER
from brindle.llm.storage import materialize, scope, swept, table
from brindle.llm.substring import substring_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _whole(docs: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _stage(run: Callable) -> Callable:
    @wraps(run)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        swept(spark, "pipeline", unless=docs)
        with scope("pipeline"):
            return run(spark, docs, sf_dir)

    return stage


@_stage
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest, each row by its own text, also where ids are null or repeat. Null and empty texts fail the base rules."""
    return kept_documents(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of smallest doc_id. Rows without an id are dropped; those without words link with nothing and stay.

    Of rows that repeat an id one stays, that of the smallest text hash (then the smallest row), as each run gives it.
    """
    leaders = ngram_jaccard_join(docs, n=5, percent=80).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(leaders, "doc_id", "left_semi").select(*COLUMNS)
    return kept.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), *COLUMNS[1:])).alias("row")).select("doc_id", *[F.col(f"row.{c}") for c in COLUMNS[1:]])


@_stage
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words and more that a document of smaller doc_id has; documents without words left go, and rows without an id."""
    cut = substring_dedup(docs, length=13)
    return _whole(cut.where("n_words > n_removed"))


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the amounts of the source weights, as rows of the words that each draw takes; null and repeated ids are rows like others, rows without words are in no draw."""
    return _whole(mixed_documents(docs))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens; null texts are empty, null and repeated ids are packed like others."""
    return pack(docs, *TOKENIZER, capacity=1024)


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substrings),
    ("mixing sources", mixture),
    ("packing", packing),
]
#: Forests, draws and tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}", keep=True)
    return docs
