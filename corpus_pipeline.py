"""A pipeline that prepares training data from the ``documents`` table.

Each stage works on what its predecessor kept, written as Parquet and read
again. All stages but the last return the columns of ``documents``. A stage
deletes the intermediate tables of the one before, so write its result first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import chunk_dedup, mixing, pieces, quality_classifier, simhash_links
from kerbside.llm.common import WRITTEN, configure, drop_written
from kerbside.llm.queries import table, tokenizer
from kerbside.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# How many intermediate tables the stage before has written.
_held = 0


def stage(fn: Stage) -> Stage:
    """A stage of the pipeline. Its documents are what the stage before has written, so the
    intermediate tables of that stage are no longer read and go."""

    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _held
        upto, _held = _held, 0
        drop_written(configure(spark), upto)
        before = len(WRITTEN)
        out = fn(spark, docs, sf_dir)
        # What others wrote before stays: only this stage's own tables come first.
        WRITTEN[:] = WRITTEN[before:] + WRITTEN[:before]
        _held = len(WRITTEN) - before
        return out

    return run


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that SimHash links, the one with the least id."""
    return simhash_links.one_of_each(docs)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in an earlier document."""
    return chunk_dedup.remove_repeats(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(docs, mixing.mix(docs))


@stage
def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with the text that they decode to."""
    model = tokenizer("piece_bpe_32k.model")
    rows = pieces.encode(docs, model=model, keep=["doc_id", "lang", "source", "n_chars"])
    rows = pieces.decode(rows, model=model)
    n_pieces = (F.octet_length("ids") / 4).cast("long").alias("n_pieces")
    return rows.select(
        "doc_id", "lang", "source", "n_chars", n_pieces,
        pieces.id_array(F.col("ids")).alias("ids"),
        F.col("decoded").alias("text"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_and_decode),
]

# Classifiers and a merge-based vocabulary have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table of ``sf_dir``."""
    docs = table(configure(spark), sf_dir, "documents")
    root = shared_dir(spark, "pipeline")
    for number, (_, apply) in enumerate(STAGES):
        out = f"{root}/{number}"
        apply(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
