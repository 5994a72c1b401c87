"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import (
    chat_windows,
    chunk_dedup,
    collocations,
    importance,
    mixing,
    pieces,
    quality_classifier,
    quality_rules,
    simhash_links,
    token_files,
    toxicity,
    url_filter,
    weighted_sampling,
)
from kerbside.llm.common import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op2_weighted_fingerprints(spark, sf_dir):
    return weighted_sampling.fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op3_url_filter(spark, sf_dir):
    rules = url_filter.rules_frame(spark, URL_RULES)
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op5_sentencepiece(spark, sf_dir):
    return pieces.piece_digests(table(spark, sf_dir, "documents"), model=tokenizer("piece_bpe_32k.model"))


@query
def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model)


@query
def op7_token_files(spark, sf_dir):
    return token_files.token_digests(
        table(spark, sf_dir, "documents"), tokenizer=tokenizer("word_bpe_49k.json")
    )


@query
def op8_chunk_dedup(spark, sf_dir):
    return chunk_dedup.repeat_report(table(spark, sf_dir, "documents"))


@query
def op10_simhash_groups(spark, sf_dir):
    return simhash_links.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_importance_resampling(spark, sf_dir):
    return importance.resampling_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op12_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_chat_windows(spark, sf_dir):
    """All conversations, and one more whose texts look like marks of the template."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], own.schema)
    windows = chat_windows.chat_windows(own.unionByName(more), model=tokenizer("piece_bpe_32k.model"))
    return chat_windows.conversation_digests(windows)
