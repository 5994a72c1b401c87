"""Registered queries and the pipeline on the smallest tables."""

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from kerbside.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if not n.startswith(("op12", "op13"))])
def test_one_row_per_row_of_the_table(spark, name):
    table = "pages" if name.startswith("op3") else "documents"
    rows = queries.table(spark, SF_DIR, table).count()
    assert queries.QUERIES[name](spark, SF_DIR).count() == rows


def test_one_row_per_conversation_and_one_more(spark):
    rows = queries.table(spark, SF_DIR, "conversations").select("conv_id").distinct().count()
    assert queries.QUERIES["op13_chat_windows"](spark, SF_DIR).count() == rows + 1


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = queries.table(spark, SF_DIR, "documents")
    columns, counts = docs.columns, [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        counts.append(docs.count())
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[5] == counts[4] > 0
    made = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    for r in docs.collect():
        assert list(np.array(r.ids)) == made.encode(r.text) and r.n_pieces == len(r.ids)
    again = corpus_pipeline.run(spark, SF_DIR)
    key = lambda df: sorted((r.doc_id, r.text, tuple(r.ids)) for r in df.collect())
    assert key(again) == key(docs)
