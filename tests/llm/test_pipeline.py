"""Every stage of the corpus pipeline against a plain version of its decision, on its own input."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_operators import clashing, plain_components, plain_spans, prose, rows, table

import corpus_pipeline
from riskflow.llm import bpe, decontamination
from riskflow.llm.common import documents, materialize, parquet

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """name -> (rows in, rows out) on the small table, each stage's output stored for the next."""
    docs, out = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF), "test-stage")
        out[name] = (docs, after)
        docs = after
    return out


def by_id(df):
    return {r["doc_id"]: r for r in rows(df)}


def test_stages_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    columns = documents(spark, SF).columns
    assert all(stages[n][1].columns == columns for n, _ in corpus_pipeline.STAGES[:-1])


def test_language_keeps_documents_of_known_languages(stages):
    before, after = map(by_id, stages["language_id"])
    gone = [r for i, r in before.items() if i not in after]
    assert len(gone) <= 0.01 * len(before) and all(after[i] == before[i] for i in after)


def test_one_document_of_each_group_stays(stages):
    before, after = map(by_id, stages["near_duplicates"])
    ids = sorted(before)
    want = {ids[root] for _, root in plain_components([before[i]["text"] for i in ids], 80)}
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_documents_with_items_go(spark, stages):
    before, after = map(by_id, stages["decontamination"])
    items = [" ".join(decontamination.words(r["text"])) for r in rows(parquet(spark, SF, "benchmark"))]
    plain = {i for i, r in before.items() if any(f" {x} " in f" {' '.join(decontamination.words(r['text']))} " for x in items if x)}
    assert set(before) - set(after) == plain and plain


def test_personal_data_is_replaced_and_all_documents_stay(stages):
    before, after = map(by_id, stages["personal_data"])
    assert before.keys() == after.keys()
    spans = {i: plain_spans(r["text"]) for i, r in before.items()}
    assert any(spans.values())
    for i, r in after.items():
        if not spans[i]:
            assert r == before[i]
        else:
            assert not [s for s in plain_spans(r["text"]) if before[i]["text"].find(r["text"][s[0]:s[3]]) >= 0]
            assert r["n_chars"] == len(r["text"])


def test_tokens_of_the_last_stage(stages):
    import public_tokenizers as P
    import tiktoken

    before, after = map(by_id, stages["byte_bpe"])
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_vocabulary()[0]), special_tokens={})
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r["token_ids"] == enc.encode_ordinary(before[i]["text"]) and r["n_tokens"] == len(r["token_ids"])
        assert r["decoded_sha256"] == hashlib.sha256(before[i]["text"].encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF).orderBy("doc_id")) == rows(stages["byte_bpe"][1].orderBy("doc_id"))


def test_awkward_rows_pass_every_stage(spark):
    rng = random.Random(21)
    first = rows(documents(spark, SF).filter("lang = 'en'").limit(3))
    text = first[0]["text"]
    docs = clashing(table(spark, [text, text, None, "", "123", "漢字かな", (None, text + " " + prose(rng, 3)), (None, first[2]["text"]), (9, first[1]["text"] + " mail a@b.co"), (9, first[1]["text"] + " mail a@b.co")]))
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = materialize(stage(spark, docs, SF), "test-awkward")
        assert docs.columns == columns or name == "byte_bpe"
    # the near copy without an id goes, the other document without one stays
    assert sorted(str(r["doc_id"]) for r in rows(docs)) == ["0", "9", "None"]
    empty = documents(spark, SF).limit(0).withColumn("kept", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, SF), "test-empty")
        assert empty.count() == 0
