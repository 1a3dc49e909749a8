"""The pipeline's stages against brute-force versions, each on its own input, and the registered queries."""

import os

import corpus_pipeline
from linecross.llm import decontaminate, queries, substring_dedup
from tests.llm.test_operators import ascii_words, components, levenshtein_inside, removed

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [decontaminate.normal_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for n, (name, function) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        done = function(spark, docs, SF)
        after = done.collect()
        ids = {r.doc_id for r in after}
        if n < 4:
            assert done.columns == columns, name
        if n == 0:
            assert all(any(c.isalpha() for c in r.text or "") for r in after)
            assert len(after) >= 0.99 * len(before)
        elif n == 1:
            low = {i: c for i, _, c in components([(r.doc_id, r.text) for r in before])}
            assert ids == {r.doc_id for r in before if low[str(r.doc_id)] == r.doc_id} and len(after) == len(ids)
        elif n == 2:
            want = {i: (size, gone) for i, size, gone, _, _ in removed([(r.doc_id, r.text.encode()) for r in before])}
            for r in after:
                size, gone = want[str(r.doc_id)]
                assert size - gone - 6 <= len(r.text.encode()) <= size - gone and r.n_chars == len(r.text)
        elif n == 3:
            for r in before:
                words = decontaminate.normal_words(r.text)
                bag = set(words)
                leaked = any(sum(w in bag for w in own) >= len(own) - len(own) // 4 and levenshtein_inside(own, words) <= len(own) // 4 for own in items)
                assert leaked == (r.doc_id not in ids)
        else:
            assert {"token_ids", "decoded_text"} < set(done.columns) and len(after) == len(before)
            for r in after:
                assert r.decoded_text.count(" ") == max(0, len(r.token_ids) - 1) or not r.text.strip()
        docs = spark.createDataFrame(after, done.schema)


def test_repeated_passages_ask_few_files(spark, monkeypatch):
    """With many shards the stage's scan has 16 files of each of ten kinds at most, and cuts the same bytes."""
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 4_000)
    left, real = [], substring_dedup.delete_path
    monkeypatch.setattr(substring_dedup, "delete_path", lambda spark, folder: left.append(
        sum(os.path.isfile(f"{top}/{f}") for top in [folder.removeprefix("file://")] for f in os.listdir(top))) or real(spark, folder))
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    want = {i: (size, gone) for i, size, gone, _, _ in removed([(r.doc_id, r.text.encode()) for r in docs.collect()])}
    for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect():
        size, gone = want.pop(str(r.doc_id))
        assert size - gone - 6 <= len(r.text.encode()) <= size - gone and r.n_chars == len(r.text)
    assert not want and 0 < left[-1] <= 10 * 16


def test_run_keeps_rows_of_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 100 and ascii_words(got.first().text) is not None


def test_registered_names():
    assert len({name.split("_")[0] for name in queries.QUERIES}) == 13
