"""What a task's Python holds at once: batches come by rows, so kernels cut them by bytes of text."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

import corpus_pipeline
from sparkmill.llm import common, near_copies, substring


def texts(n, n_words=400, seed=5):
    word = np.random.default_rng(seed).integers(0, 5000, (n, n_words))
    return pa.array([" ".join(f"w{x}" for x in row) for row in word.tolist()])


def peak(work):
    """MB that `work` holds at most beyond what was there, and its result."""
    tracemalloc.start()
    try:
        out = work()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_verified_pairs_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(near_copies, "map_arrow", lambda df, schema, run: run)
    run = near_copies.verified(None, 5, 0.8)
    t = texts(3000)
    other = pa.concat_arrays([t[:1000], t[1001:], t[:1]])  # the first thousand are pairs of equal texts
    batch = pa.record_batch({"a": pa.array(range(3000)), "b": pa.array(range(3000)), "ta": t, "tb": other})
    mb, out = peak(lambda: [x] if isinstance(x := run(batch), dict) else list(x))
    assert [k for x in out for k in x["a"].to_pylist()] == list(range(1000)) == [k for x in out for k in x["b"].to_pylist()]
    assert mb < 50


def test_names_of_windows_are_cut_by_bytes():
    held, rows, tasks = [], [], []

    def occurrences(part):
        mb, out = peak(lambda: substring._revealing(part))
        held.append(mb)
        rows.append(len(part))
        return out

    class Frame:
        sparkSession = SimpleNamespace(conf=SimpleNamespace(get=lambda key: "4"))
        repartition = sortWithinPartitions = lambda self, *by: self

        def mapInArrow(self, run, schema):
            tasks.append(run)
            return self

    substring.deal(Frame(), occurrences, False, 64)
    batch = pa.record_batch({"rid": pa.array(range(3000)), "tie": pa.array([0] * 3000), "text": texts(3000)})
    sent = list(tasks[0](iter([batch])))
    assert sent and sum(rows) == 3000
    assert max(held) < 60


def test_rows_are_mapped_by_bytes():
    frame = SimpleNamespace(drop=lambda *a: SimpleNamespace(schema=None), mapInArrow=lambda run, schema: run)
    seen = []
    run = common.map_rows(frame, lambda b: seen.append(b.column("text").nbytes) or b)
    t = pa.concat_arrays([texts(5000), pa.array([None, "", "x" * (6 << 20)])])
    out = pa.Table.from_batches(run(iter([pa.record_batch({"text": t})])))
    assert out["text"].to_pylist() == t.to_pylist()
    assert len(seen) > 2 and sum(x > common.SLICE * 1.1 for x in seen) == 1  # the one long text stays whole


def test_names_of_words_need_little_beside_them(monkeypatch):
    t = texts(1500)
    mb, words = peak(lambda: common.Words(t))
    assert mb < 45
    monkeypatch.setattr(common, "BLOCK", 1 << 9)  # names don't depend on the blocks
    long = pa.array(["a" * 2000 + " b", *t[:50].to_pylist()])
    few = common.Words(long).name
    monkeypatch.setattr(common, "BLOCK", 1 << 20)
    assert (common.Words(long).name == few).all()
    assert (common.Words(t).name == words.name).all()


def test_pipeline_sends_few_rows_at_a_time(spark):
    key, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.range(5000).selectExpr("id as doc_id", "'a text' as text").coalesce(1)
    before = spark.conf.get(key)
    try:
        for own, rows in ((10_000, corpus_pipeline.BATCH_ROWS), (0, corpus_pipeline.BATCH_ROWS), (7, 7)):
            spark.conf.set(key, own)
            stage = corpus_pipeline.in_small_batches(lambda spark, docs, sf_dir: docs.mapInArrow(lambda it: (pa.record_batch({"n": pa.array([len(b)])}) for b in it), "n long"))
            assert max(r.n for r in stage(spark, docs, "").collect()) == rows
    finally:
        spark.conf.set(key, before)
