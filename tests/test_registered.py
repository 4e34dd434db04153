"""Registered queries without SQL, run over small planted tables, against plain versions."""

import re
import unicodedata

import pytest

from sparkmill import catalog, plans  # noqa: F401
from sparkmill.operators import reports
from sparkmill.streaming import jobs


def test_feature_text(spark, tmp_path):
    rows = [(1, "Ｆｕｌｌ　width\t\tﬁne \n text"), (2, " a  b "), (3, ""), (4, "x" * 50_000 + "  y"), (4, "plain")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["p25_feature_text"](spark, str(tmp_path)).collect()
    want = [(k, re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t)).strip()) for k, t in rows]
    assert sorted((x.doc_id, x.text.strip()) for x in got) == sorted(want)


def test_conversation_segments(spark, tmp_path):
    long = " ".join(f"w{k}" for k in range(450))
    talks = {1: [("user", "hello there"), ("assistant", "good day to you"), ("user", "more"), ("assistant", "no")], 2: [("user", long), ("assistant", "one two")], 3: [("user", "alone")], 4: [("user", "q"), ("assistant", long)]}
    rows = [(c, t, role, text) for c, own in talks.items() for t, (role, text) in enumerate(own)]
    spark.createDataFrame(rows[::-1], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    want = {}
    for c, own in talks.items():
        last = max((k for k, (role, _) in enumerate(own) if role == "assistant"), default=None)
        marks = [(role == "assistant", k == last) for k, (role, text) in enumerate(own) for _ in f"<{role}> {text}".split()][-400:]
        if any(on for on, _ in marks):
            want[c] = (len(own), len(marks), sum(on for on, _ in marks), sum(pair for _, pair in marks))
    name = next(n for n in catalog.QUERIES if n.startswith("p30_"))
    got = {x.conv_id: (x.segments, x.tokens, x.supervised, x.supervised_in_pairs) for x in catalog.QUERIES[name](spark, str(tmp_path)).collect()}
    assert got == want and set(got) == {1, 2, 4}


def test_alerts_of_a_run_that_comes_in_many_frames(spark, tmp_path):
    rows = [("long", k, ["", "hot", "cold"][k // 4000 % 3]) for k in range(25_000)] + [("short", 1, "hot"), ("short", 2, None), ("short", 3, "hot")]
    schema = "run string, step long, issues string"
    spark.createDataFrame(rows[::-1], schema).repartition(5).write.parquet(f"{tmp_path}/in")
    own = jobs.edge_alerts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    query = own.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/marks").trigger(availableNow=True).start()
    assert query.awaitTermination(90)
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == [("long", 4000, "hot"), ("long", 8000, "cold"), ("long", 16000, "hot"), ("long", 20000, "cold"), ("short", 1, "hot"), ("short", 3, "hot")]


def test_rewards(spark):
    rows = [(0.5, 0.9, 0.4, 1.0, False, True, 0.5), (0.1, 0.3, 0.2, 0.0, False, False, 0.5), (0.0, 1.0, 0.0, 0.0, True, False, 0.0)]
    got = reports.rewards(spark.createDataFrame(rows, "loop double, distinct4 double, coherence double, responsive double, empty boolean, finished boolean, want double")).collect()
    want = [(1 - 0.5) + 0.4 + 0.5, (1 - 0.5) + 0.2 - 0.5, 1 + 0 - 1.5]
    assert [x.repetition for x in got] == pytest.approx([x.want for x in got]) and [x.reward for x in got] == pytest.approx(want)
