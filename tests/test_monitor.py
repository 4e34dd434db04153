"""Monitors of live metrics, the largest total of a mixture, and what is registered."""

import datetime as dt
import json
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sparkmill import catalog, plans  # noqa: F401
from sparkmill.operators import policy, reports
from sparkmill.sources import readers
from sparkmill.streaming import jobs

START = dt.datetime(2024, 1, 1)


def collected(rows, path):
    run = rows.writeStream.outputMode("append").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/out/b={n}"))
    run.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def test_monitor_tells_of_pauses_once(spark, tmp_path):
    at = lambda m: START + dt.timedelta(minutes=m)
    rows = [("a", at(m), "metric", 100.0) for m in [*range(0, 30), *range(50, 60)]]  # a pause of 21 minutes
    rows += [("a", at(m), "metric", 1.0) for m in range(60, 90)] + [("a", at(m), "metric", 100.0) for m in range(90, 130)]  # slow, then well
    rows += [("a", at(m), "checkpoint", None) for m in (5, 40, 125)]
    rows += [("b", at(m), "metric", 5.0) for m in range(0, 20)]  # silent from here on
    rows += [("c", at(m), "metric", 5.0) for m in range(0, 400)]
    schema = "run string, ts timestamp, kind string, value double"
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[1]), schema)
    for lo, hi in ((0, 45), (45, 131), (131, 300), (300, 401)):
        df.where((F.col("ts") >= F.lit(at(lo))) & (F.col("ts") < F.lit(at(hi)))).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    collected(jobs.run_monitor(stream, stale_ms=600_000, checkpoint_ms=3_600_000), tmp_path)
    got = sorted((r.run, r.issue, round((r.at_ms / 1000 - START.replace(tzinfo=dt.UTC).timestamp()) / 60)) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert [x for x in got if x[0] == "a"] == [("a", "checkpoint_stale", 100), ("a", "checkpoint_stale", 185), ("a", "low_throughput", 73), ("a", "no_metric", 39), ("a", "no_metric", 139)]
    assert [x for x in got if x[0] == "b"] == [("b", "checkpoint_stale", 60), ("b", "no_metric", 29)]
    assert [x for x in got if x[0] == "c"] == [("c", "checkpoint_stale", 60)]


def test_windows_close_and_late_rows_stay_aside(spark, tmp_path):
    r = random.Random(1)
    files, order = [], []
    for k in range(6):
        own = [(f"r{r.randrange(3)}", START + dt.timedelta(hours=k, minutes=r.randrange(60)), r.random()) for _ in range(50)]
        own += [("r0", START + dt.timedelta(minutes=r.randrange(50)), 1.0)] * (3 if k == 5 else 0)  # long after its window
        files.append(own)
    for k, own in enumerate(files):
        lines = [json.dumps({"run": a, "ts": str(t), "value": v}) for a, t, v in own] + ['{"run": "r1", "ts"', "[1, 2]", '{"value": 3}'] * (k % 2)
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{tmp_path}/in")
        jobs.stream_windows(spark, f"{tmp_path}/in", f"{tmp_path}/state")
        order += own
    got = {(x.start, x.run): (x.n, round(x.mean, 9)) for x in spark.read.parquet(f"{tmp_path}/state/windows").collect()}
    want = {}
    for k, own in enumerate(files):
        for a, t, v in own:
            if not (k == 5 and t < START + dt.timedelta(hours=1)):
                want.setdefault((t.replace(minute=0), a), []).append(v)
    mark = max(t for _, t, _ in order) - dt.timedelta(hours=2)
    want = {k: (len(v), round(sum(v) / len(v), 9)) for k, v in want.items() if k[0] + dt.timedelta(hours=1) <= mark}
    assert got == want and got
    report = {x.kind: x.rows for x in jobs.window_report(spark, f"{tmp_path}/state").collect()}
    assert report == {"closed": sum(n for n, _ in want.values()), "late": 3, "broken": 9}


def plain_total(supply, fractions):
    def fits(total):
        own = {k: Fraction(total) * f for k, f in fractions.items()}
        quota = {k: math.floor(x) for k, x in own.items()}
        rest = sorted(own, key=lambda k: (-(own[k] - quota[k]), -fractions[k], k))
        for k in rest[: total - sum(quota.values())]:
            quota[k] += 1
        return all(quota[k] <= supply[k] for k in supply)

    total = min(math.floor(supply[k] / f) for k, f in fractions.items())
    while total and not fits(total):
        total -= 1
    while fits(total + 1):
        total += 1
    return total


@pytest.mark.parametrize("seed", range(3))
def test_largest_total(spark, seed):
    r = random.Random(seed)
    parts = [r.choice([1, 2, 5, 10]) for _ in range(6)]
    size = 2 ** (sum(parts) - 1).bit_length()
    parts[0] += size - sum(parts)  # eighths and the like, exact as doubles
    fractions = {f"s{k}": Fraction(p, size) for k, p in enumerate(parts)}
    supply = {k: r.randrange(3, 400) for k in fractions}
    rows = spark.createDataFrame([(k, supply[k], float(f)) for k, f in fractions.items()], "source string, s long, f double")
    assert policy.max_unique_total(rows, "source", "s", "f").first().total == plain_total(supply, fractions)


def test_names_are_taken_once():
    with pytest.raises(ValueError, match="two queries"):
        catalog.query("a01_drop_counters")(lambda spark, sf: None)


def test_json_lines_that_hold_no_object_are_kept_aside(spark, tmp_path):
    spark.createDataFrame([(x,) for x in ['{"a": 1}', "[1, 2]", '{"a": ', "7", '"x"', "", '  {"a": 2}']], "value string").coalesce(1).write.text(f"{tmp_path}/x")
    got = sorted(((r.a, r._corrupt_record) for r in readers.read_jsonl(spark, [f"{tmp_path}/x"], "a long").collect()), key=repr)
    assert got == sorted([(1, None), (2, None), (None, "[1, 2]"), (None, '{"a": '), (None, "7"), (None, '"x"')], key=repr)


def test_two_reports_of_a_step_are_an_error(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.7)], "step long, value double")
    b = spark.createDataFrame([(2, 3.0), (3, 4.0)], "step long, value double")
    assert sorted(tuple(r) for r in reports.trajectory({"a": a, "b": b}).where("step > 1").collect()) == [(2, 0.7, 3.0), (3, None, 4.0)]
    with pytest.raises(Exception, match="two rows of step 2"):
        reports.trajectory({"a": a, "b": b.union(b)}).collect()
