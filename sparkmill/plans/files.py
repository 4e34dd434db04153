"""Queries that write the given tables by a sink and read them back, streams over them, and the learned filter."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import text as T
from ..operators import candidates, dedup, filters as Q
from ..operators import learned, reports
from ..sources import readers, writers
from ..streaming import jobs


def docs(spark, sf):
    return table(spark, sf, "documents")


def place(spark, name):
    """A new folder in the shared one."""
    return f"{dedup.shared(spark)}/{name}-{uuid.uuid4().hex}"


@query("s02_read_jsonl", "SELECT doc_id, lang, length(text) AS n FROM documents")
def s02(spark, sf):
    docs(spark, sf).select("doc_id", "lang", "text").write.option("compression", "gzip").json(at := place(spark, "jsonl"))
    return readers.read_jsonl(spark, [at], "doc_id long, lang string, text string").where("_corrupt_record is null").select("doc_id", "lang", F.length("text").cast("long").alias("n"))


@query("s03_jsonl_read_stats", "SELECT count(*) AS lines, count(*) FILTER (WHERE doc_id % 5 <> 0) AS decoded, count(*) FILTER (WHERE doc_id % 5 = 0) AS decode_errors, count(*) FILTER (WHERE doc_id % 5 = 1) AS non_object, count(*) FILTER (WHERE doc_id % 5 = 2) AS missing_field, count(*) FILTER (WHERE doc_id % 5 = 3) AS empty, count(*) FILTER (WHERE doc_id % 5 = 4) AS yielded FROM documents")
def s03(spark, sf):
    line = F.expr("case doc_id % 5 when 0 then '{broken' when 1 then '[1, 2]' when 2 then to_json(struct(lang)) when 3 then '{\"text\": \" \"}' else to_json(struct(concat('t', text) as text)) end")
    docs(spark, sf).select(line.alias("value")).write.text(at := place(spark, "lines"))
    return readers.jsonl_stats(spark, [at])


@query("s10_read_wiki_dump", "SELECT doc_id AS id FROM documents WHERE doc_id % 10 > 2")
def s10(spark, sf):
    safe = F.regexp_replace("text", r"[<>&\x{00}-\x{08}\x{0b}-\x{1f}]", " ")
    page = F.concat(F.lit("<page><title>t</title><ns>"), F.when(F.col("doc_id") % 10 == 0, "1").otherwise("0"), F.lit("</ns><id>"), F.col("doc_id").cast("string"), F.lit("</id>"), F.when(F.col("doc_id") % 10 == 1, '<redirect title="x" />').otherwise(""), F.lit("<revision><id>7</id><timestamp>2024-01-01T00:00:00Z</timestamp><text>"), F.when(F.col("doc_id") % 10 == 2, "").otherwise(safe), F.lit("</text></revision></page>"))
    # A page is a record of the reader by its tag, so a dump is written page by page, in as many files as the table has.
    docs(spark, sf).select(page.alias("value")).write.text(at := place(spark, "wiki"))
    return readers.read_wiki_dump(spark, at).where("id % 10 <> 2").select("id")


@query("s12_read_code_files")
def s12(spark, sf):
    docs(spark, sf).select("text", F.col("source")).write.partitionBy("source").option("lineSep", "\r\n").option("maxRecordsPerFile", 10).text(at := place(spark, "code"))
    return readers.read_code_files(spark, at, [".txt"], ["source=src3"], 1_000_000, 20, source="source=([^/]+)/", budget=60_000).select(F.sha2("text", 256).alias("sha"), F.length("text").alias("n"))


@query("s15_read_parquet_hive_safe", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def s15(spark, sf):
    at = place(spark, "hive")
    docs(spark, sf).select("source", "doc_id").write.parquet(f"{at}/source=other")
    return readers.read_parquet_own_columns(spark, at).groupBy("source").agg(F.count("*").alias("n"))


@query("k01_write_clean", "SELECT source, CASE WHEN doc_id % 50 = 0 THEN 'val' ELSE 'train' END AS split, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ALL")
def k01(spark, sf):
    writers.write_clean(docs(spark, sf).withColumn("split", writers.split_of()), at := place(spark, "clean"))
    return spark.read.parquet(at).groupBy("source", "split").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("k02_publish_report", "SELECT count(*)::BIGINT AS rows, true AS hashed FROM documents")
def k02(spark, sf):
    writers.write_clean(docs(spark, sf).withColumn("split", writers.split_of()), at := place(spark, "clean"))
    return writers.inventory(spark, at).agg(F.sum("rows").alias("rows"), F.bool_and(F.length("sha256") == 64).alias("hashed"))


_BAD = "SELECT sha256(text) AS sha256, min(CASE WHEN n_chars < 500 THEN 'short' ELSE 'spanish' END) AS reason FROM documents WHERE n_chars < 500 OR lang = 'es' GROUP BY 1"


def bad(spark, sf):
    return docs(spark, sf).where("n_chars < 500 or lang = 'es'").select(F.sha2("text", 256).alias("sha256"), F.when(F.col("n_chars") < 500, "short").otherwise("spanish").alias("reason"))


@query("k03_write_exclusion_manifest", _BAD)
def k03(spark, sf):
    writers.write_exclusion_manifest(bad(spark, sf), at := place(spark, "exclusion"))
    return writers.read_exclusion_manifest(spark, at)


@query("k04_read_exclusion_manifest", "SELECT unnest(['sha256_form', 'reason_form', 'unique', 'few_reasons']) AS name, true AS passed")
def k04(spark, sf):
    writers.write_exclusion_manifest(bad(spark, sf), at := place(spark, "exclusion"))
    return writers.manifest_violations(writers.read_exclusion_manifest(spark, at))


@query("k05_write_token_table", r"WITH d AS (SELECT CASE WHEN doc_id % 50 = 0 THEN 'val' ELSE 'train' END AS split, sum(len(regexp_split_to_array(text, '\s+')) + 1)::BIGINT AS n FROM documents GROUP BY 1) SELECT split, i AS shard, least(4096, n - i * 4096) AS tokens FROM d, range(1000000) r(i) WHERE i * 4096 < n")
def k05(spark, sf):
    ids = F.concat(F.transform(F.split("text", r"\s+"), lambda w: (F.crc32(w.cast("binary")) % 50000).cast("int")), F.array(F.lit(0)))
    rows = docs(spark, sf).select("doc_id", writers.split_of().alias("split"), ids.alias("ids"))
    writers.token_shards(rows, "split", ["doc_id"], "ids", 4096).write.partitionBy("split").parquet(at := place(spark, "tokens"))
    return writers.shard_manifest(spark.read.parquet(at), "split")


@query("k06_write_jsonl", "SELECT item_id, text FROM benchmark")
def k06(spark, sf):
    writers.write_jsonl(table(spark, sf, "benchmark").select("text", "item_id"), at := place(spark, "jsonl"))
    return spark.read.schema("item_id long, text string").json(at)


# Streams.


@query("r01_stream_clean")
def r01(spark, sf):
    d = docs(spark, sf).select("doc_id", "text")
    d.write.parquet(at := place(spark, "incoming"))  # as many files, and so batches, as the table has
    jobs.stream_clean(spark, at, d.schema, state := place(spark, "state"))
    return spark.read.schema(jobs.ACCEPTED).parquet(f"{state}/accepted").select("doc_id", "sha")


@query("r02_stream_profile", "SELECT dimension, value, count(*) AS docs, sum(length(text))::BIGINT AS chars FROM (SELECT unnest(['lang', 'source']) AS dimension, unnest([lang, source]) AS value, text FROM documents) GROUP BY ALL")
def r02(spark, sf):
    d = docs(spark, sf)
    d.write.parquet(at := place(spark, "incoming"))  # as many files, and so batches, as the table has
    jobs.stream_profile(spark, at, d.schema, state := place(spark, "state"), ["lang", "source"]).awaitTermination()
    return jobs.merged_profile(spark, state)


def _stream(spark, sf, name, key):
    """The events as files by key and range of time, rows of a key in order within a file."""
    e = table(spark, sf, name)
    e.repartitionByRange(F.col(key), F.col("ts")).sortWithinPartitions(key, "ts").write.parquet(at := place(spark, "events"))
    return spark.readStream.schema(e.schema).parquet(at)


def _collected(spark, stream, mode):
    at = place(spark, "out")
    run = stream.writeStream.outputMode(mode).foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{at}/b={n}"))
    run.option("checkpointLocation", place(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(at)


def _last(out):
    """The table that the last batch of a stream in complete mode left."""
    return out.where(F.col("batch") == out.agg(F.max("batch")).first()[0]).drop("batch", "b")


@query("r03_stream_metrics_stats")
def r03(spark, sf):
    out = _collected(spark, jobs.rolling_mean(_stream(spark, sf, "events", "event_type")), "update")
    return out.groupBy("event_type").agg(F.max("seen").alias("seen"), F.max_by("rolling", "batch").alias("rolling"))


@query("r03_windowed_stats", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS lo, max(value) AS hi FROM events GROUP BY ALL")
def r03b(spark, sf):
    stream = _stream(spark, sf, "events", "event_type").withColumn("ts", F.col("ts").cast("timestamp"))
    return _last(_collected(spark, jobs.windowed_stats(stream), "complete")).withColumn("mean", F.round("mean", 6)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("r03_sessions", "WITH g AS (SELECT user_id, ts, value, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k")
def r03c(spark, sf):
    stream = _stream(spark, sf, "events", "user_id").withColumn("ts", F.col("ts").cast("timestamp"))
    s = _last(_collected(spark, jobs.sessions(stream), "complete"))
    return s.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"))


@query("r03_closed_windows")
def r03_closed(spark, sf):
    """Metric lines as a log has them, one in 97 broken: closed windows, late rows and broken lines, counted by kind."""
    e = table(spark, sf, "events")
    line = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit('{"run": '), F.col("event_id").cast("string"))).otherwise(F.to_json(F.struct(F.col("event_type").alias("run"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value")))
    e.repartitionByRange(F.col("ts")).sortWithinPartitions("ts").select(line.alias("value")).write.text(at := place(spark, "lines"))
    jobs.stream_windows(spark, at, state := place(spark, "state"))
    return jobs.window_report(spark, state)


@query("r04_run_monitor")
def r04_monitor(spark, sf):
    e = _stream(spark, sf, "events", "event_type").withColumn("ts", F.col("ts").cast("timestamp"))
    kind = F.when(F.col("event_id") % 50 == 0, "checkpoint").otherwise("metric")
    rows = e.select(F.col("event_type").alias("run"), "ts", kind.alias("kind"), F.col("value").cast("double").alias("value"))
    return _collected(spark, jobs.run_monitor(rows, stale_ms=600_000, checkpoint_ms=21_600_000), "append").drop("batch", "b")


@query("r05_edge_triggered_alert")
def r05(spark, sf):
    e = _stream(spark, sf, "events", "event_type").select(F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.when(F.col("value") > 150, "high").otherwise("").alias("issues"))
    return _collected(spark, jobs.edge_alerts(e), "append").drop("batch", "b")


@query("r04_stale_alert")
def r04(spark, sf):
    e = _stream(spark, sf, "events", "user_id").withColumn("ts", F.col("ts").cast("timestamp"))
    return _collected(spark, jobs.stale_alerts(e.withColumn("event_type", F.col("user_id").cast("string")), limit_ms=60_000), "append").drop("batch", "b")


# The learned quality filter.


def labelled(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").select("doc_id", "text", "lang", "quality")
    return learned.stratified_split(rows, "quality", F.sha2(F.concat(F.lit("q:"), F.col("doc_id").cast("string")), 256))


@query("l01_stratified_split", "SELECT doc_id, CASE WHEN p < 0.7 THEN 'train' WHEN p < 0.85 THEN 'valid' ELSE 'test' END AS part FROM (SELECT doc_id, percent_rank() OVER (PARTITION BY quality ORDER BY sha256('q:' || doc_id)) AS p FROM documents JOIN labels USING (doc_id))")
def l01(spark, sf):
    return labelled(spark, sf).select("doc_id", "part")


def model_of(spark, sf):
    rows = dedup.written(labelled(spark, sf), "labelled")
    return rows, learned.fit_quality(rows.where("part = 'train'"))


@query("l02_fit_quality_proxy")
def l02(spark, sf):
    rows, model = model_of(spark, sf)
    one = learned.score_quality(rows, model).groupBy("part").agg(*reports.confusion(F.col("quality"), F.col("score") >= 0.5))
    return one.select("part", *[F.round(c, 4).alias(n) for n, c in reports.classifier_metrics(*map(F.col, ("tp", "fp", "fn", "tn"))).items()])


@query("l03_score_quality")
def l03(spark, sf):
    _, model = model_of(spark, sf)
    return learned.score_quality(docs(spark, sf).select("doc_id", "text"), model).select("doc_id", F.round("score", 6).alias("score"))


@query("l04_quality_filter")
def l04(spark, sf):
    _, model = model_of(spark, sf)
    scored = learned.score_quality(docs(spark, sf).select("doc_id", "text", "source"), model)
    return scored.where(learned.keep(F.col("score"), F.col("source") != "src3", 0.3)).select("doc_id", F.when(F.col("score").isNotNull(), F.least(F.floor(F.col("score") * 10), F.lit(9))).alias("bucket"))


def candidates_of(spark, sf):
    """The documents but those of src5 as candidates, met with src5 as the earlier corpus, with the model's scores."""
    _, model = model_of(spark, sf)
    d = docs(spark, sf)
    every = dedup.written(candidates.admitted(d.where("source is distinct from 'src5'"), d.where("source = 'src5'"), "doc_id", "lang"), "admitted")
    return every, dedup.written(candidates.scored(every, model, 0.5), "scored")


@query("a09_scored_candidates")
def a09_scored(spark, sf):
    """The profile of candidates in full: drops, topics in documents and words, accepted ones, duplicates within, scores."""
    every, kept = candidates_of(spark, sf)
    return candidates.profile(every, kept, "doc_id", F.regexp_count("text", F.lit(r"\S+")))


@query("l05_topic_derivative")
def l05(spark, sf):
    """Candidates of the engineering, literature and mathematics topics; literature behind the precision gate."""
    _, kept = candidates_of(spark, sf)
    gates = {"literature_web": Q.topic_gate(F.col("text"), "(?i)(the|der|que) ", "(?i)(and|und|los) ")}
    rows = candidates.derivative(kept, ["stem_engineering", "literature_web", "math_calculation"], gates)
    return rows.where("reason = ''").select("doc_id", "source", "lang", "topic", "upstream_text_sha256", "document_sha256", "legacy_exact_overlap", "legacy_near_overlap", F.round("score", 4).alias("score"))


@query("l06_model_gate")
def l06(spark, sf):
    """Gates of the model that validation chose among several: its measures on the test rows, and the constraint it was chosen under."""
    rows = dedup.written(labelled(spark, sf), "labelled")
    model, _, held = learned.fit_path(rows.where("part = 'train'"), rows.where("part = 'valid'"))
    one = learned.score_quality(rows.where("part = 'test'"), model).agg(*reports.confusion(F.col("quality"), F.col("score") >= 0.5))
    m = reports.classifier_metrics(*map(F.col, ("tp", "fp", "fn", "tn")))
    return reports.checks(one, ("macro_f1", m["macro_f1"] >= 0.60), ("precision", m["precision"] >= 0.65), ("recall", m["recall"] >= 0.45), ("validation_precision", F.lit(held)))


@query("k02_text_hash_inventory", "SELECT lang, count(DISTINCT sha256(text)) AS texts FROM documents GROUP BY lang")
def k02b(spark, sf):
    return docs(spark, sf).select("lang", F.sha2(F.col("text"), 256).alias("h")).distinct().groupBy("lang").agg(F.count("*").alias("texts"))


@query("p10_variant_lookup", "SELECT event_id, json_extract_string(props, '$.page') IS NOT NULL AS has_page FROM events")
def p10b(spark, sf):
    v = F.try_variant_get(F.try_parse_json("props"), "$.page", "string")
    return table(spark, sf, "events").select("event_id", v.isNotNull().alias("has_page"))


@query("p09_license_nested", "SELECT doc_id, CASE WHEN lang IN ('de', 'en') THEN lang ELSE '' END AS license FROM documents")
def p09c(spark, sf):
    ids = T.license_ids("lang")
    return docs(spark, sf).select("doc_id", F.when(Q.license_ok(ids, ["de", "en"]), F.array_join(ids, " OR ")).otherwise("").alias("license"))
