"""Sources: configured Parquet columns, JSON lines with counters, code files, wiki dumps, pages, file inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Field of a source descriptor -> column of the result.
FIELDS = {"id_column": "id", "text_column": "text", "title_column": "title", "url_column": "url", "license_column": "license", "language_column": "language", "source_column": "source", "timestamp_column": "timestamp", "score_column": "score"}
OPTIONAL = {"score_column", "source_column"}


def read_source(spark: SparkSession, paths: list[str], descriptor: dict[str, str]) -> DataFrame:
    """The configured columns of Parquet files, named alike. A configured column that is missing is an error, but for score and source."""
    df = spark.read.parquet(*paths)
    out = []
    for field, name in FIELDS.items():
        column = descriptor.get(field)
        if not column:
            continue
        if column.split(".")[0] in df.columns:
            out.append(F.col(column).alias(name))
        elif field not in OPTIONAL:
            raise ValueError(f"{field}: no column {column} in {paths}")
    return df.select(*out)


def read_text_column(df: DataFrame, names: tuple[str, ...] = ("text", "content")) -> DataFrame:
    """With the first of the named columns that exists as `text`."""
    found = next((n for n in names if n in df.columns), None)
    if found is None:
        raise ValueError(f"none of {names} in {df.columns}")
    return df.withColumnRenamed(found, "text")


def read_jsonl(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON lines (gzip by suffix); broken lines, and those that hold no object, are kept in _corrupt_record. Blank lines go."""
    line = F.regexp_replace("value", "^\ufeff", "")
    rows = spark.read.text(paths).select(line.alias("line")).where(T.strip("line") != "")
    parsed = F.from_json("line", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    own = F.when(T.strip("line").startswith("{"), parsed)
    rows = rows.select("line", own.alias("m")).select("line", "m.*")
    return rows.withColumn("_corrupt_record", F.when(T.strip("line").startswith("{"), F.col("_corrupt_record")).otherwise(F.col("line"))).drop("line")


def jsonl_stats(spark: SparkSession, paths: list[str], field: str = "text") -> DataFrame:
    """One row of counters: lines, decoded, decode_errors, non_object, missing_field, empty, yielded."""
    line = F.regexp_replace("value", "^﻿", "")
    rows = spark.read.text(paths).select(line.alias("line"), F.try_parse_json(line).alias("v"))
    blank = T.strip("line") == ""
    is_object = F.schema_of_variant("v").startswith("OBJECT")
    value = F.try_variant_get("v", f"$.{field}", "string")
    kind = F.when(blank, "blank").when(F.col("v").isNull(), "decode_errors").when(~is_object, "non_object").when(value.isNull(), "missing_field").when(T.strip(value) == "", "empty").otherwise("yielded")
    k = rows.select(kind.alias("k"))
    n = lambda *names: F.count_if(F.col("k").isin(*names))
    return k.agg(n("decode_errors", "non_object", "missing_field", "empty", "yielded").alias("lines"), n("non_object", "missing_field", "empty", "yielded").alias("decoded"), *[n(c).alias(c) for c in ("decode_errors", "non_object", "missing_field", "empty", "yielded")])


def checked(stats: DataFrame, most_errors: int) -> DataFrame:
    """The counters; a job that uses them fails if there are more errors than allowed."""
    errors = F.col("decode_errors") + F.col("non_object")
    return stats.withColumn("lines", F.when(errors > most_errors, F.raise_error(F.lit("too many broken lines")).cast("long")).otherwise(F.col("lines")))


def prefer_plain(files: DataFrame) -> DataFrame:
    """Of each family its plain files, or all of it if there are none."""
    best = F.max(F.col("plain").cast("int")).over(Window.partitionBy("family"))
    return files.withColumn("__best", best).where(F.col("plain") | (F.col("__best") == 0)).drop("__best")


def file_family(path: Column) -> Column:
    """The path without resharding marks."""
    return F.regexp_replace(path, r"\.(reshard|src)[^/.]*(?=\.)", "")


def read_wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """Articles of an XML dump (bz2 by suffix): namespace 0, no redirects, with the page's and revision's ids."""
    schema = "title string, ns int, id long, redirect struct<_title: string>, revision struct<id: long, timestamp: string, text: string>"
    # The parser that looks for the tag: it takes splits of a large dump, with or without a root around the pages.
    pages = spark.read.format("xml").option("rowTag", "page").option("useLegacyXMLParser", "true").schema(schema).load(path)
    return pages.where("ns = 0 and redirect is null").select("id", "title", F.col("revision.id").alias("revision_id"), F.col("revision.timestamp").alias("timestamp"), F.col("revision.text").alias("text"))


def html_text(html: Column) -> Column:
    """Text of markup: scripts, styles, comments and tags out, blocks as lines, entities of the five basic characters."""
    x = F.regexp_replace(html, r"(?is)<(script|style|head|nav|footer)\b.*?</\1\s*>|<!--.*?-->", "")
    x = F.regexp_replace(x, r"(?i)<(br|/p|/h[1-6]|/li|/div|/tr)\b[^>]*>", "\n")
    x = F.regexp_replace(x, r"<[^>]*>", "")
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(plain))
    return T.strip(F.regexp_replace(F.array_join(F.transform(T.lines(x), T.strip), "\n"), "\n{3,}", "\n\n"))


def pages_to_documents(pages: DataFrame) -> DataFrame:
    """(page_id, text, raw_sha256, text_sha256, reason) of web pages; pages without text have the reason `empty`."""
    rows = pages.select("page_id", F.sha2("html", 256).alias("raw_sha256"), html_text(F.col("html")).alias("text"))
    return rows.select("page_id", "text", "raw_sha256", F.sha2("text", 256).alias("text_sha256"), F.when(F.col("text") == "", "empty").otherwise("").alias("reason"))


def read_code_files(spark: SparkSession, root: str, suffixes: list[str], exclude: list[str], most_bytes: int, min_chars: int, source: str = "", budget: int | None = None) -> DataFrame:
    """(path, text) of code files by suffix and excluded path parts: valid UTF-8 without NUL, within bounds, LF line ends, the
    first of equal ones by path. budget: UTF-8 bytes of each source (the first group of the pattern `source` in the path);
    files are taken in order of their paths, and one that doesn't fit any more is skipped and doesn't count as seen."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    keep = F.col("path").rlike("(" + "|".join(f"\\Q{s}\\E" for s in suffixes) + ")$") & (F.col("length") <= most_bytes)
    for part in exclude:
        keep = keep & ~F.col("path").contains(part)
    rows = files.where(keep & F.is_valid_utf8(F.col("content").cast("string"))).select("path", F.regexp_replace(F.col("content").cast("string"), "\r\n?", "\n").alias("text"))
    rows = rows.where(~F.col("text").contains("\0") & (F.length("text") >= min_chars)).withColumn("sha", F.sha2("text", 256))
    if budget is not None:
        own = rows.select("path", F.regexp_extract("path", source, 1).alias("source"), "sha", F.octet_length("text").cast("long").alias("bytes"))
        least = first_within_budget(own, "source", "path", "sha", "bytes", budget)
        return rows.join(least, "path", "left_semi").select("path", "text")
    least = rows.groupBy("sha").agg(F.min("path").alias("path"))
    return rows.join(least, ["sha", "path"], "left_semi").select("path", "text")


def first_within_budget(files: DataFrame, source: str, order: str, sha: str, size: str, budget: int) -> DataFrame:
    """(order) of the files kept when they come in order, an equal one kept before bars a file, and each source has a budget.

    Of equal files of one source only the first counts: what didn't fit at it doesn't fit later. Whether a file is barred
    depends on earlier ones only, so from "all but the first of equal files are barred" on, each round of budgets corrects
    the bars of the next until they stay; every round settles one more step of what depends on other sources."""
    from ..operators import dedup, windows

    own = files.groupBy(F.col(source).alias("source"), F.col(sha).alias("sha"), F.col(size).alias("bytes")).agg(F.min(order).alias("place"))
    own = dedup.written(own, "files")
    seen = own.groupBy("sha").agg(F.min("place").alias("seen"))
    before = None
    while True:
        rows = dedup.written(own.join(seen, "sha", "left").withColumn("barred", F.coalesce(F.col("place") > F.col("seen"), F.lit(False))), "barred")
        if before is not None and rows.select("place", "barred").exceptAll(before.select("place", "barred")).isEmpty():
            return kept.select(F.col("place").alias(order))
        kept = dedup.written(windows.fitting(rows.where("not barred"), "source", "place", "bytes", budget), "kept")
        seen = own.join(kept, ["source", "place"], "left_semi").groupBy("sha").agg(F.min("place").alias("seen"))
        before = rows


def read_parquet_own_columns(spark: SparkSession, path: str) -> DataFrame:
    """A folder of files whose own columns count, though folders are named like `source=x`."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def text_assets(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(asset, sha256, rows) of a folder's text files: the name by a pattern of the path, the digest of the bytes, lines
    that aren't blank."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(root)
    lines = F.split(F.decode("content", "UTF-8"), "\n")
    return files.select(F.regexp_extract("path", name, 1).alias("asset"), F.sha2("content", 256).alias("sha256"), F.size(F.filter(lines, lambda x: T.strip(x) != "")).cast("long").alias("rows"))


def read_benchmark_tables(spark: SparkSession, csv: list[str], parquet: list[str]) -> DataFrame:
    """(id, subject, split, question, choices, answer) of question tables in CSV and Parquet. Columns are found in any case
    of letters; split and subject come from the path; blank choices are left out; an answer that is none of A to D is ''."""
    out = None
    tables = [spark.read.option("header", True).option("escape", '"').option("recursiveFileLookup", True).csv(csv)] if csv else []
    tables += [spark.read.option("recursiveFileLookup", True).parquet(*parquet)] if parquet else []
    for df in tables:
        have = {c.lower(): c for c in df.columns}
        pick = lambda c, have=have: T.strip(F.coalesce(F.col(have[c]).cast("string"), F.lit(""))) if c in have else F.lit("")
        path = F.col("_metadata.file_path")
        letters = F.array(*[F.struct(F.lit(k.upper()).alias("k"), pick(k).alias("v")) for k in "abcd"])
        answer = F.upper(pick("answer"))
        own = df.select(
            pick("id").alias("id"),
            F.regexp_extract(path, r"(?i)/(?:subject=)?([^/]+)/(?:split=)?(?:dev|val|test)/", 1).alias("subject"),
            F.lower(F.regexp_extract(path, r"(?i)/(?:split=)?(dev|val|test)/", 1)).alias("split"),
            pick("question").alias("question"),
            F.map_from_entries(F.filter(letters, lambda c: c["v"] != "")).alias("choices"),
            F.when(answer.isin(*"ABCD"), answer).otherwise("").alias("answer"),
        ).where("question <> ''")
        out = own if out is None else out.unionByName(own)
    return out


#: Names of files beside the data.
BESIDE = r"(?i)(?:^|[/_.-])(?:manifest|report|stats|index)(?:[_.-][^/]*)?\.json"


def list_inputs(files: DataFrame, path: str = "path") -> DataFrame:
    """The JSON and JSON-lines files of a listing, without manifests, reports, statistics and indexes beside them."""
    return files.where(F.col(path).rlike(r"(?i)\.jsonl?(?:\.gz|\.zst)?$") & ~F.col(path).rlike(BESIDE))


def paired(files: DataFrame, key: str, role: str, roles: list[str], n: int | None = None) -> DataFrame:
    """(key) of shards that have each role exactly once; n: so many of them, evenly spaced in their order."""
    from ..operators import windows

    have = files.where(F.col(role).isin(roles)).groupBy(key).agg(F.count("*").alias("__n"), F.countDistinct(role).alias("__r"))
    whole = have.where((F.col("__n") == len(roles)) & (F.col("__r") == len(roles))).select(key)
    return whole if n is None else windows.evenly_spaced(whole, [key], n)


def select_files(files: DataFrame, order: list[str], limit: int | None = None, spaced: int | None = None, expected: int | None = None) -> DataFrame:
    """A catalogue's first files, or ones evenly spaced over it; another number of files than expected is an error."""
    from ..operators import windows

    n = files.count()
    if expected is not None and n != expected:
        raise ValueError(f"{n} files, {expected} expected")
    if spaced is not None:
        return windows.evenly_spaced(files, order, spaced)
    return files.orderBy(*order).limit(limit) if limit is not None else files
