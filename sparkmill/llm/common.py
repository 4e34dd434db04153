"""What the operators of this subpackage share: materialised intermediate tables, words, hashing."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space and the five ASCII control characters of white space, as Python's bytes.split() has it.
WHITESPACE = b" \t\n\x0b\x0c\r"
#: Ids lie below this; a row with a null id gets a number from here on inside joins, by its text, and so comes last.
NULL_ID = 2**62

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(WHITESPACE)] = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Only in local mode, as in tests, one is made where it is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="sparkmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot if it has more than one in so many of all rows; there are fewer such keys than this number.
HOT = 1000


def join_hot(rows: DataFrame, named: DataFrame, key: str, n: str = "n") -> DataFrame:
    """rows joined with named (one row a key, with `n`, its number of rows): the hot keys, fewer than HOT, are broadcast,
    so that no task gets all rows of one key; the others are shuffled."""
    total = named.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) * HOT > total
    keys = F.broadcast(named.where(hot).select(key))
    few = rows.join(F.broadcast(named.where(hot).drop(n)), key)
    return few.unionByName(rows.join(keys, key, "left_anti").join(named.where(~hot).drop(n), key))


#: Bits of the mask that `maybe` makes, in rows of 64: at most 2**18 rows, however many keys there are.
MASK_BITS = 1 << 24


def maybe(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys wanted has, and a few others: a mask of the keys' hashes is broadcast, so that a join which
    follows shuffles few rows in vain. No row of a wanted key is lost; beyond some 10^7 keys the mask filters little."""
    at, bits = fresh(rows, "at", "bits")
    place = F.pmod(F.xxhash64(*keys), F.lit(MASK_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    held = wanted.select(F.shiftright(place, 6).alias(at), bit.alias(bits)).groupBy(at).agg(F.bit_or(bits).alias(bits))
    met = rows.withColumn(at, F.shiftright(place, 6)).join(F.broadcast(held), at)
    return met.where(F.col(bits).bitwiseAND(bit) != 0).select(*rows.columns)


def with_id(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Only the id and the text: `rid` never null, text null as it is. Other columns, whatever their names, go."""
    return df.select(row_id(id_col).alias("rid"), F.col("text"))


def row_id(id_col: str = "doc_id"):
    """Never null by its type, so that a join adds no filter and equal shuffles are shared."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID) + F.xxhash64("text").bitwiseAND(F.lit(NULL_ID - 1)))


def fresh(df: DataFrame, *stems: str) -> tuple[str, ...]:
    """Names for columns of our own that the table doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    longest = max(map(len, taken), default=0)
    return tuple(s if s.lower() not in taken else f"{s}_".ljust(longest + 1, "_") for s in stems)


def real_id(col: str = "rid"):
    """The id itself: null again where it was null."""
    return F.when(F.col(col) < NULL_ID, F.col(col))


def bounded_sample(df: DataFrame, by: list[str], rows: int, total: int) -> DataFrame:
    """At most `rows` rows by a hash of some columns, of a table of `total` rows. Hashes beyond the share wanted (and
    some more) go before the sort, so each partition passes on a few rows only, however many partitions there are."""
    place = F.pmod(F.xxhash64(*by), F.lit(1 << 40))
    share = min(1.0, (1.5 * rows + 64) / max(total, 1))
    return df.where(place < int(share * (1 << 40))).orderBy(place, *by).limit(rows)


def map_arrow(df: DataFrame, schema: str, per_batch: Callable[[pa.RecordBatch], Iterator[dict[str, object]] | dict[str, object]]) -> DataFrame:
    """mapInArrow with a function from a batch to the columns of one output batch (a dict), or to several of them."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = per_batch(batch)
            for columns in [out] if isinstance(out, dict) else out:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch], drop: tuple[str, ...] = ()) -> DataFrame:
    """mapInArrow from rows to rows of the same columns, without those in drop, by runs of about SLICE bytes of text."""
    schema = df.drop(*drop).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                yield per_batch(batch.slice(lo, hi - lo))

    return df.mapInArrow(run, schema)


def with_text(batch: pa.RecordBatch, text: list[str | None], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    """The batch with another text; n_chars, if there is one, follows it."""
    columns = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in drop}
    columns["text"] = pa.array(text, batch.column("text").type)
    if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
        columns["n_chars"] = pc.utf8_length(columns["text"]).cast(columns["n_chars"].type)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def ids(batch: pa.RecordBatch, column: str = "rid") -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


#: Bytes that the word hash takes at a time.
BLOCK = 1 << 16
#: Odd base of the word hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@functools.lru_cache(maxsize=4)
def _table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _table(base, BLOCK)[:n] if n <= BLOCK else _table.__wrapped__(base, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that equal low bits of the input do not show."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of many texts as arrays: `start` and `end` are byte positions in `data`, `row` the text, `name` a 64-bit hash of the bytes."""

    def __init__(self, column: pa.Array, hashed: bool = True) -> None:
        column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
        column = column.fill_null("") if column.null_count else column
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :] if len(column) else np.zeros(1, dtype=np.int64)
        lo, hi = int(offsets[0]), int(offsets[-1])
        raw = column.buffers()[2] if len(column) else None
        self.data = np.frombuffer(raw, dtype=np.uint8, count=hi)[lo:] if raw is not None and hi else np.zeros(0, dtype=np.uint8)
        self.offsets = offsets - lo
        n = len(self.data)
        space = IS_SPACE[self.data]
        edge = np.ones(n + 1, dtype=bool)  # a word may begin here: after white space or where a text begins
        edge[1:n] = space[: n - 1] if n else False
        edge[self.offsets] = True
        self.start = np.flatnonzero(edge[:n] & ~space)
        stop = np.ones(n + 1, dtype=bool)
        stop[:n] = space
        stop[self.offsets] = True
        stop_at = np.flatnonzero(stop)
        self.end = stop_at[np.searchsorted(stop_at, self.start, side="right")] if len(self.start) else np.zeros(0, dtype=np.int64)
        self.row = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.first = np.searchsorted(self.row, np.arange(len(column) + 1))  # of each text's words
        if hashed:
            self.name = self._names()

    def _names(self) -> np.ndarray:
        """Hashes of the words' bytes, from running sums over blocks of words."""
        out = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):
            lo = int(self.start[at])
            upto = max(at + 1, int(np.searchsorted(self.end, lo + BLOCK, side="right")))
            hi = int(self.end[upto - 1])
            total = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum((self.data[lo:hi].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, hi - lo), out=total[1:], dtype=np.uint64)
            s, e = self.start[at:upto] - lo, self.end[at:upto] - lo
            out[at:upto] = mix((total[e] - total[s]) * _powers(_INVERSE, hi - lo)[s] + (e - s).astype(np.uint64))
            at = upto
        return out


#: Bytes of text that a kernel takes at a time; those that make arrays of all shingles or windows take the finer one.
SLICE, FINE = 1 << 22, 1 << 20


def slices(*columns: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `size` bytes of text in all columns; a longer row stays whole."""
    lengths = [pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
    total, lo = np.cumsum(np.sum(lengths, axis=0)), 0
    while lo < len(total):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + size, side="right")))
        yield lo, hi
        lo = hi
