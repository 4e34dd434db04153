"""Functions Spark's SQL lacks, as Arrow-batched UDFs: Unicode normal forms, compression, tandem repeats, chunking."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DataType, StructField, StructType

from . import kernels, numbers


def udf(kind: str | DataType):
    """An Arrow UDF that is made when it is first applied, as that needs a session."""

    def wrap(f) -> Callable[..., Column]:
        return lambda *x: pandas_udf(f, kind)(*x)

    return wrap


@udf("string")
def nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


@udf("string")
def nfkc_fold(x: pd.Series) -> pd.Series:
    """NFKC, case folded, without white space: the form in which documents are compared."""
    return x.map(lambda s: "".join(unicodedata.normalize("NFKC", s).casefold().split()), na_action="ignore")


@udf("string")
def nfkc_spaced(x: pd.Series) -> pd.Series:
    """NFKC with single spaces."""
    return x.map(lambda s: " ".join(unicodedata.normalize("NFKC", s).split()), na_action="ignore")


@udf("double")
def compression(x: pd.Series) -> pd.Series:
    """Bytes by compressed bytes (level 6); 0 for an empty text."""
    return x.map(lambda s: len(s.encode()) / len(zlib.compress(s.encode(), 6)) if s else 0.0, na_action="ignore").astype(float)


@udf("double")
def loop_coverage(x: pd.Series) -> pd.Series:
    """Largest share of the text without white space that back-to-back repeats of one period (2 to 80) cover."""

    def one(s: str) -> float:
        a = np.array([ord(c) for c in "".join(s.split())])
        best = 0
        for period in range(2, min(80, len(a) // 2) + 1):
            same = np.r_[False, a[:-period] == a[period:], False]
            edge = np.flatnonzero(np.diff(same.astype(np.int8)))
            run = edge[1::2] - edge[::2]
            best = max(best, int((run[run >= period] + period).sum()))
        return min(best / len(a), 1.0) if len(a) >= 4 else 0.0

    return x.map(one, na_action="ignore").astype(float)


def cleaner(footer: bool, least: int, repeats: int = 3, chars: int = 240, share: float = 0.08):
    """The cleaned text and what needs a pass over all of it: whether it is poisoned by repetition, and by repeated sentences."""

    @udf("text string, poison boolean, repeated boolean")
    def cleaned(x: pd.Series) -> pd.DataFrame:
        text = x.map(lambda s: kernels.clean(s, footer), na_action="ignore")
        return pd.DataFrame({"text": text, "poison": text.map(kernels.poison, na_action="ignore"), "repeated": text.map(lambda s: kernels.repeated(s, least, repeats, chars, share), na_action="ignore")})

    return cleaned


@udf("boolean")
def poison(x: pd.Series) -> pd.Series:
    return x.map(kernels.poison, na_action="ignore")


def repeated(least: int, repeats: int, chars: int, share: float):
    @udf("boolean")
    def hit(x: pd.Series) -> pd.Series:
        return x.map(lambda s: kernels.repeated(s, least, repeats, chars, share), na_action="ignore")

    return hit


def repeated_chars(least: int, repeats: int, beyond_first: bool):
    @udf("long")
    def count(x: pd.Series) -> pd.Series:
        return x.map(lambda s: kernels.repeated_chars(s, least, repeats, beyond_first), na_action="ignore").astype("Int64")

    return count


@udf("string")
def drop_footer(x: pd.Series) -> pd.Series:
    return x.map(kernels.drop_footer, na_action="ignore")


@udf("double")
def duplicate_ngrams(x: pd.Series) -> pd.Series:
    """1 less the share of distinct runs of four tokens of an array; 0 for fewer than 8 tokens."""

    def one(t) -> float:
        return 1 - len(set(zip(t, t[1:], t[2:], t[3:], strict=False))) / (len(t) - 3) if len(t) >= 8 else 0.0

    return x.map(lambda t: one(t.tolist()), na_action="ignore").astype(float)


def chunker(most: int, least: int):
    """Paragraphs packed into chunks of at most `most` characters; long ones are split after sentence marks; short chunks are dropped."""
    import re

    sentence = re.compile(r"(?<=[。！？!?.])\s*")

    def pieces(s: str):
        for paragraph in (p.strip() for p in re.split(r"\n\s*\n|\n", s)):
            if len(paragraph) <= most:
                yield paragraph, "\n"
                continue
            for part in sentence.split(paragraph):
                for k in range(0, len(part), most):
                    yield part[k : k + most], ""

    def chunks(s: str) -> list[str]:
        out, held = [], ""
        for piece, joint in pieces(s):
            if not piece:
                continue
            if held and len(held) + len(joint) + len(piece) > most:
                out.append(held)
                held = piece
            else:
                held = held + joint + piece if held else piece
        return [c for c in [*out, held] if len(c) >= max(least, 1)]

    @udf("array<string>")
    def chunk_text(x: pd.Series) -> pd.Series:
        return x.map(lambda s: chunks(s) if s else [])

    return chunk_text


@udf("array<string>")
def content_chunks(x: pd.Series) -> pd.Series:
    """Content-defined chunks of 32 to 128 characters (the last may be shorter)."""
    return x.map(lambda s: kernels.cuts(s, 32, 128, 63) if s else [])


def least_hashes(n: int):
    """The least hash of an array of strings under each of n hash functions; null for an empty array."""
    factor = np.random.default_rng(64).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def one(chunks) -> np.ndarray | None:
        if chunks is None or not len(chunks):
            return None
        h = np.array([xxhash.xxh3_64_intdigest(c) for c in chunks], dtype=np.uint64)
        h = (h[:, None] ^ (h[:, None] >> np.uint64(29))) * factor
        return (h ^ (h >> np.uint64(32))).min(axis=0).view(np.int64)

    @udf("array<bigint>")
    def least(x: pd.Series) -> pd.Series:
        return x.map(one)

    return least


def runs_met(size: int, wanted: np.ndarray | None):
    """(hash, place) of the distinct runs of `size` characters of a text, at their first place from 1; of those in
    `wanted` (sorted hashes) only, if it is given."""

    @udf("array<struct<h: bigint, at: int>>")
    def met(x: pd.Series) -> pd.Series:
        return x.map(lambda s: kernels.runs(s, size, wanted), na_action="ignore")

    return met


@udf("bigint")
def run_hash(x: pd.Series) -> pd.Series:
    """The hash that runs_met gives a run of the text's own length."""
    return x.map(lambda s: kernels.runs(s, len(s), None)[0]["h"] if s else None, na_action="ignore").astype("Int64")


def agrees(text: Column | str, reference: Column | str) -> Column:
    """Whether a number that the text states agrees with the reference (a decimal as text) at the precision it is written in."""

    @pandas_udf("boolean")
    def agree(x: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or ref is None else numbers.agrees(ref, s) for s, ref in zip(x, r, strict=True)], dtype="boolean")

    return agree(text, reference)


#: Characters of text whose results, many times as large, a worker makes at a time, whatever the rows of an Arrow batch.
SLICE = 1 << 18


def term_texts(rows: DataFrame, text: str, longest: int, bits: int) -> DataFrame:
    """(at, n): how many texts have each hashed character n-gram of up to `longest` characters; one row a partition and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = kernels.term_texts((s or "" for b in batches for s in b.column(0).to_pylist()), longest, bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["at", "n"])

    return rows.select(text).mapInArrow(run, "at long, n long")


def vectors(batches: Iterator[pa.RecordBatch], text: str, weight: np.ndarray, longest: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows with sparse vectors, as the fields of their type, in the place of a text; a batch for each SLICE of text. A null
    text is taken as an empty one."""
    for b in batches:
        for lo, hi in kernels.runs_of(pc.fill_null(pc.utf8_length(b[text]), 0).to_numpy(), SLICE):
            rows = b.slice(lo, hi - lo)
            at, values = [], []
            for s in rows[text].to_pylist():
                places, v = kernels.sparse_terms(s or "", weight, longest, bits)
                own = kernels.measures(s or "")
                at.append(np.concatenate([places, len(weight) + np.arange(len(own))]).astype(np.int32))
                values.append(np.concatenate([v, own]))
            ends = np.cumsum([0, *map(len, at)]).astype(np.int32)
            size = np.full(len(at), len(weight) + len(own), dtype=np.int32)
            fields = [np.zeros(len(at), dtype=np.int8), size, *(pa.ListArray.from_arrays(ends, np.concatenate(x)) for x in (at, values))]
            vector = pa.StructArray.from_arrays([pa.array(f) for f in fields], names=["type", "size", "indices", "values"])
            kept = {n: c for n, c in zip(rows.schema.names, rows.columns, strict=True) if n != text}
            yield pa.RecordBatch.from_arrays([*kept.values(), vector], names=[*kept, "vector"])


def with_sparse(rows: DataFrame, text: str, name: str, weight: np.ndarray, longest: int, bits: int) -> DataFrame:
    """Rows with a sparse vector of a text's weighted terms, and its six measures after them, in the text's place."""
    fields = [*rows.drop(text).schema.fields, StructField(name, VectorUDT())]
    return rows.mapInArrow(lambda batches: vectors(batches, text, weight, longest, bits), StructType(fields))
