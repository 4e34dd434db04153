"""Substring dedup (8) by recompression: repeats of `WINDOW` consecutive words are found, verified and cut.

Exact copies of a text are one document first, that of the smallest id; every word of a later copy of a window's length
is covered. The others are named in rounds. A round names runs (a symbol repeated k times) and then pairs (the alphabet
is split by a hash; a left symbol and a right one after it are joined). A name is a hash of what it stands for, so it is
the same in every document and no dictionary is passed around; words are named first.

Each boundary of symbols knows how many words on either side settle it, so of every window it is known which symbols
inside it any equal window has too. Such a boundary names the pairs of symbols on either side and the pair of these
(`FLANK` symbols a side), symbols two rounds higher. A window takes the least of these names. Windows that hold no such
boundary, as in long runs, are tried with one symbol a side, and name themselves in the end.

1. The names taken are dealt by name: those that occur twice and more reveal the windows that can repeat.
2. Only those windows are dealt again, by a 128-bit BLAKE2b digest of their words, which verifies them: the first
   occurrence of each stays, the others are covered.
3. Covered words are removed.

Names that occur again within one task are told apart there and sent once, in rows of at most `NAMES` names, so rows
follow the names and a passage of many documents never fills one task. Buckets hold about `BUCKET` bytes of text.

Rows: a null or empty text has no words. Fewer words than a window: nothing is removed. Ids lie below 2**62; rows with
a null id come last, in an order by their text. A document is an id with its text: rows that repeat both are one and
don't cover each other; rows that repeat an id with other texts are documents in an order by the texts' hash. Other
columns are dropped (or kept, see cut_repeats), whatever their names. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FINE, IS_SPACE, Words, fresh, map_arrow, map_rows, materialize, mix, real_id, row_id, slices, with_text

WINDOW, ROUNDS, FLANK = 20, 1, 2
#: Names that a task holds before it sends them on, names in a row, bytes of text that share a bucket.
HELD, NAMES, BUCKET = 1 << 20, 64, 1 << 23
_K = np.uint64(0xD1342543DE82EF95)
_FAR = 1 << 60


def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two names in order."""
    return mix(a * _K + b)


class Symbols:
    """The symbols of some texts after rounds of naming.

    `name` and `row` (the text) by symbol; by boundary (one more than symbols) `start`, the word it stands before, and
    `lo` and `hi`: every window that holds the words lo .. hi - 1 of its text has this boundary, whatever is around it.
    """

    def __init__(self, name: np.ndarray, row: np.ndarray) -> None:
        self.name, self.row = name, row
        self.start = self.lo = self.hi = np.arange(len(name) + 1)

    def keep(self, name: np.ndarray, begins: np.ndarray) -> None:
        """Symbols that begin at the given ones. A boundary is settled by the whole symbols on either side of it."""
        at, n = np.r_[begins, len(name)], len(name)
        lo = np.where(at > 0, self.lo[np.maximum(at - 1, 0)], -_FAR)
        hi = np.where(at < n, self.hi[np.minimum(at + 1, n)], _FAR)
        self.name, self.row, self.start, self.lo, self.hi = name[begins], self.row[begins], self.start[at], lo, hi

    def runs(self, k: int) -> None:
        name, row = self.name.copy(), self.row
        begins = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (row[1:] != row[:-1])])
        length = np.diff(np.r_[begins, len(name)])
        own = begins[length > 1]
        name[own] = both(mix(name[own] + np.uint64(2 * k)), length[length > 1].astype(np.uint64))
        self.keep(name, begins)

    def pairs(self, k: int) -> None:
        name, row = self.name, self.row
        left = (mix(name + np.uint64(2 * k + 1)) >> np.uint64(63)).astype(bool)
        at = np.flatnonzero(left[:-1] & ~left[1:] & (row[:-1] == row[1:]))
        own, stays = name.copy(), np.ones(len(name), dtype=bool)
        own[at] = both(name[at], name[at + 1])
        stays[at + 1] = False
        self.keep(own, np.flatnonzero(stays))


def parsed(name: np.ndarray, row: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    out = Symbols(name, row)
    for k in range(rounds if len(name) else 0):
        out.runs(k)
        out.pairs(k)
    return out


def least(name: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where the least name stands in each range first..last, the leftmost if there are several."""
    table, k, out = np.arange(len(name)), 0, first.copy()
    level = np.frexp(last - first + 1)[1] - 1
    while True:
        own = np.flatnonzero(level == k)
        a, b = table[first[own]], table[last[own] - (1 << k) + 1]
        out[own] = np.where(name[b] < name[a], b, a)
        k += 1
        if k > level.max(initial=0):
            return out
        a, b = table[: -(1 << (k - 1))], table[1 << (k - 1) :]
        table = np.where(name[b] < name[a], b, a)


class Parsed:
    """The windows of some texts: `start`, and of the name each takes `key` and `mark`: 3 * (word it stands at) + kind."""

    def __init__(self, words: Words) -> None:
        name, row, n = words.name, words.row, len(words.name)
        self.start = np.flatnonzero(row[: max(n - WINDOW + 1, 0)] == row[WINDOW - 1 :]) if n >= WINDOW else np.zeros(0, dtype=np.int64)
        self.key, self.mark = np.zeros(len(self.start), dtype=np.uint64), np.zeros(len(self.start), dtype=np.int64)
        if not len(self.start):
            return
        symbols, left = parsed(name, row), np.arange(len(self.start))
        for flank in range(FLANK, 0, -1):
            z, m = symbols.name, len(symbols.name)
            at = np.arange(flank, m - flank + 1)
            if not len(at) or not len(left):
                continue
            if flank == 2:
                z = both(z[:-1], z[1:])
            own = both(z[: m - 2 * flank + 1], z[flank : flank + len(at)])
            first, last = symbols.hi[at + flank] - WINDOW, symbols.lo[at - flank]  # the windows that settle it
            upto = lambda x: np.cumsum(np.bincount(np.clip(x, 0, n), minlength=n + 1))
            s = self.start[left]
            i, j = upto(last + 1)[s], upto(first)[s] - 1
            have = i <= j
            best = least(own, i[have], j[have])
            self.key[left[have]], self.mark[left[have]] = own[best], 3 * symbols.start[at[best]] + flank
            left = left[~have]
        if len(left):
            two = both(name[:-1], name[1:])
            four = both(two[:-2], two[2:])
            eight, s = both(four[:-4], four[4:]), self.start[left]
            self.key[left], self.mark[left] = both(both(eight[s], eight[s + 8]), four[s + 16]), 3 * s


def pack(x: np.ndarray) -> bytes:
    """Bytes of an array, all first bytes first: what is alike compresses."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unpack(x: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


SENT = pa.schema([("bucket", pa.int64()), ("key", pa.binary()), ("wide", pa.binary()), ("rid", pa.binary()), ("tie", pa.binary()), ("at", pa.binary())])
SENT_SQL = "bucket long, key binary, wide binary, rid binary, tie binary, at binary"
FOUND = pa.schema([("rid", pa.int64()), ("tie", pa.int64()), ("at", pa.binary())])
FOUND_SQL = "rid long, tie long, at binary"
#: What is sent of an occurrence: its name in two halves, its document's id and tie, and its place.
KINDS = (np.uint64, np.uint64, np.int64, np.int64, np.int64)


class Groups:
    """Occurrences by name, sorted by it; `first` tells where each name's first occurrence stands."""

    def __init__(self, key: np.ndarray, wide: np.ndarray, rid: np.ndarray, tie: np.ndarray, at: np.ndarray) -> None:
        order = np.lexsort((at, tie, rid, wide, key))
        self.key, self.wide, self.rid, self.tie, self.at = self.columns = [x[order] for x in (key, wide, rid, tie, at)]
        self.new = np.ones(len(order), dtype=bool)
        self.new[1:] = (self.key[1:] != self.key[:-1]) | (self.wide[1:] != self.wide[:-1])
        self.first = np.flatnonzero(self.new)[np.cumsum(self.new) - 1] if len(order) else np.zeros(0, dtype=np.int64)

    def shared(self) -> np.ndarray:
        """Those whose name occurs more than once."""
        out = ~self.new
        out[:-1] |= ~self.new[1:]
        return out

    def later(self) -> np.ndarray:
        """Those that come after their name's first occurrence."""
        return (self.rid != self.rid[self.first]) | (self.tie != self.tie[self.first]) | (self.at != self.at[self.first])


def found(rid: np.ndarray, tie: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Places by document."""
    order = np.lexsort((at, tie, rid))
    rid, tie, at = rid[order], tie[order], at[order]
    new = np.flatnonzero(np.r_[True, (rid[1:] != rid[:-1]) | (tie[1:] != tie[:-1])]) if len(rid) else np.zeros(0, dtype=np.int64)
    parts = [x.tobytes() for x in np.split(at, new[1:])] if len(new) else []
    return pa.RecordBatch.from_arrays([pa.array(rid[new], pa.int64()), pa.array(tie[new], pa.int64()), pa.array(parts, pa.binary())], schema=FOUND)


def deal(docs: DataFrame, occurrences, first_of_many: bool, n_buckets: int) -> DataFrame:
    """(rid, tie, at): the occurrences of names that several have; with first_of_many, those after each name's first.

    occurrences: from a batch (rid, tie, text and more) to arrays (key, wide, row of the batch, at). Within what a task
    holds, a name is sent once; what is settled there goes with a negative bucket.
    """

    def send(parts: list) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        parts.clear()  # they are large, and copied twice
        g = Groups(*columns)
        del columns
        known = np.flatnonzero(g.later() if first_of_many else g.shared())
        kept = np.flatnonzero(g.new)
        bucket = (mix(g.key[kept]) % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((g.at[kept], g.tie[kept], g.rid[kept], bucket))
        kept, bucket = kept[order], bucket[order]
        rows: list[tuple] = []
        for k in range(0, len(known), HELD):
            own = known[k : k + HELD]
            rows.append((-1 - int(g.rid[own[0]]) % n_buckets, *(pack(c[own]) for c in g.columns)))
        begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        size = np.diff(np.r_[begins, len(bucket)])
        place = np.arange(len(bucket)) - np.repeat(begins, size)
        cuts = np.flatnonzero(place % NAMES == 0)
        columns = [c[kept] for c in g.columns]
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
            rows.append((int(bucket[lo]), *(pack(c[lo:hi]) for c in columns)))
        for k in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 4096], strict=True), SENT, strict=True)], schema=SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for lo, hi in slices(batch.column("text"), size=FINE):
                part = batch.slice(lo, hi - lo)
                key, wide, row, at = occurrences(part)
                if len(key):
                    rid, tie = (part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("rid", "tie"))
                    parts.append((key, wide, rid, tie, at))
                    n += len(key)
                if n >= HELD:
                    yield from send(parts)
                    parts, n = [], 0
        if parts:
            yield from send(parts)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    yield found(*(unpack(row[c], np.int64) for c in ("rid", "tie", "at")))
                    continue
                if row["bucket"] != bucket:
                    if rows:
                        yield judged(rows)
                    bucket, rows = row["bucket"], []
                rows.append(row)
        if rows:
            yield judged(rows)

    def judged(rows: list[dict]) -> pa.RecordBatch:
        g = Groups(*(np.concatenate([unpack(r[c.name], kind) for r in rows]) for c, kind in zip(list(SENT)[1:], KINDS, strict=True)))
        hit = g.later() if first_of_many else g.shared()
        return found(g.rid[hit], g.tie[hit], g.at[hit])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.mapInArrow(run, SENT_SQL).repartition(n, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(settle, FOUND_SQL)


def _revealing(batch: pa.RecordBatch):
    """The names that windows take."""
    words = Words(batch.column("text"))
    p = Parsed(words)
    mark, at = np.unique(p.mark, return_index=True)
    row = words.row[p.start[at]]
    return p.key[at], np.zeros(len(at), dtype=np.uint64), row, mark - 3 * words.first[row]


def _windows(batch: pa.RecordBatch):
    """Windows whose names are shared, named by their words; `hits` has each document's shared marks."""
    words = Words(batch.column("text"))
    p = Parsed(words)
    shared = np.zeros(3 * len(words.row) + 6, dtype=bool)
    for k, parts in enumerate(batch.column("hits").to_pylist()):
        at = np.frombuffer(b"".join(parts), dtype=np.int64) + 3 * words.first[k]
        shared[at[at < 3 * words.first[k + 1] + 3]] = True
    start = p.start[shared[p.mark]]
    # The words with one space between them, so that a window is one piece of bytes.
    size = words.end - words.start
    begin = np.r_[0, np.cumsum(size + 1)]
    spaced = np.full(begin[-1], 32, dtype=np.uint8)
    letters = words.data[~IS_SPACE[words.data]]
    spaced[np.arange(len(letters)) + np.repeat(np.arange(len(size)), size)] = letters
    text = spaced.tobytes()
    digest = hashlib.blake2b
    names = [digest(text[a:b], digest_size=16).digest() for a, b in zip(begin[start].tolist(), (begin[start + WINDOW] - 1).tolist(), strict=True)]
    name = np.frombuffer(b"".join(names), dtype=np.uint64).reshape(-1, 2)
    row = words.row[start]
    return np.ascontiguousarray(name[:, 0]), np.ascontiguousarray(name[:, 1]), row, start - words.first[row]


def keyed(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str, str]:
    """The rows with two columns more, under names of their own: the id (never null) and a hash of the text."""
    rid, h = fresh(docs, "rid", "h")
    return docs.withColumns({rid: row_id(id_col), h: F.xxhash64("text")}), rid, h


def covered(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(rid, h, spans): per distinct text, by the id it first has, starts of covered windows, as 64-bit numbers in binary
    parts; null where nothing is covered. Rows that are not listed are later copies: all of their windows are covered."""
    own = docs.select(row_id(id_col).alias("rid"), F.xxhash64("text").alias("h"), "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    firsts = own.groupBy(F.sha2("text", 256).alias("sha"), "h").agg(F.min("rid").alias("rid"), F.max(size).alias("size"))
    firsts = materialize(firsts.select("rid", "h", "size"), "firsts")
    again = firsts.groupBy("rid").agg(F.count("*").alias("n")).where("n > 1").select("rid", F.lit(True).alias("again"))
    firsts = firsts.join(again, "rid", "left").select("rid", "h", "size", F.when(F.col("again"), F.col("h")).otherwise(0).alias("tie"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(16 * parts, (firsts.agg(F.sum("size")).first()[0] or 0) // BUCKET)
    texts = own.join(firsts.drop("size"), ["rid", "h"])

    def marks(places: DataFrame, name: str) -> DataFrame:
        gathered = places.groupBy("rid", "tie").agg(F.collect_list("at").alias(name))
        return gathered.join(firsts.select("rid", "tie", "h"), ["rid", "tie"]).select("rid", "h", name)

    shared = marks(deal(texts, _revealing, False, n), "hits")
    spans = marks(deal(texts.join(shared, ["rid", "h"]), _windows, True, n), "spans")
    return firsts.select("rid", "h").join(spans, ["rid", "h"], "left").select("rid", "h", F.lit(True).alias("first"), "spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: bool = True) -> DataFrame:
    """Per row: n_words, n_removed, kept_sha256 of the kept words joined by spaces, and (with text) the text without the removed words."""
    own = docs.select(row_id(id_col).alias("rid"), F.xxhash64("text").alias("h"), "text")
    joined = own.join(covered(docs, id_col), ["rid", "h"], "left").select("rid", "text", "first", "spans")

    def run(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        for lo, hi in slices(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            words = Words(part.column("text"), hashed=False)
            first = part.column("first").to_pylist()
            out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "text")}
            for k, spans in enumerate(part.column("spans").to_pylist()):
                a, b = int(words.first[k]), int(words.first[k + 1])
                raw = words.data[words.offsets[k] : words.offsets[k + 1]].tobytes()
                own, kept = raw.split(), _kept(first[k], spans, b - a)
                gone = 0 if kept is None else int((~kept).sum())
                out["n_words"].append(b - a)
                out["n_removed"].append(gone)
                out["kept_sha256"].append(hashlib.sha256(b" ".join(compress(own, kept.tolist()) if gone else own)).hexdigest())
                if text:
                    out["text"].append(_cut(raw, words.start[a:b] - words.offsets[k], kept) if gone else raw.decode())
            yield {"rid": part.column("rid"), **out}

    schema = "rid long, n_words long, n_removed long, kept_sha256 string" + ", text string" * text
    return map_arrow(joined, schema, run).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents, all their columns, without the words that repeats cover; none is dropped. The columns used for the
    work get names that the table doesn't have."""
    own, rid, h = keyed(docs, id_col)
    first, spans = fresh(own, "first", "spans")
    marks = covered(docs, id_col).select(F.col("rid").alias(rid), F.col("h").alias(h), F.col("first").alias(first), F.col("spans").alias(spans))
    joined = own.join(marks, [rid, h], "left").select(*(own[c] for c in docs.columns), first, spans)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, firsts = batch.column("text").to_pylist(), batch.column(first).to_pylist()
        for k, own in enumerate(batch.column(spans).to_pylist()):
            if text[k] and (own or not firsts[k]):
                words = Words(pa.array([text[k]], pa.large_string()), hashed=False)
                kept = _kept(firsts[k], own, len(words.start))
                if kept is not None and not kept.all():
                    text[k] = _cut(text[k].encode(), words.start, kept)
        return with_text(batch, text, drop=(first, spans))

    return map_rows(joined, run, drop=(first, spans))


def _kept(first: bool | None, spans: list[bytes] | None, n: int) -> np.ndarray | None:
    """Which of n words no covered window holds; None where there is no such window."""
    if not first and n >= WINDOW:
        return np.zeros(n, dtype=bool)
    if not spans:
        return None
    at = np.frombuffer(b"".join(spans), dtype=np.int64)
    at = at[at + WINDOW <= n]
    step = np.bincount(at, minlength=n + 1) - np.bincount(at + WINDOW, minlength=n + 1)
    return np.cumsum(step[:n]) == 0


def _cut(raw: bytes, start: np.ndarray, kept: np.ndarray) -> str:
    """The text from each kept word up to the next word; white space before the first word stays."""
    upto = np.r_[start[1:], len(raw)]
    return (raw[: start[0]] + b"".join(raw[s:e] for s, e in zip(start[kept].tolist(), upto[kept].tolist(), strict=True))).decode()
