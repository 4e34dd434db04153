"""Best-fit packing (1) into bins of several permitted lengths.

Documents are measured in tokens and cut into pieces (longer ones than the largest bin are cut between tokens, none is dropped);
each piece knows its place in the text. Pieces are dealt evenly and packed by blocks, each block in decreasing order: a
piece goes to the open bin with the least room that holds it. If none does, a bin is opened, of the size whose cost for
each token it can expect to hold is least, given what is left of the block. In the end each bin is sized down to the
smallest length that holds its contents.

A bin of length n costs `overhead` + n + n * n / `quadratic`: padding, and attention that grows with the square. Which
lengths to open is decided for the block as a whole: it is packed with each set of permitted lengths (the largest one is
in all of them) and the packing of the least total cost stays. A block is bounded, so memory is, and none waits for
another.

Rows: a null text has length 0, so its piece is the end marker alone. Rows that repeat an id are packed each. Pieces of
equal length go in the order of their id and place. Other columns are dropped, whatever their names. An empty table
gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.functions import encoders

from .common import Words, map_arrow, real_id, row_id, slices
from .token_prefix import counter

SIZES = (512, 1024, 2048, 4096, 8192)
#: Pieces that are packed together, and the cost of a bin besides its length.
BLOCK, OVERHEAD, QUADRATIC = 50_000, 32, 65_536

PIECES = "rid long, piece long, start long, length long, char_start long, char_end long"
SCHEMA_SQL = f"{PIECES}, bin_id string, bin_size long, bin_offset long, bin_fill long"
SCHEMA = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in SCHEMA_SQL.split(", ")])

#: From texts and the largest length: each text's length, and the characters at which every `top` tokens begin after the first.
Measure = Callable[[pa.Array, int], tuple[np.ndarray, list[list[int]]]]


def by_words(column: pa.Array, top: int) -> tuple[np.ndarray, list[list[int]]]:
    """Words and one end marker a text: lengths where no tokenizer is at hand."""
    w = Words(column, hashed=False)
    n = np.diff(w.first)
    cuts: list[list[int]] = [[] for _ in range(len(n))]
    for k in np.flatnonzero(n >= top).tolist():
        base = int(w.offsets[k])
        begins = (np.cumsum((w.data[base : w.offsets[k + 1]] & 0xC0) != 0x80) - 1).tolist()
        size = len(begins)
        at = [int(w.start[w.first[k] + j]) - base if j < n[k] else size for j in range(top, int(n[k]) + 1, top)]
        cuts[k] = [begins[x] if x < size else begins[-1] + 1 for x in at]
    return n + 1, cuts


def by_tokens(path: str) -> Measure:
    """Tokens of a byte-level BPE vocabulary and one end marker a text, cut where the prefix table reaches each bound."""

    def measure(column: pa.Array, top: int) -> tuple[np.ndarray, list[list[int]]]:
        n, cuts = [], []
        for t in column.to_pylist():
            at = np.cumsum(counter(path).deltas(t or ""), dtype=np.int64)
            n.append(int(at[-1]) + 1 if len(at) else 1)
            cuts.append([int(np.searchsorted(np.maximum.accumulate(at), b, side="right")) for b in range(top, n[-1], top)])
        return np.array(n, dtype=np.int64), cuts

    return measure


def by_ranks(path: str) -> Measure:
    """Tokens of a rank file, encoded by its library, and one end marker a text. Piece k holds the tokens from k * top on;
    a character belongs to the piece that holds its last token."""

    def measure(column: pa.Array, top: int) -> tuple[np.ndarray, list[list[int]]]:
        own, n, cuts = encoders.load(path), [], []
        for t in column.to_pylist():
            ids = own.encode([t or ""])[0]
            n.append(len(ids) + 1)
            cuts.append([])
            if len(ids) >= top:
                data = np.frombuffer(t.encode(), dtype=np.uint8)
                ends = np.r_[np.flatnonzero((data[1:] & 0xC0) != 0x80) + 1, len(data)]  # bytes up to each character's end
                upto = np.cumsum([len(own.raw(ids[b - top : b])) for b in range(top, n[-1], top)])
                cuts[-1] = np.searchsorted(ends, upto, side="right").tolist()
        return np.array(n, dtype=np.int64), cuts

    return measure


def pieces(docs: DataFrame, measure: Measure, top: int, id_col: str = "doc_id") -> DataFrame:
    """(the columns of PIECES, and a hash that deals them)."""
    own = docs.select(row_id(id_col).alias("rid"), "text", F.xxhash64(row_id(id_col), F.xxhash64("text"), F.spark_partition_id()).alias("dealt"))

    def run(batch: pa.RecordBatch):
        for lo, hi in slices(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            text = part.column("text")
            n, cuts = measure(text, top)
            chars = pc.fill_null(pc.utf8_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            count = np.maximum(1, -(-n // top))
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            edge = [[0, *c[: k - 1], int(end)] for c, k, end in zip(cuts, count.tolist(), chars, strict=True)]
            yield {
                "rid": part.column("rid").take(pa.array(row)),
                "piece": piece,
                "start": piece * top,
                "length": np.minimum(n[row] - piece * top, top),
                "char_start": [x for e in edge for x in e[:-1]],
                "char_end": [x for e in edge for x in e[1:]],
                "dealt": part.column("dealt").take(pa.array(row)),
            }

    return map_arrow(own, f"{PIECES}, dealt long", run)


def cost(size: int, overhead: int = OVERHEAD, quadratic: int = QUADRATIC) -> float:
    return overhead + size + size * size / quadratic


def best_fit(lengths: list[int], sizes: tuple[int, ...] = SIZES, open_: tuple[int, ...] | None = None, overhead: int = OVERHEAD, quadratic: int = QUADRATIC) -> tuple[list[int], list[int], list[int]]:
    """For lengths in decreasing order: each one's bin and offset, and each bin's final size. Bins open in the lengths `open_`."""
    sizes = tuple(sorted(sizes))
    price = {s: cost(s, overhead, quadratic) for s in sizes}
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some open bin has r left
    room, used = [], []
    bin_of, offset = [], []
    left = sum(lengths)
    for n in lengths:
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            k = by_room[r].pop()
            if not by_room[r]:
                rooms ^= 1 << r
        else:
            size = min((s for s in open_ or sizes if s >= n), key=lambda s: (price[s] / max(1, min(s, left)), s))
            k, r = len(room), size
            room.append(size)
            used.append(0)
        bin_of.append(k)
        offset.append(used[k])
        used[k] += n
        room[k] = r - n
        left -= n
        own = by_room.setdefault(room[k], [])
        if not own:
            rooms |= 1 << room[k]
        own.append(k)
    return bin_of, offset, [next(s for s in sizes if s >= u) for u in used]


def least_cost(lengths: list[int], sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD, quadratic: int = QUADRATIC) -> tuple[list[int], list[int], list[int]]:
    """The packing of least total cost over the sets of lengths to open."""
    top = max(sizes)
    rest = sorted(set(sizes) - {top})
    sets = [(*c, top) for k in range(len(rest) + 1) for c in combinations(rest, k)]
    packings = (best_fit(lengths, sizes, own, overhead, quadratic) for own in sets)
    return min(packings, key=lambda p: sum(cost(s, overhead, quadratic) for s in p[2]))


def pack(docs: DataFrame, measure: Measure = by_words, sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD, quadratic: int = QUADRATIC, id_col: str = "doc_id") -> DataFrame:
    """One row per piece: the id, piece, start and length in tokens, its place in the text, and its bin: id, final size,
    offset in it, fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, block, held, n_held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy() for c in batch.schema.names]))
            n_held += len(batch)
            while n_held >= BLOCK:
                rows = np.hstack(held)
                yield packed(rows[:, :BLOCK], f"{where}-{block}")
                held, n_held, block = [rows[:, BLOCK:]], n_held - BLOCK, block + 1
        if n_held:
            yield packed(np.hstack(held), f"{where}-{block}")

    def packed(p: np.ndarray, name: str) -> pa.RecordBatch:
        p = p[:, np.lexsort((p[1], p[0], -p[3]))]
        bin_of, offset, size = least_cost(p[3].tolist(), sizes, overhead, quadratic)
        k, size = np.array(bin_of), np.array(size)
        fill = np.bincount(k, p[3], minlength=len(size)).astype(np.int64)
        order = np.lexsort((offset, k))
        columns = [*(x[order] for x in p), [f"{name}-{b}" for b in k[order].tolist()], size[k][order], np.array(offset)[order], fill[k][order]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by a hash of the row and its partition, evenly whatever the copies; sorted, so a task that runs again packs the same.
    dealt = pieces(docs, measure, max(sizes), id_col).repartition(parts, "dealt").sortWithinPartitions("dealt", "rid", "piece").drop("dealt")
    return dealt.mapInArrow(run, SCHEMA_SQL).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)
