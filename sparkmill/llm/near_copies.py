"""Near copies by word shingles: candidates from SimHash and MinHash blocks, verified by exact Jaccard similarity.

A text is the set of its shingles of `size` words, A-Z lower-cased; a shorter text is one shingle. Texts of the same words
are one node. Each node has `BANDS` blocks of `ROWS` minima; two texts of similarity 0.8 share a block with a probability
of 1 - (1 - 0.8**5)**24 = 0.9999. All that share a block and have the similarity end in one group, whatever its size:

* First each node meets some of its block (all of it, if it is small), dealt into tiles of about `TILE` so that no task
  holds a large block; what verifies joins nodes into components.
* Then the blocks that still hold several components are compared wholly, but for two nodes of one component. The nodes of
  a block's largest component and the others are dealt into tiles; two tiles meet if one of them holds others. Two texts
  are compared in the first block they share. A pair of tiles gives a chain of the components it joins, not pairs.

So a group whose members are linked at once costs in proportion to its size, and only nodes that stay apart are compared
with all of their block.

With `by_fingerprint`, as in the pipeline's stage simhash_near_dedup, the buckets of operator 3 (`simhash.tables`: covering
masks over SimHash fingerprints) are blocks as well, so that of fingerprints within its radius no pair of the similarity is
missed. Radius 2 holds a small part of the texts of similarity 0.8, whose fingerprints mostly differ in 7 to 10 of 64 bits;
the MinHash blocks add those beyond it.

Rows: null and empty texts, and ones of white space only, are copies of each other. Rows that repeat an id are compared
by their own texts; a row with a null id comes last. Other columns are kept, whatever their names. An empty table gives
none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FINE, Words, join_hot, map_arrow, materialize, maybe, real_id, row_id, slices, texts
from .components import components
from .simhash import MASKS, RADIUS, fingerprint, keep_first, signed, tables
from .substring import both
from .vector_copies import chains

SIZE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: Nodes of a block that meet each other at once, and the next ones that a node of a larger block meets first; nodes of a tile.
ALL, NEXT, TILE = 9, 2, 256
_FACTORS = np.random.default_rng(42).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(column: pa.Array, size: int = SIZE) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of each text joined by spaces, and names of all shingles with the first position of each text's (one at least)."""
    words = [b" ".join((t or "").encode().lower().split()) for t in column.to_pylist()]
    w = Words(pa.array(words, pa.large_binary()).view(pa.large_string()))
    name = w.name
    for k in range(1, size):
        name = both(name[:-1], w.name[k:]) if len(name) > 1 else name[:0]
    inside = w.row[: len(name)] == w.row[len(w.row) - len(name) :]
    short = np.flatnonzero(np.diff(w.first) < size)
    row = np.r_[w.row[: len(name)][inside], short]
    name = np.r_[name[inside], np.array([xxhash.xxh64_intdigest(words[k]) for k in short], dtype=np.uint64)]
    order = np.argsort(row, kind="stable")
    return words, name[order], np.searchsorted(row[order], np.arange(len(words) + 1))


def minima(name: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for each band and text: its ROWS minima together."""
    keys = np.zeros((BANDS, len(first) - 1), dtype=np.uint64)
    for k, factor in enumerate(_FACTORS):
        keys[k // ROWS] = both(keys[k // ROWS], np.minimum.reduceat(name * factor, first[:-1]))
    return keys


def _own(docs: DataFrame, id_col: str) -> DataFrame:
    return docs.select(row_id(id_col).alias("rid"), F.xxhash64("text").alias("h"), "text")


def blocks(docs: DataFrame, id_col: str = "doc_id", size: int = SIZE, by_fingerprint: bool = False) -> DataFrame:
    """(rid, h, same, keys, fp): the id, a hash of the text, a 128-bit name of the text's words, one number for each band and
    the fingerprint (null without by_fingerprint)."""

    def run(batch: pa.RecordBatch):
        for lo, hi in slices(batch.column("text"), size=FINE):
            part = batch.slice(lo, hi - lo)
            words, name, first = shingles(part.column("text"), size)
            fp = [signed(fingerprint(t)) for t in texts(part)] if by_fingerprint else pa.nulls(len(part), pa.int64())
            yield {"rid": part.column("rid"), "h": part.column("h"), "same": [xxhash.xxh3_128_hexdigest(x) for x in words], "keys": pa.array(list(minima(name, first).T.view(np.int64)), pa.list_(pa.int64())), "fp": fp}

    return map_arrow(_own(docs, id_col), "rid long, h long, same string, keys array<long>, fp long", run)


def _fingerprint_blocks(unique: DataFrame) -> DataFrame:
    """(node, band, block) of (node, fp): the buckets that operator 3 deals fingerprints into; their bands follow BANDS."""
    counted = materialize(unique.groupBy("fp").agg(F.count("*").alias("n")), "fingerprints")
    dealt = tables(counted.select("fp")).select("fp", (F.lit(BANDS) + F.col("t")).cast("int").alias("band"), F.xxhash64("t", "mask", "key").alias("block"))
    each = dealt.groupBy("fp").agg(F.collect_list(F.struct("band", "block")).alias("own")).join(counted, "fp")
    return join_hot(unique.select("node", "fp"), materialize(each, "dealt"), "fp").select("node", F.explode("own").alias("x")).select("node", "x.band", "x.block")


def verified(pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The (a, b) of (a, b, ta, tb) whose texts have the similarity."""

    def run(batch: pa.RecordBatch):
        for lo, hi in slices(batch.column("ta"), batch.column("tb"), size=FINE):
            part, sets = batch.slice(lo, hi - lo), []
            for c in ("ta", "tb"):
                _, name, first = shingles(part.column(c), size)
                sets.append([np.unique(name[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)])
            shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets, strict=True)]
            hold = pa.array([s >= similarity * (len(x) + len(y) - s) for s, x, y in zip(shared, *sets, strict=True)], pa.bool_())
            yield {c: part.column(c).filter(hold) for c in ("a", "b")}

    node = "struct<rid: bigint, h: bigint>"
    return map_arrow(pairs, f"a {node}, b {node}", run)


def _texts(docs: DataFrame, id_col: str, nodes: DataFrame) -> DataFrame:
    """(rid, h, text) of distinct nodes."""
    wanted = materialize(nodes.select("node.rid", "node.h").distinct(), "wanted")
    own = maybe(_own(docs, id_col), wanted, "rid", "h").join(wanted, ["rid", "h"])  # a semi join would be pushed below the mask
    return own.groupBy("rid", "h").agg(F.min("text").alias("text"))


def _met_first(met: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of nodes that follow each other in a tile of a block, in an order drawn for the block."""
    tile = F.pmod(F.xxhash64("node", "block", F.lit(1)), F.ceil(F.col("held") / TILE)).alias("tile")
    order = "partition by block, tile order by xxhash64(node, block), node"
    met = met.select("node", "block", "held", tile)
    later = met.selectExpr("node", "held", f"collect_list(node) over ({order} rows between 1 following and {ALL - 1} following) as later")
    pairs = later.selectExpr("node", f"explode(if(held <= {ALL}, later, slice(later, 1, {NEXT}))) as other").selectExpr("least(node, other) as a", "greatest(node, other) as b")
    return pairs.where("a <> b").distinct()


def _tiles(big: DataFrame) -> DataFrame:
    """(node, comp, block, a, b, own): the nodes of blocks with several components, a row for each two tiles to compare."""
    each = big.groupBy("block", "comp").agg(F.count("*").alias("c"))
    mixed = each.groupBy("block").agg(F.sum("c").alias("n"), F.max(F.struct("c", "comp")).alias("most")).where("n > most.c")
    mixed = mixed.select("block", "n", F.col("most.comp").alias("main"), F.ceil((F.col("n") - F.col("most.c")) / TILE).cast("int").alias("others"), F.ceil(F.col("most.c") / TILE).cast("int").alias("mains"))
    inside = F.col("comp") == F.col("main")
    dealt = F.xxhash64("node", "block", F.lit(2))
    own = F.when(inside, F.col("others") + F.pmod(dealt, F.col("mains"))).otherwise(F.pmod(dealt, F.col("others"))).cast("int")
    rows = join_hot(big, materialize(mixed, "mixed"), "block").select("node", "comp", "block", "band", inside.alias("inside"), "others", "mains", own.alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("inside"), F.col("others") - 1).otherwise(F.col("others") + F.col("mains") - 1))).alias("other")
    return rows.select("node", "comp", "block", "band", "own", other).select("node", "comp", "block", "band", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many names each set of `left` shares with each of `right`."""
    name, row = np.concatenate([sets[k] for k in np.r_[left, right]]), np.repeat(np.arange(len(left) + len(right)), [len(sets[k]) for k in np.r_[left, right]])
    _, at = np.unique(name, return_inverse=True)
    in_left = row < len(left)
    n = np.bincount(at) if len(at) else np.zeros(0, dtype=np.int64)
    useful = (np.bincount(at[in_left], minlength=len(n)) > 0) & (np.bincount(at[~in_left], minlength=len(n)) > 0)
    column = np.cumsum(useful) - 1
    keep = useful[at]
    row, at = row[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out, step = np.zeros((len(left), len(right)), dtype=np.float64), 2048
    for lo in range(0, int(useful.sum()), step):
        i, j = np.searchsorted(at, [lo, lo + step])
        block = np.zeros((len(left) + len(right), step), dtype=np.float32)
        block[row[i:j], at[i:j] - lo] = 1
        out += block[: len(left)] @ block[len(left) :].T  # counts to 2048, exact
    return out


def _compared(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): components that two tiles join."""

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        own, a, b, band = t["own"].to_numpy(), t["a"][0].as_py(), t["b"][0].as_py(), t["band"][0].as_py()
        comp, who = np.unique(np.stack([t["crid"].to_numpy(), t["ch"].to_numpy()], axis=1), axis=0, return_inverse=True)
        who = who.reshape(-1)
        keys = t["keys"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[:, :band]
        sets = [np.frombuffer(x, dtype=np.uint64) for x in t["shingles"].to_pylist()]
        n = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
        try_ = (who[left][:, None] != who[right][None]) & (np.minimum(n[left][:, None], n[right][None]) >= similarity * np.maximum(n[left][:, None], n[right][None]))
        for k in range(keys.shape[1]):  # compared where they met first
            try_ &= keys[left, k][:, None] != keys[right, k][None]
        if band >= BANDS:
            fp = t["fp"].to_numpy().view(np.uint64)
            bits = fp[left][:, None] ^ fp[right][None]
            try_ &= np.bitwise_count(bits) <= RADIUS
            for mask in MASKS[: (band - BANDS) // 8]:
                try_ &= bits & np.uint64(mask) != 0
        i, j = np.nonzero(try_)
        if len(i):
            li, ri = np.unique(i), np.unique(j)
            s = shared_counts(sets, left[li], right[ri])[np.searchsorted(li, i), np.searchsorted(ri, j)]
            i, j = left[i], right[j]
            hold = s >= similarity * (n[i] + n[j] - s)
            i, j = i[hold], j[hold]
        root = chains(who[i], who[j], len(comp))
        some = np.flatnonzero(root != np.arange(len(comp)))
        columns = (comp[some, 0], comp[some, 1], comp[root[some], 0], comp[root[some], 1])
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["arid", "ah", "brid", "bh"])

    out = rows.groupBy("block", "a", "b").applyInArrow(compare, "arid long, ah long, brid long, bh long")
    return out.selectExpr("struct(arid as rid, ah as h) as a", "struct(brid as rid, bh as h) as b")


def _groups(docs: DataFrame, id_col: str, size: int, similarity: float, by_fingerprint: bool) -> DataFrame:
    """(rid, first): with each row the first (rid, h) of its group. A node is the first (rid, h) of texts of the same words."""
    each = materialize(blocks(docs, id_col, size, by_fingerprint), "blocks")
    unique = materialize(each.groupBy("same").agg(F.min(F.struct("rid", "h")).alias("node"), F.first("keys").alias("keys"), F.first("fp").alias("fp"), F.count("*").alias("n")), "unique")
    keyed = unique.select("node", F.posexplode("keys").alias("band", "key")).select("node", "band", F.xxhash64("band", "key").alias("block"))
    if by_fingerprint:
        keyed = keyed.unionByName(materialize(_fingerprint_blocks(unique), "buckets"))
    sizes = materialize(keyed.groupBy("block").agg(F.count("*").alias("n")).where("n > 1").withColumn("held", F.col("n")), "sizes")
    met = materialize(join_hot(keyed, sizes, "block").select("node", "band", "block", "held"), "met")
    pairs = materialize(_met_first(met), "pairs")
    text = materialize(_texts(docs, id_col, pairs.selectExpr("explode(array(a, b)) as node")).select(F.struct("rid", "h").alias("node"), "text"), "texts")
    both_texts = pairs.join(text.selectExpr("node as a", "text as ta"), "a").join(text.selectExpr("node as b", "text as tb"), "b")
    root = components(verified(both_texts.select("a", "b", "ta", "tb"), size, similarity))
    labelled = unique.select("same", "node", "n").join(root, "node", "left").select("same", "node", "n", F.coalesce("root", "node").alias("comp"))
    labelled = materialize(labelled, "labelled")
    big = met.where(F.col("held") > ALL).join(labelled.select("node", "comp"), "node")
    tiles = materialize(_tiles(big), "tiles")
    if not tiles.isEmpty():
        sets = _shingle_sets(_texts(docs, id_col, tiles.select("node")), size)
        rows = tiles.join(materialize(sets, "sets"), "node").select("block", "band", "a", "b", "own", F.col("comp.rid").alias("crid"), F.col("comp.h").alias("ch"), "keys", "fp", "shingles")
        further = components(materialize(_compared(rows, similarity), "joined"))
        labelled = labelled.join(further.select(F.col("node").alias("comp"), F.col("root").alias("least")), "comp", "left").withColumn("comp", F.coalesce("least", "comp"))
    named = materialize(labelled.select("same", "n", F.col("comp").alias("first")), "named")
    return join_hot(each.select("rid", "same"), named, "same").select("rid", "first")


def _shingle_sets(own: DataFrame, size: int) -> DataFrame:
    """(node, keys, fp, shingles): the band keys, the fingerprint and the sorted distinct shingle names of each text."""

    def run(batch: pa.RecordBatch):
        for lo, hi in slices(batch.column("text"), size=FINE):
            part = batch.slice(lo, hi - lo)
            _, name, first = shingles(part.column("text"), size)
            fp = [signed(fingerprint(t)) for t in texts(part)]
            yield {"rid": part.column("rid"), "h": part.column("h"), "fp": fp, "keys": pa.array(list(minima(name, first).T.view(np.int64)), pa.list_(pa.int64())), "shingles": pa.array([np.unique(name[i:j]).tobytes() for i, j in zip(first[:-1], first[1:], strict=True)], pa.binary())}

    return map_arrow(own, "rid long, h long, keys array<long>, fp long, shingles binary", run).select(F.struct("rid", "h").alias("node"), "keys", "fp", "shingles")


def near_groups(docs: DataFrame, id_col: str = "doc_id", size: int = SIZE, similarity: float = SIMILARITY, by_fingerprint: bool = False) -> DataFrame:
    """Per row: the id and `component_id`, the smallest id that chains of near copies lead to."""
    return _groups(docs, id_col, size, similarity, by_fingerprint).select(real_id().alias(id_col), real_id("first.rid").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", size: int = SIZE, similarity: float = SIMILARITY, by_fingerprint: bool = False) -> DataFrame:
    """One row of each group, that of the smallest id (of texts under one id, of the smallest hash); columns as they are."""
    return keep_first(docs, _groups(docs, id_col, size, similarity, by_fingerprint).select("first"), id_col)
