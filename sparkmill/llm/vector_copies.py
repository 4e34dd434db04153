"""Embedding near-dedup (12): vectors of one label linked by their cosine, compared tile by tile in PCA order.

Unit vectors are turned into the basis of their second moments, computed over all of them, largest first. Each label's
vectors are dealt into tiles of about `TILE` by ranges of the first coordinate (its approximate quantiles; a hash breaks ties),
and a vector is sent to those tiles only that lie within sqrt(2 - 2 t) of it, as vectors of cosine t are no farther apart.
Two tiles compare leading coordinates first; the product of the norms of what is left bounds the rest, and a pair stops
as soon as its cosine can't reach t. What remains is computed again on the vectors as they are, in double precision.

A pair of tiles gives a row for each vector that links there: how many vectors it links with and the least vector of its
chain, not the pairs; so a group of n near copies makes n rows a tile, not n * n. Equal vectors of a label are one node
with a weight. Labels with more than `MOST` tiles' rows get larger tiles; a task still holds two tiles only and works
them off in squares of `TILE`. Within a label the comparisons grow with the square of its distinct vectors as far as
their first coordinates lie close; that is the limit of this method.

Rows: a vector that is null, empty, zero or has a null or non-finite component, or a null label, links with nothing and is
its own component. Only vectors of equal length are compared. Rows that repeat an id are vectors each. A component of null
ids only has a null component_id, and its rows aren't kept. Other columns are dropped, whatever their names. An empty
table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import matrix
from .common import NULL_ID, join_hot, materialize, real_id
from .components import components

SIMILARITY = 0.93
#: Vectors of a tile, and tiles of a label at most.
TILE, MOST = 512, 1024
#: For rounding in bounds, and the width of the hash that breaks ties of the first coordinate.
MARGIN = 1e-9


def rows_of(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """(rid, part, v, same): the id, or NULL_ID; label and length; the vector, null if it takes no part; a 128-bit name of
    part and vector."""
    v = F.col("v")
    rows = vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("rid"), F.col(label).cast("string").alias("label"), F.col(column).cast("array<double>").alias("v"))
    good = F.col("label").isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.withColumn("v", F.when(good, F.transform(v, lambda x: x + 0.0)))
    rows = rows.withColumn("part", F.concat(F.size("v").cast("string"), F.lit(":"), F.col("label")))
    return rows.withColumn("same", F.struct(F.xxhash64("part", "v").alias("h"), F.xxhash64(F.lit(1), "v", "part").alias("g")))


def unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def basis(nodes: DataFrame, dims: int) -> np.ndarray:
    """The eigenvectors of the second moments of all unit vectors of a length, largest first, as columns."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            if len(b):
                u = unit(matrix(b.column("v"), dims))
                total += u.T @ u
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "x"])

    part = nodes.where(F.size("v") == dims).select("v").mapInArrow(moments, "i long, j long, x double")
    out = np.zeros((dims, dims))
    for r in part.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():  # dims * (dims + 1) / 2 rows
        out[r.i, r.j] = out[r.j, r.i] = r.x
    return np.linalg.eigh(out)[1][:, ::-1]


def first_coordinate(nodes: DataFrame, dims: int, turn: np.ndarray) -> DataFrame:
    """With `x`: the first coordinate of the unit vector; for vectors of another length than dims, its first component."""
    axis = turn[:, 0].copy() if len(turn) else turn

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, off = b.column("v").flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(b.column("v").value_lengths().to_numpy(zero_copy_only=False))]
            x, size = np.zeros(len(b)), np.diff(off)
            for d in np.unique(size).tolist():
                own = np.flatnonzero(size == d)
                u = unit(flat[off[own][:, None] + np.arange(d)])
                x[own] = u @ axis if d == dims else u[:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(x)], names=[*b.schema.names, "x"])

    schema = ", ".join(f"`{c}` {t}" for c, t in nodes.dtypes)
    return nodes.mapInArrow(run, f"{schema}, x double")


def dealt(placed: DataFrame, reach: float, tile: int = TILE, most: int = MOST) -> DataFrame:
    """A row of each node for each two tiles (a, b) of its part that it can link in; `own`: the one it lies in."""
    jitter = F.pmod(F.xxhash64("same.h", F.lit(5)), F.lit(1 << 30)) / float(1 << 30) * MARGIN
    rows = placed.withColumn("x", F.col("x") + jitter)
    cuts = rows.groupBy("part").agg(F.count("*").alias("n"), F.percentile_approx("x", [k / most for k in range(1, most)], 100_000).alias("cuts"))
    tiles = F.least(F.lit(most), F.ceil(F.col("n") / tile)).cast("int")
    inner = F.when(tiles > 1, F.transform(F.sequence(F.lit(1), tiles - 1), lambda k: F.element_at("cuts", F.floor(k * most / tiles).cast("int"))))
    cuts = materialize(cuts.select("part", "n", F.array_distinct(F.coalesce(inner, F.array().cast("array<double>"))).alias("cuts")), "cuts")
    width = reach + 4 * MARGIN
    below = lambda c: F.size(F.filter("cuts", lambda e: e < c))
    x = F.col("x")
    own = join_hot(rows, cuts, "part").select("rid", "same", "part", "w", "v", below(x).alias("own"), F.explode(F.sequence(below(x - width), below(x + width))).alias("other"))
    return own.select("rid", "same", "part", "w", "v", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))


def close(u: np.ndarray, v: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The (row of u, row of v) of turned unit vectors whose product may reach `least`: leading coordinates first, then
    more of them for the pairs that the norms of the rest still allow."""
    dims = u.shape[1]
    edge = sorted({max(1, dims * k // 8) for k in (2, 3, 4, 6, 8)})
    rest = lambda x: np.sqrt(np.maximum(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1], 0))
    su, sv = (np.hstack([rest(x), np.zeros((len(x), 1))]) for x in (u, v))
    s = u[:, : edge[0]] @ v[:, : edge[0]].T
    i, j = np.nonzero(s + np.outer(su[:, edge[0]], sv[:, edge[0]]) >= least - MARGIN)
    s = s[i, j]
    for lo, hi in zip(edge, edge[1:], strict=False):
        s = s + np.einsum("ij,ij->i", u[i, lo:hi], v[j, lo:hi])
        still = s + su[i, hi] * sv[j, hi] >= least - MARGIN
        i, j, s = i[still], j[still], s[still]
    return i, j


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, each sum in the order of the components."""
    x, y = (z / np.abs(z).max(axis=1, keepdims=True) for z in (x, y))
    dot, nx, ny = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
    for d in range(x.shape[1]):
        dot += x[:, d] * y[:, d]
        nx += x[:, d] * x[:, d]
        ny += y[:, d] * y[:, d]
    return dot / (np.sqrt(nx) * np.sqrt(ny))


def chains(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least node that links (i, j) lead each of n nodes to."""
    root = np.arange(n)
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root != root[root]).any():
            root = root[root]


def links(rows: DataFrame, dims: int, turn: np.ndarray, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """(rid, h, n, root_rid, root_h): for two tiles and each node that links there, the vectors it links with and the least
    node of its chain."""
    names = ["rid", "h", "n", "root_rid", "root_h"]

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        order = np.lexsort((t["h"].to_numpy(), t["rid"].to_numpy()))
        t = t.take(pa.array(order))
        rid, h, w, own = (t[c].to_numpy() for c in ("rid", "h", "w", "own"))
        a, b = t["a"][0].as_py(), t["b"][0].as_py()
        v = t["v"].combine_chunks()
        x = matrix(v.chunk(0) if isinstance(v, pa.ChunkedArray) else v, len(t["v"][0]))
        u = unit(x)
        u = u @ turn if x.shape[1] == dims else u
        left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
        n, root = np.zeros(len(rid), dtype=np.int64), np.arange(len(rid))
        for p in range(0, len(left), tile):
            for q in range(p if a == b else 0, len(right), tile):
                lp, rq = left[p : p + tile], right[q : q + tile]
                i, j = close(u[lp], u[rq], similarity)
                i, j = lp[i], rq[j]
                once = i < j if a == b else i != j
                i, j = i[once], j[once]
                for k in range(0, len(i), 1 << 16):
                    hold = cosines(x[i[k : k + (1 << 16)]], x[j[k : k + (1 << 16)]]) >= similarity
                    gi, gj = i[k : k + (1 << 16)][hold], j[k : k + (1 << 16)][hold]
                    np.add.at(n, gi, w[gj])
                    np.add.at(n, gj, w[gi])
                    root = _joined(root, gi, gj)
        some = np.flatnonzero(n)
        top = root[some]
        return pa.table([pa.array(c) for c in (rid[some], h[some], n[some], rid[top], h[top])], names=names)

    own = rows.select("part", "a", "b", "own", "rid", F.col("same.h").alias("h"), "w", "v")
    return own.groupBy("part", "a", "b").applyInArrow(compare, "rid long, h long, n long, root_rid long, root_h long")


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Chains that further links join; roots are the least nodes."""
    own = np.arange(len(root))
    return chains(np.r_[own, i], np.r_[root, j], len(root))


def near_groups(vectors: DataFrame, similarity: float = SIMILARITY, id_col: str = "vec_id", column: str = "embedding", label: str = "label", tile: int = TILE) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    each = materialize(rows_of(vectors, id_col, column, label), "vectors")
    good = each.where("v is not null")
    nodes = good.groupBy("same").agg(F.min("rid").alias("rid"), F.first("part").alias("part"), F.first("v").alias("v"), F.count("*").alias("w"))
    nodes = materialize(nodes, "nodes")
    common = nodes.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = common.d if common else 0
    turn = basis(nodes, dims) if dims else np.zeros((0, 0))
    reach = float(np.sqrt(max(0.0, 2 - 2 * similarity)))
    met = materialize(links(dealt(first_coordinate(nodes, dims, turn), reach, tile), dims, turn, similarity, tile), "links")
    node = F.struct("rid", "h")
    edges = met.select(node.alias("a"), F.struct(F.col("root_rid").alias("rid"), F.col("root_h").alias("h")).alias("b"))
    root = components(edges).select(F.col("node.rid").alias("rid"), F.col("node.h").alias("h"), F.col("root.rid").alias("root"))
    count = met.groupBy("rid", "h").agg(F.sum("n").alias("n"))
    own = nodes.select("same", "rid", F.col("same.h").alias("h"), "w")
    named = own.join(count, ["rid", "h"], "left").join(root, ["rid", "h"], "left")
    named = materialize(named.select("same", F.col("w").alias("n"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("root", "rid").alias("root")), "named")
    linked = join_hot(good.select("rid", "same"), named, "same").select("rid", "n_links", "root")
    alone = each.where("v is null").select("rid", F.lit(0).cast("long").alias("n_links"), F.col("rid").alias("root"))
    out = linked.unionByName(alone)
    return out.select(real_id().alias("vec_id"), "n_links", real_id("root").alias("component_id"), ((F.col("rid") == F.col("root")) & (F.col("rid") < NULL_ID)).alias("kept"))


#: DuckDB's SQL for the query: every two vectors of a label.
ORACLE = f"""
WITH RECURSIVE v AS MATERIALIZED (
    SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS s
    FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.s * b.s) >= {SIMILARITY}
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
