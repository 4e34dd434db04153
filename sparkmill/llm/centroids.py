"""Centroid clustering (11): Lloyd's rounds on integer vectors, each vector assigned through a vantage-point tree.

Each round builds a tree over the centroids on the driver and sends it to every task (k centroids, a parameter). A vector
searches it best first: the node of the least lower bound is opened next, a leaf compares all its centroids by exact
integer distance, and the search ends once the least bound is beyond the best distance found. The radius is inclusive:
a node whose bound equals it is still opened, as a centroid there may tie and have the smaller number. Bounds are real
numbers and get a margin for rounding; distances and their comparisons are integers. The vectors of a batch take their
steps together, each with bounds of its own.

Tasks pass on their sums by centroid, k rows each, and the driver gets k rows a round. Vectors are written once, as
integers; a round reads them anew, so lineage stays one round long.

Rows: a vector of another length, null, or with a null or non-finite component, is left out, and so is one with a
component beyond 2**27 after scaling, whose distances a long doesn't hold. Rows that repeat an id or a vector count each;
among rows of one id the smaller vector starts first, and null ids start last. Fewer vectors than k: as many centroids. Equal
centroids: the smaller number takes the vectors. Other columns are dropped, whatever their names. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import matrix
from .common import materialize

DIMS, SCALE, K, ROUNDS = 64, 256, 40, 5
#: Components up to which squared distances of DIMS components fit a long.
WIDEST = 1 << 27
#: Centroids of a leaf, and bounds that a batch keeps at once.
LEAF, HELD = 4, 1 << 20


class VantageTree:
    """Inner nodes have a vantage point and two children, each with the span of its points' distances from it."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points = points.astype(np.int64)
        self.vantage: list[int] = []
        self.spans: list[list[tuple[int, float, float]]] = []
        self.leaves: list[list[int]] = []
        work = [(self._node(), np.arange(len(points)))] if len(points) else []
        while work:
            node, own = work.pop()
            if len(own) <= leaf:
                self.leaves[node] = own.tolist()
                continue
            x = self.points[own].astype(float)
            at = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax())
            self.vantage[node] = int(own[at])
            rest = np.delete(own, at)
            far = np.sqrt(((self.points[rest] - self.points[own[at]]) ** 2).sum(axis=1).astype(float))
            order = np.lexsort((rest, far))
            for part in np.array_split(order, min(2, len(order))):
                kid = self._node()
                self.spans[node].append((kid, far[part].min(), far[part].max()))
                work.append((kid, rest[part]))

    def _node(self) -> int:
        self.vantage.append(-1)
        self.spans.append([])
        self.leaves.append([])
        return len(self.vantage) - 1

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance) of each integer vector, and the distances computed."""
        step = max(1, HELD // max(len(self.vantage), 1))
        parts = [self._nearest(x[k : k + step]) for k in range(0, len(x), step)] or [(np.zeros(0, np.int64), np.zeros(0, np.int64), 0)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts)

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        best = np.full(len(x), np.iinfo(np.int64).max)
        who = np.full(len(x), len(self.points))
        bound = np.full((len(x), len(self.vantage)), np.inf)
        bound[:, 0] = 0
        radius = np.full(len(x), np.inf)
        live, computed = np.arange(len(x)), 0

        def compare(rows: np.ndarray, c: int) -> np.ndarray:
            gap = x[rows] - self.points[c]
            d = np.einsum("ij,ij->i", gap, gap)
            better = (d < best[rows]) | ((d == best[rows]) & (c < who[rows]))
            best[rows[better]], who[rows[better]] = d[better], c
            return d

        while len(live):
            node = bound[live].argmin(axis=1)
            low = bound[live, node]
            goes = low <= radius[live]
            goes &= low < np.inf
            live, node, low = live[goes], node[goes], low[goes]
            order = np.argsort(node, kind="stable")
            cut = np.flatnonzero(np.diff(node[order])) + 1
            for part in np.split(order, cut) if len(order) else []:
                rows, k = live[part], int(node[part[0]])
                bound[rows, k] = np.inf
                for c in self.leaves[k]:
                    compare(rows, c)
                computed += len(rows) * len(self.leaves[k])
                if self.vantage[k] >= 0:
                    far = np.sqrt(compare(rows, self.vantage[k]).astype(float))
                    computed += len(rows)
                    for kid, lo, hi in self.spans[k]:
                        bound[rows, kid] = np.maximum(low[part], np.maximum(far - hi, lo - far))
                real = np.sqrt(best[rows].astype(float))
                radius[rows] = real + 1e-9 * (1 + real)
        return who, best, computed


def integers(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part: floor(scale * x) of each component."""
    x = F.col("x")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")).where(F.size(x) == dims)
    whole = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * scale) > WIDEST))
    return rows.where(whole).select("vec_id", F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def starts(rows: DataFrame, k: int = K, salt: str = "2:") -> np.ndarray:
    """The k vectors with the smallest sha256 of salt and id, in its order."""
    place = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(place.asc_nulls_last(), "v").limit(k).select("v").collect()  # k rows
    return np.array([r.v for r in first], dtype=np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors goes to the floor of their mean, by component."""
    tree, k, dims = VantageTree(centroids), len(centroids), centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            x = matrix(b.column("v"), dims)
            who, _, _ = tree.nearest(x)
            np.add.at(total, who, x)
            n += np.bincount(who, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    part = rows.select("v").mapInArrow(sums, "cluster long, n long, total array<long>")
    whole = part.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(dims)]).alias("total"))
    out = centroids.copy()
    for r in whole.collect():  # k rows
        out[r.cluster] = [s // r.n for s in r.total]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    tree, dims = VantageTree(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, d, _ = tree.nearest(matrix(b.column("v"), dims))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(who, pa.int32()), pa.array(d)], names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def fit(rows: DataFrame, k: int = K, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after the rounds; rows (vec_id, v) are read once a round, so they should be a written table."""
    centroids = starts(rows, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    return centroids


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, id_col: str = "vec_id", column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """Per vector: vec_id, cluster, distance, the inertia of its cluster and of all, and a digest of its centroid."""
    spark = vectors.sparkSession
    rows = materialize(integers(vectors, id_col, column, dims, scale), "integers")
    centroids = fit(rows, k, rounds)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    each = materialize(assigned(rows, centroids), "assigned")
    own = each.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    named = [(r.cluster, r.s, sum(x.s for x in own), digest[r.cluster]) for r in own]
    of = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return each.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = K, rounds: int = ROUNDS) -> str:
    """DuckDB's SQL for the query: every vector against every centroid."""
    assign = "SELECT vec_id, arg_min(c, d * 1000 + c) AS c, min(d) AS d, any_value(v) AS v FROM (SELECT r, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, {c}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept CROSS JOIN {c}) GROUP BY r, vec_id"
    steps = [
        f"kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept QUALIFY c < {k})",
    ]
    for n in range(rounds):
        steps.append(f"a{n} AS MATERIALIZED ({assign.format(c=f'c{n}')})")
        steps.append(f"m{n} AS MATERIALIZED (SELECT c, list(m ORDER BY i) AS v FROM (SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{n}, range(1, {DIMS + 1}) t(i) GROUP BY c, i)) GROUP BY c)")
        steps.append(f"c{n + 1} AS MATERIALIZED (SELECT c{n}.c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (c))")
    last = f"a{rounds} AS MATERIALIZED ({assign.format(c=f'c{rounds}')})"
    return f"WITH {', '.join(steps)}, {last} SELECT vec_id, a{rounds}.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{rounds}.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON a{rounds}.c = c{rounds}.c"
