"""Approximate nearest neighbours (10): a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (`SAMPLE` vectors of the smallest hash of their id), BRANCH children a node, until
a node has few sampled vectors. Then every vector is put into its leaf, and leaves of more than `LEAF_ROWS` are split
further in Spark, each by a bounded sample of its own (`SPLIT`), until none is larger or there are `MOST_LEAVES`. A
search holds the nodes it has not opened in a priority queue, by the inner product of the query with the node's centre,
opens the best, and so reaches leaves in an order; it visits the first `visits` of them, and on until these hold k
candidates. `visits` is calibrated: for a sample of queries the exact neighbours among all vectors are found, and visits
widen until the wanted share of them lies in the leaves visited. Leaves are dealt by subtrees of at most `GROUP_ROWS`
vectors; a query is sent once to each subtree in which it visits leaves, with their names. It goes to the subtree of its
best leaf first, then in turns to eight times as many; only what isn't worse than the best found so far comes back.

Equal queries are searched once, whatever their ids, for so many rows that k are left without those of any one id: k and
as many as the most frequent id has (`keep`), of which k of one id at most. Of equal vectors only the k + 1 smallest ids,
k rows each, can be among the k nearest, so the index holds these; one frequent vector fills no leaf and no task.

Scores are inner products in double precision, summed in one order for every pair, so equal vectors tie exactly.

Rows: vectors that are null, empty, zero or hold null or non-finite components, or have a null id, take no part; nor do
those whose length differs from the most frequent one. Rows that repeat an id are candidates each, but for a query of
that id. Fewer candidates than k: all of them. Other columns are dropped, whatever their names. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, join_hot, materialize

BRANCH, LEAF, SAMPLE, CALIBRATION = 8, 100, 20_000, 64
#: Vectors of a leaf beyond which it is split, vectors it is then fitted on, leaves at most (their centres are sent to
#: every task), and vectors of a subtree that one group holds.
LEAF_ROWS, SPLIT, MOST_LEAVES, GROUP_ROWS = 1024, 1000, 1 << 17, 4096


def usable(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vid, v array<double>) of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vid"), F.col(column).cast("array<double>").alias("v")).where("vid is not null and size(v) > 0")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists(v, lambda x: x != 0))


class Tree:
    """The children of each inner node and their centres, a row each. A leaf is named by its node."""

    def __init__(self, sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 7) -> None:
        self.children: list[np.ndarray | None] = [None]
        self.centres: dict[int, np.ndarray] = {}
        rng = np.random.default_rng(seed)
        work = [(0, sample)]
        while work:
            node, x = work.pop()
            if len(x) > leaf:
                label, centres = kmeans(x, branch, rng)
                used = [c for c in range(len(centres)) if (label == c).any()]
                work += [(kid, x[label == c]) for kid, c in zip(self.split(node, centres[used]), used, strict=True)]

    def split(self, node: int, centres: np.ndarray) -> list[int]:
        """Gives a leaf children, unless there are fewer than two."""
        if len(centres) < 2:
            return []
        kids = np.arange(len(self.children), len(self.children) + len(centres))
        self.children[node], self.centres[node] = kids, centres
        self.children += [None] * len(centres)
        return kids.tolist()

    @property
    def n_leaves(self) -> int:
        return sum(c is None for c in self.children)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down the tree to the nearest centre."""
        out = np.zeros(len(x), dtype=np.int64)
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            kids = self.children[node]
            if kids is None:
                out[rows] = node
                continue
            c = self.centres[node]
            near = (x[rows] @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
            work += [(int(k), rows[near == i]) for i, k in enumerate(kids) if (near == i).any()]
        return out

    def visit(self, q: np.ndarray, size: dict[int, int], visits: int, least: int = 0) -> list[int]:
        """The first leaves that hold vectors, best bin first: `visits` of them, and on until they hold `least`."""
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < visits or held < least):
            _, node = heappop(queue)
            kids = self.children[node]
            if kids is None:
                if node in size:
                    out.append(node)
                    held += size[node]
            else:
                for x, k in zip((-(self.centres[node] @ q)).tolist(), kids.tolist(), strict=True):
                    heappush(queue, (x, k))
        return out

    def groups(self, size: dict[int, int], most: int) -> dict[int, int]:
        """The subtree that each leaf belongs to: the largest around it that holds at most so many vectors, or the leaf."""
        total = [size.get(k, 0) for k in range(len(self.children))]
        for node in range(len(self.children) - 1, -1, -1):  # children come after their node
            if self.children[node] is not None:
                total[node] = sum(total[k] for k in self.children[node].tolist())
        out: dict[int, int] = {}
        work = [(0, -1)]
        while work:
            node, group = work.pop()
            group = node if group < 0 and total[node] <= most else group
            if self.children[node] is None:
                out[node] = group if group >= 0 else node
            else:
                work += [(k, group) for k in self.children[node].tolist()]
        return out


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        label = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        n = np.bincount(label, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, label, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1), c


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def nearest_in(near: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int, worst: np.ndarray | None = None, of_one: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of each query's k nearest among some vectors, ties to smaller ids; of_one: of an id
    that repeats only so many.

    near: matrix products of queries and vectors, minus infinity where a query doesn't look. They propose all that come
    near the k-th score, or near `worst`; only those are scored again, each sum in one order."""
    near_enough = near > -np.inf
    if worst is not None:
        near_enough &= near >= np.where(worst > -np.inf, worst - 1e-9 * (1 + np.abs(worst)), worst)[:, None]
    if len(vid) > k and of_one is None:
        least = np.partition(near, len(vid) - k, axis=1)[:, len(vid) - k]
        near_enough &= near >= (least - 1e-9 * (1 + np.abs(least)))[:, None]
    row, col = np.nonzero(near_enough)
    score = np.zeros(len(row))
    for d in range(q.shape[1]):
        score += q[row, d] * v[col, d]
    order = np.lexsort((vid[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    if of_one is not None:
        by_id = np.lexsort((np.arange(len(row)), vid[col], row))
        begins = np.r_[True, (np.diff(row[by_id]) != 0) | (np.diff(vid[col][by_id]) != 0)][: len(row)]
        run = np.arange(len(row)) - np.maximum.accumulate(np.where(begins, np.arange(len(row)), 0)) if len(row) else np.zeros(0, dtype=np.int64)
        stays = np.sort(by_id[run < of_one])
        row, col, score = row[stays], col[stays], score[stays]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k], score[place < k]


HITS = "query_id long, vec_id long, score double"


def exact(vectors: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """Candidates for the k nearest of a stated, bounded set of queries, against all rows: the best of each batch."""
    dims = q.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vid, leaf, v = batch.column("vid").to_numpy(), batch.column("leaf").to_numpy(), matrix(batch.column("v"), dims)
            row, col, score = nearest_in(q @ v.T, q, vid, v, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(vid[col]), pa.array(score), pa.array(leaf[col])], names=["query_id", "vec_id", "score", "leaf"])

    return vectors.mapInArrow(run, HITS + ", leaf long")


def nearest(hits: DataFrame, k: int, of_one: int | None = None) -> DataFrame:
    """The k best of each query: largest score, then smallest id; of_one: of one id only so many."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    if of_one is not None:
        hits = hits.withColumn("own", F.row_number().over(Window.partitionBy("query_id", "vec_id").orderBy(F.col("score").desc()))).where(F.col("own") <= of_one).drop("own")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _turn(place: int, first: int) -> int:
    """When a query visits the subtree that stands at a place in its order: the first ones at once, then eight times as
    many each time, so that what comes back from the many is held against the best of the few before."""
    return 0 if place < first else 1 + (place.bit_length() - 1) // 3


class Index:
    """Every usable vector with its leaf, the tree, and the number of visits that reached the recall.

    `rows` has all usable vectors, `leaves` those that can be found, `size` the vectors of each leaf."""

    def __init__(self, vectors: DataFrame, k: int = 20, recall: float = 0.95, id_col: str = "vec_id", column: str = "embedding", sample_rows: int = SAMPLE) -> None:
        rows = usable(vectors, id_col, column)
        length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
        self.k, self.visits, self.tree, self.size, self.spark = k, 0, None, {}, vectors.sparkSession
        self.dims = length.d if length else 0
        self.rows = rows = rows.where(F.size("v") == self.dims)
        if not length:
            return
        copies = Window.partitionBy("v").orderBy("vid")
        again = Window.partitionBy("v", "vid").orderBy(F.lit(1))
        own = rows.withColumn("place", F.dense_rank().over(copies)).where(F.col("place") <= k + 1).withColumn("place", F.row_number().over(again)).where(F.col("place") <= k)
        own = materialize(own.drop("place"), "vectors")
        n = own.count()
        repeat = own.groupBy("vid").count().agg(F.max("count")).first()[0]
        self.keep, self.of_one = k + min(k, repeat), k if repeat > k else None
        some = bounded_sample(own, ["vid"], sample_rows, n).toArrow()
        self.tree = Tree(np.unique(matrix(some.column("v").combine_chunks(), self.dims), axis=0))
        self.leaves = self._deepened(own)
        asked = bounded_sample(self.leaves.withColumn("salt", F.lit(2)), ["vid", "salt"], CALIBRATION, n).toArrow()
        ids, q = asked.column("vid").to_numpy(), matrix(asked.column("v").combine_chunks(), self.dims)
        found = nearest(exact(self.leaves, np.arange(len(ids)), q, k + 1), k + 1).select("query_id", "vec_id", "leaf").collect()  # CALIBRATION * (k + 1) rows at most
        place = [{leaf: at for at, leaf in enumerate(self.tree.visit(x, self.size, len(self.size)))} for x in q]
        need = np.sort([place[r.query_id][r.leaf] + 1 for r in found if r.vec_id != ids[r.query_id]] or [1])
        self.visits = int(need[min(len(need) - 1, int(np.ceil(recall * len(need))))])

    def _deepened(self, own: DataFrame) -> DataFrame:
        """Splits leaves until none has more than LEAF_ROWS; (vid, v, leaf)."""
        dims, spent = self.dims, set()
        while True:
            tree = self.tree

            def put(batches: Iterator[pa.RecordBatch], tree=tree) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.assign(matrix(b.column("v"), dims)), pa.int64())], names=["vid", "v", "leaf"])

            leaves = materialize(own.mapInArrow(put, "vid long, v array<double>, leaf long"), "leaves")
            self.size = {r.leaf: r["count"] for r in leaves.groupBy("leaf").count().collect()}  # MOST_LEAVES rows at most
            large = [(k, min(1.0, 1.5 * SPLIT / n)) for k, n in self.size.items() if n > LEAF_ROWS and k not in spent]
            if not large or tree.n_leaves + BRANCH * len(large) > MOST_LEAVES:
                return leaves
            spent |= {k for k, _ in large}
            share = F.broadcast(self.spark.createDataFrame(large, "leaf long, share double"))
            some = leaves.join(share, "leaf").where(F.pmod(F.xxhash64("vid", F.lit(3)), F.lit(1 << 30)) < F.col("share") * (1 << 30))

            def centres(f: pd.DataFrame) -> pd.DataFrame:
                x = np.unique(np.stack(f["v"].to_numpy()), axis=0)
                label, c = kmeans(x, BRANCH, np.random.default_rng(7))
                used = np.unique(label)
                return pd.DataFrame({"leaf": f["leaf"].iloc[0], "centre": list(c[used])})

            new: dict[int, list] = {}
            for r in some.select("leaf", "v").groupBy("leaf").applyInPandas(centres, "leaf long, centre array<double>").collect():  # BRANCH rows a leaf
                new.setdefault(r.leaf, []).append(r.centre)
            for k in sorted(new):
                tree.split(k, np.array(sorted(new[k])))

    def search(self, queries: DataFrame, k: int | None = None) -> DataFrame:
        """(query_id, rank, vec_id, score) for queries (vid, v)."""
        k = min(k or self.k, self.k)
        if self.tree is None:
            return queries.selectExpr("vid as query_id", "1 as rank", "vid as vec_id", "0D as score").where("false")
        asked = materialize(queries.groupBy("v").agg(F.count("*").alias("n")).withColumn("vid", F.monotonically_increasing_id()), "asked")
        groups = len(set(self.tree.groups(self.size, GROUP_ROWS).values()))
        hits = None
        for turn in range(_turn(groups - 1, 1) + 1):
            if hits is None:
                worst = asked.select("vid", "v", F.lit(float("-inf")).alias("worst"))
            else:
                least = hits.groupBy(F.col("query_id").alias("vid")).agg(F.when(F.count("*") >= self.keep, F.min("score")).otherwise(float("-inf")).alias("worst"))
                worst = asked.select("vid", "v").join(least, "vid")
            new = self._answers(worst, self.keep, turn)
            hits = materialize(nearest(new if hits is None else hits.unionByName(new), self.keep, self.of_one).drop("rank"), "hits")
        best = nearest(hits, self.keep).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("hits"))
        named = materialize(asked.join(best.withColumnRenamed("query_id", "vid"), "vid").select("v", "n", "hits"), "answers")
        out = join_hot(queries.select(F.col("vid").alias("query_id"), "v"), named, "v")
        others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
        return out.select("query_id", F.posexplode(others).alias("at", "hit")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")

    def _answers(self, asked: DataFrame, k: int, turn: int) -> DataFrame:
        """The k nearest of each query (vid, v, worst) in each subtree it visits at this turn, that aren't worse than `worst`."""
        tree, visits, size, dims, of_one = self.tree, self.visits, self.size, self.dims, self.of_one
        group_of = tree.groups(size, GROUP_ROWS)

        def open_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                group, names, at = [], [], []
                for i, x in enumerate(matrix(b.column("v"), dims)):
                    own: dict[int, list[int]] = {}
                    for leaf in tree.visit(x, size, visits, k):
                        own.setdefault(group_of[leaf], []).append(leaf)
                    held, n = 0, 0  # the groups that are asked first
                    for leaves in own.values():
                        if held >= k:
                            break
                        held, n = held + sum(size[leaf] for leaf in leaves), n + 1
                    chosen = [x for j, x in enumerate(own.items()) if _turn(j, n) == turn]
                    group += [g for g, _ in chosen]
                    names += [np.array(leaves, dtype=np.int64).tobytes() for _, leaves in chosen]
                    at += [i] * len(chosen)
                idx = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.array([-1] * len(at), pa.int64()), b.column("vid").take(idx), b.column("v").take(idx), pa.array(names, pa.binary()), b.column("worst").take(idx)], names=["group", "leaf", "vid", "v", "names", "worst"])

        def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                group = pa.array([group_of[x] for x in b.column("leaf").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([group, b.column("leaf"), b.column("vid"), b.column("v"), pa.nulls(len(b), pa.binary()), pa.nulls(len(b), pa.float64())], names=["group", "leaf", "vid", "v", "names", "worst"])

        schema = "group long, leaf long, vid long, v array<double>, names binary, worst double"
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        both = self.leaves.select("vid", "v", "leaf").mapInArrow(held, schema).unionAll(asked.select("vid", "v", "worst").mapInArrow(open_leaves, schema))
        dealt = both.repartition(parts, "group").sortWithinPartitions("group", F.desc("leaf"), "vid")

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group, parts_, place, vid, v = None, [], {}, None, None
            for b in batches:
                if not len(b):
                    continue
                of, leaf, ids, x = (*(b.column(c).to_numpy() for c in ("group", "leaf", "vid")), matrix(b.column("v"), dims))
                worst = b.column("worst").to_numpy(zero_copy_only=False)
                cut = np.r_[0, np.flatnonzero((np.diff(of) != 0) | (np.diff(leaf < 0))) + 1, len(of)]
                for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    if of[lo] != group:
                        group, parts_, vid = of[lo], [], None
                    if leaf[lo] >= 0:
                        parts_.append((leaf[lo:hi], ids[lo:hi], x[lo:hi]))
                        continue
                    if vid is None:
                        name, vid, v = (np.concatenate(c) for c in zip(*parts_, strict=True))
                        begins = np.flatnonzero(np.r_[True, np.diff(name) != 0])
                        place = {int(name[i]): slice(i, j) for i, j in zip(begins.tolist(), [*begins[1:].tolist(), len(name)], strict=True)}
                    for at in range(lo, hi, 256):
                        end = min(hi, at + 256)
                        q, asks = x[at:end], [np.frombuffer(n, dtype=np.int64).tolist() for n in b.column("names").slice(at, end - at).to_pylist()]
                        askers: dict[int, list[int]] = {}
                        for i, names in enumerate(asks):
                            for n in names:
                                askers.setdefault(n, []).append(i)
                        near = np.full((len(q), len(vid)), -np.inf)
                        for n, rows in askers.items():
                            near[rows, place[n]] = q[rows] @ v[place[n]].T
                        row, col, score = nearest_in(near, q, vid, v, k, worst[at:end], of_one)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[at:end][row]), pa.array(vid[col]), pa.array(score)], names=["query_id", "vec_id", "score"])

        return dealt.mapInArrow(answer, HITS)
