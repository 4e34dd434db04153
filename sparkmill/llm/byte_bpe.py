"""Byte-level BPE encoding and decoding (9), two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves every pre-token that is itself a token. Tier two: the
misses are merged with a heap of ranks over a linked list of bytes. Decoding joins the tokens' bytes.

Rows: a null text counts as empty and has no tokens; whole texts of any length; repeated rows give repeated results;
columns other than the id and the text are dropped, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .common import map_arrow, mix, real_id, texts, with_id
from .pretokens import PRETOKEN

#: Characters of text that are looked up together, and misses that a worker remembers; results don't depend on either.
CHUNK, MEMO = 1 << 20, 400_000


class PerfectHash:
    """Minimal perfect hash by hash and displace: a bucket's displacement sends its keys to slots of their own."""

    def __init__(self, keys: list[bytes]) -> None:
        self.n = len(keys)
        self.keys: list[bytes] = [b""] * self.n
        self.value = np.zeros(self.n, dtype=np.int64)
        self.shift = np.zeros(max(1, self.n // 3), dtype=np.uint64)
        h = self.hashes(keys)
        bucket = (h % np.uint64(len(self.shift))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if self.n else []
        taken = np.zeros(self.n, dtype=bool)
        free = None
        for members in sorted(groups, key=len, reverse=True):
            if len(members) == 1:  # the rest go to the free slots, named outright by an odd displacement
                free = np.flatnonzero(~taken)[::-1].tolist() if free is None else free
                slots, d = np.array([free.pop()]), 0
                self.shift[bucket[members[0]]] = 2 * slots[0] + 1
            else:
                d = 0
                while True:
                    slots = mix(h[members] + np.uint64(d)) % np.uint64(self.n)
                    if len(set(slots.tolist())) == len(members) and not taken[slots].any():
                        break
                    d += 1
                self.shift[bucket[members[0]]] = 2 * d
            taken[slots] = True
            for k, s in zip(members.tolist(), slots.tolist(), strict=True):
                self.keys[s], self.value[s] = keys[k], k

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))

    def find(self, keys: list[bytes]) -> list[int]:
        """The position of each key in the list it was built from, or -1."""
        if not self.n or not keys:
            return [-1] * len(keys)
        h = self.hashes(keys)
        d = self.shift[h % np.uint64(len(self.shift))]
        slot = np.where(d & np.uint64(1), d >> np.uint64(1), mix(h + (d >> np.uint64(1))) % np.uint64(self.n)).astype(np.int64)
        own = self.keys
        return [v if own[s] == k else -1 for s, v, k in zip(slot.tolist(), self.value[slot].tolist(), keys, strict=True)]


class ByteBPE:
    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        words = list(self.rank)
        self.ids = [self.rank[w] for w in words]
        self.hash = PerfectHash(words)
        self.token = {i: w for w, i in self.rank.items()}
        self.decimal = {i: b"%d" % i for i in self.ids}
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """BPE of one pre-token: the pair of the least rank, the leftmost first, from a heap; parts are linked by their ends."""
        rank, n = self.rank, len(raw)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(raw[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, e = heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != e:
                continue  # one of its parts is gone
            end[i], end[j], before[e] = e, 0, i
            if e < n and (r := rank.get(raw[i : end[e]])) is not None:
                heappush(heap, (r, i, end[e]))
            if i and (r := rank.get(raw[before[i] : e])) is not None:
                heappush(heap, (r, before[i], e))
        out, i = [], 0
        while i < n:
            out.append(rank[raw[i : end[i]]])
            i = end[i]
        return tuple(out)

    def resolve(self, pieces: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct pre-tokens: the perfect hash first, then the heap."""
        ids, memo, out = self.ids, self.memo, {}
        raws = [p.encode() for p in pieces]
        for piece, raw, k in zip(pieces, raws, self.hash.find(raws), strict=True):
            if k >= 0:
                out[piece] = (ids[k],)
            else:
                known = memo.get(piece)
                if known is None:
                    known = self.merge(raw)
                    if len(memo) > MEMO:
                        memo.clear()
                    if len(piece) <= 64:
                        memo[piece] = known
                out[piece] = known
        return out

    def encode(self, many: list[str]) -> list[list[int]]:
        split = [PRETOKEN.findall(t) for t in many]
        found = self.resolve(list(set().union(*split)))
        return [list(chain.from_iterable(map(found.__getitem__, s))) for s in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


def chunks(many: list[str], size: int = CHUNK):
    """Runs of texts of about `size` characters; a longer text stays whole."""
    out, n = [], 0
    for t in many:
        out.append(t)
        n += len(t)
        if n >= size:
            yield out
            out, n = [], 0
    if out:
        yield out


def encode(docs: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids array<int>) of each text."""

    def run(batch):
        return {"rid": batch.column("rid"), "ids": [x for part in chunks(texts(batch)) for x in bpe(path).encode(part)]}

    return map_arrow(with_id(docs, id_col), "rid long, ids array<int>", run).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) from (id, ids); bytes that aren't UTF-8 by themselves become U+FFFD."""

    def run(batch):
        return {id_col: batch.column(id_col), "text": [bpe(path).decode(x or []).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]}

    return map_arrow(encoded.select(id_col, "ids"), f"`{id_col}` long, text string", run)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Encodes and decodes each text: tokens, and digests of the ids and of the decoded bytes."""

    def run(batch):
        rows = []
        for part in chunks(texts(batch)):
            for own in bpe(path).encode(part):
                named = b",".join(map(bpe(path).decimal.__getitem__, own))
                rows.append((len(own), hashlib.sha256(named).hexdigest(), hashlib.sha256(bpe(path).decode(own)).hexdigest()))
        n, a, b = np.array(rows, dtype=object).T.tolist() if rows else ([], [], [])
        return {"rid": batch.column("rid"), "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

    return map_arrow(with_id(docs, id_col), "rid long, n_tokens long, ids_sha256 string, decoded_sha256 string", run).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)
