"""Token counts (4): prefix dynamic programming stores the exact token count at every prefix of a text.

A sequence of byte-level BPE tokens is what BPE makes of its bytes exactly if each pair of neighbours is what BPE makes
of the pair's bytes. So the last token of a prefix's encoding is the one vocabulary token that ends the prefix and fits
the last token of the shorter prefix before it: one step of dynamic programming a byte, with counts that add one. The
table is kept as a trie over prefixes of pre-tokens, as words share beginnings.

Truncation and budget questions (`n_tokens` of any prefix, longest prefix within a budget) are read from the table.

Rows: a null text counts as empty; an empty text has no tokens. Texts of any length are taken whole. Repeated rows give
repeated results. Columns other than the id and the text are dropped, whatever their names. An empty table gives none.
"""

from __future__ import annotations

import functools
import json
from array import array
from itertools import accumulate

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_arrow, real_id, texts, with_id
from .pretokens import PRETOKEN, UNIT

SCHEMA = "rid long, n_bytes long, n_tokens long, cut_chars long"
#: Entries that a worker's tables keep at most before they start afresh; results don't depend on it.
CACHE = 400_000


def byte_symbols() -> list[str]:
    """The printable characters that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


SPACE = regex.compile(r"\s*")


class Units(dict):
    """Changes of the count by unit, a byte a character; None where one doesn't fit a byte."""

    def __init__(self, counter: PrefixCounter) -> None:
        self.counter = counter

    def __missing__(self, unit: str) -> bytes | None:
        d = self.counter.unit(unit)
        out = d.tobytes() if d.typecode == "b" else bytes(x & 0xFF for x in d) if max(d) < 128 and min(d) >= -128 else None
        if len(unit) <= 64:
            self[unit] = out
        return out


class PrefixCounter:
    """Exact counts at every prefix, in characters, for one byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        back = {c: b for b, c in enumerate(byte_symbols())}
        raw = lambda s: bytes(back[c] for c in s)
        self.ids = {raw(s): i for s, i in file["model"]["vocab"].items() if all(c in back for c in s)}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"])
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in file["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.longest = max(map(len, self.ids))
        self.parts = {a + b: (a, b) for (a, b), _ in sorted(self.rank.items(), key=lambda m: -m[1])}
        self.edges: tuple[dict, dict] = ({}, {})
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.last: dict[bytes, tuple[bytes, int, bytes]] = {b"": (b"", 0, b"")}
        self.units = Units(self)

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at a token's end (side 1) or beginning (side 0) while BPE makes it, with the rank of the merge that takes it in."""
        out = self.edges[side].get(token)
        if out is None:
            out, piece = [(token, 1 << 60)], token
            while piece in self.parts:
                taken = self.rank[self.parts[piece]]
                piece = self.parts[piece][side]
                out.append((piece, taken))
            self.edges[side][token] = out
        return out

    def _fit(self, a: bytes, b: bytes) -> bool:
        """Whether BPE makes of a + b the tokens a, b again: no merge across comes before those on either side (of equal ranks the left one is first)."""
        if not a:
            return True
        if (known := self.fits.get((a, b))) is not None:
            return known
        rank, starts, out = self.rank, self._edge(b, 0), True
        for x, x_taken in self._edge(a, 1):
            for y, y_taken in starts:
                r = rank.get((x, y))
                if r is not None and r < x_taken and r <= y_taken:
                    out = False
                    break
            if not out:
                break
        if len(self.fits) > CACHE:
            self.fits.clear()
        self.fits[a, b] = out
        return out

    def _extend(self, piece: bytes, known: int) -> None:
        """Adds the prefixes of `piece` beyond the first `known` bytes to the table."""
        last, ids, fit = self.last, self.ids, self._fit
        _, so_far, changes = last[piece[:known]]
        for i in range(known + 1, len(piece) + 1):
            for n in range(min(i, self.longest), 0, -1):
                token = piece[i - n : i]
                if token in ids:
                    before, count, _ = last[piece[: i - n]]
                    if fit(before, token):
                        changes += bytes([(count + 1 - so_far) & 0xFF])  # within a byte: pieces here have 100 bytes at most
                        so_far = count + 1
                        last[piece[:i]] = (token, so_far, changes)
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def changes(self, piece: str) -> array:
        """Change of the count with each character of a pre-token."""
        raw = piece.encode()
        if len(raw) > 100:
            return array("i", np.diff(self._long(piece)).tolist())
        last = self.last
        if raw not in last:
            if len(last) > CACHE:
                last = self.last = {b"": (b"", 0, b"")}
            known = len(raw) - 1
            while raw[:known] not in last:
                known -= 1
            self._extend(raw, known)
        by_byte = array("b", last[raw][2])
        if len(raw) == len(piece):
            return by_byte
        out, at = array("i"), 0
        for c in piece:
            n = len(c.encode())
            out.append(sum(by_byte[at : at + n]))
            at += n
        return out

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a pre-token, in characters; the empty one first."""
        return [0, *accumulate(self.changes(piece))]

    def _long(self, piece: str) -> list[int]:
        """The same for long pre-tokens, with arrays by position instead of the trie."""
        raw, ids = piece.encode(), self.ids
        token, count = [b""], [0]
        for i in range(1, len(raw) + 1):
            for n in range(min(i, self.longest), 0, -1):
                t = raw[i - n : i]
                if t in ids and self._fit(token[i - n], t):
                    token.append(t)
                    count.append(count[i - n] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        ends = np.cumsum([0] + [len(c.encode()) for c in piece])
        return np.asarray(count)[ends].tolist()

    def unit(self, unit: str) -> array:
        """Change of the count with each character of a unit (white space and the chunk after it)."""
        first = unit[0]
        if first != "'" and (first == " " or not first.isspace()) and not unit[1:2].isspace():
            return self.changes(unit)  # one pre-token
        n_space = SPACE.match(unit).end()
        out = self.counts(unit[:n_space]) if n_space else [0]  # a prefix that ends in white space: one run of it
        if n_space < len(unit):
            done = at = 0
            for part in PRETOKEN.findall(unit):
                if at + len(part) > n_space:
                    inside = self.counts(part)
                    if part[0] == "'" and len(part) == 3 and PRETOKEN.findall(part[:2]) != [part[:2]]:
                        inside[2] = sum(self.counts(x)[-1] for x in PRETOKEN.findall(part[:2]))  # half a contraction
                    out += [done + c for c in inside[max(n_space - at, 0) + 1 :]]
                    done += inside[-1]
                else:
                    done += self.counts(part)[-1]
                at += len(part)
        return array("i", np.diff(out).tolist())

    def _plain(self, text: str) -> np.ndarray:
        units = UNIT.findall(text)
        if len(self.units) > CACHE:
            self.units.clear()
        found = list(map(self.units.__getitem__, units))
        try:
            return np.frombuffer(b"".join(found), dtype=np.int8).astype(np.int32)
        except TypeError:  # a unit whose changes don't fit a byte
            return np.concatenate([np.frombuffer(f, dtype=np.int8) if f is not None else np.array(self.unit(u)) for u, f in zip(units, found, strict=True)]).astype(np.int32)

    def deltas(self, text: str) -> np.ndarray:
        """Per character of the text: tokens of the prefix that ends with it less tokens of the one before."""
        if self.specials is None or not any(s in text for s in self.special):
            return self._plain(text)
        out, at, before = [], 0, ""
        for m in self.specials.finditer(text):
            head = self._plain(text[at : m.start()])
            # A prefix that ends inside the special string has it as plain text, joined to what stands before it.
            tail = before_tail(text[at : m.start()])
            joined = np.cumsum(self._plain(tail + m.group()[:-1]))[len(tail) :]
            base = int(self._plain(tail).sum())
            inside = np.concatenate([joined - base, [1]])
            out += [head, np.diff(np.concatenate([[0], inside]))]
            at = m.end()
        out.append(self._plain(text[at:]))
        return np.concatenate(out).astype(np.int32)

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:k] for every k from 0 to len(text)."""
        return np.concatenate([[0], np.cumsum(self.deltas(text), dtype=np.int64)])


def before_tail(text: str) -> str:
    """The last unit or two of a text: what more characters after it can join."""
    ends = [m.start() for m in UNIT.finditer(text[-4096:])] if len(text) <= 4096 else None
    if ends is None:
        return text  # long: taken whole, which is always right
    return text[-4096:][ends[-2] :] if len(ends) > 1 else text


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_prefixes(docs: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """The table itself: (id, text, deltas), the change of the token count with each character, as 32-bit little-endian integers."""

    def run(batch):
        out = texts(batch)
        return {"rid": batch.column("rid"), "text": out, "deltas": [counter(path).deltas(t).tobytes() for t in out]}

    return map_arrow(with_id(docs, id_col), "rid long, text string, deltas binary", run).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)


def token_counts(docs: DataFrame, path: str, budget: int = 1024, id_col: str = "doc_id") -> DataFrame:
    """Per document: bytes, tokens, and `cut_chars`, the characters of the longest prefix of at most `budget` tokens, read from the prefix table."""

    def run(batch):
        n_bytes, n_tokens, cut = [], [], []
        for t in texts(batch):
            at = np.cumsum(counter(path).deltas(t), dtype=np.int64)
            within = np.flatnonzero(at <= budget)
            n_bytes.append(len(t.encode()))
            n_tokens.append(int(at[-1]) if len(at) else 0)
            cut.append(int(within[-1]) + 1 if len(within) else 0)
        return {"rid": batch.column("rid"), "n_bytes": n_bytes, "n_tokens": n_tokens, "cut_chars": cut}

    return map_arrow(with_id(docs, id_col), SCHEMA, run).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)


def _cut(counter_: PrefixCounter, text: str, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens."""
    within = np.flatnonzero(np.cumsum(counter_.deltas(text), dtype=np.int64) <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def truncate_to_budget(docs: DataFrame, path: str, budget: int, id_col: str = "doc_id") -> DataFrame:
    """(id, text): each row's text cut to its longest prefix of at most `budget` tokens, without encoding again. A null
    text stays null; rows that repeat an id are cut each by their own text."""

    def run(batch):
        own = counter(path)
        return {"rid": batch.column("rid"), "text": [None if t is None else t[: _cut(own, t, budget)] for t in batch.column("text").to_pylist()]}

    return map_arrow(with_id(docs, id_col), "rid long, text string", run).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)
