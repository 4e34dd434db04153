"""Toxicity (6): a linear-chain conditional random field tags toxic words; marginals give spans and document scores.

Only documents are labelled, so words are labelled first: in a toxic document, those whose form or stem (first five
characters) is seen in many toxic documents of the sample and hardly in clean ones. The field has two states, hashed
features of the word and transitions; a sequence is a sentence. Forward-backward gives each word's marginal. A
document's score is a logistic function, fitted on the same sample, of its summed (cubed) and its largest marginal.

The sample is bounded: `per_class` labelled documents of either class, those with the smallest hash of their id, among
texts of at most `max_chars` characters. Scoring takes every document and every word, however long the text.

Rows: a null or empty text has no words and gets the lowest score. Null labels aren't used. Rows that repeat an id are
scored each. Without labels of both classes every score is 0. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, map_arrow, map_rows, real_id, slices, with_id

DIM = 1 << 16
CACHE = 300_000


def features(word: str) -> list[int]:
    w = word.lower().strip(".,;:!?\"'()[]{}<>«»¡¿-–—…*_")
    return [xxhash.xxh32_intdigest(x) % DIM for x in ("w" + w, "p" + w[:5], "q" + w[:4])]


def forms(word: str) -> tuple[str, str]:
    w = word.lower().strip(".,;:!?\"'()[]{}<>«»¡¿-–—…*_")
    return "w" + w, "p" + w[:5]


def sentences(words: Words) -> np.ndarray:
    """Where sequences begin: with a text, and after a word that ends a sentence."""
    if not len(words.start):
        return np.zeros(0, dtype=np.int64)
    last = words.data[words.end - 1]
    new = np.ones(len(last), dtype=bool)
    new[1:] = np.isin(last[:-1], np.frombuffer(b".!?", dtype=np.uint8)) | (words.row[1:] != words.row[:-1])
    return np.flatnonzero(new)


@dataclass
class Field:
    """Log odds of states from words (weights by feature) and log transitions; document scores from marginals."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIM, dtype=np.float32))
    step: np.ndarray = field(default_factory=lambda: np.array([[1.0, -1.0], [-1.0, 1.0]]))
    score: np.ndarray | None = None

    def marginals(self, odds: np.ndarray, begin: np.ndarray, pairs: bool = False):
        """P(toxic) of each word, from forward and backward ratios of the two states; all sequences a step at a time."""
        n = len(odds)
        length = np.diff(np.r_[begin, n])
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        alive = len(length) - np.searchsorted(length[::-1], np.arange(1, (length[0] if len(length) else 0) + 1))
        a = np.exp(self.step)
        e = np.exp(np.clip(odds, -25, 25))
        r, q = np.ones(n), np.ones(n)
        for t, k in enumerate(alive.tolist()):
            at = begin[:k] + t
            if t == 0:
                r[at] = e[at]
            else:
                before = r[at - 1]
                r[at] = e[at] * (a[0, 1] + before * a[1, 1]) / (a[0, 0] + before * a[1, 0])
        for t in range(len(alive) - 1, 0, -1):
            at = begin[: alive[t]] + t
            eq = e[at] * q[at]
            q[at - 1] = (a[1, 0] + a[1, 1] * eq) / (a[0, 0] + a[0, 1] * eq)
        p = r * q / (1 + r * q)
        if not pairs:
            return p
        inner = np.setdiff1d(np.arange(n), begin, assume_unique=True)  # every word with one before it
        eq, before = e[inner] * q[inner], r[inner - 1]
        x = np.stack([np.full(len(inner), a[0, 0]), a[0, 1] * eq, a[1, 0] * before, a[1, 1] * before * eq])
        return p, inner, (x / x.sum(axis=0)).sum(axis=1).reshape(2, 2)

    def fit(self, odds_of: np.ndarray, word: np.ndarray, begin: np.ndarray, label: np.ndarray, rounds: int = 20) -> None:
        """odds_of: features of each distinct word; word: index of each word. Adam on the penalised log-likelihood."""
        inner = np.setdiff1d(np.arange(len(word)), begin, assume_unique=True)
        seen = np.zeros((2, 2))
        np.add.at(seen, (label[inner - 1], label[inner]), 1)
        w, mw, vw = self.weights.astype(np.float64), np.zeros(DIM), np.zeros(DIM)
        ms, vs = np.zeros((2, 2)), np.zeros((2, 2))
        for k in range(1, rounds + 1):
            p, _, pair = self.marginals(w[odds_of].sum(axis=1)[word], begin, pairs=True)
            g = np.bincount(word, label - p, minlength=len(odds_of))
            gw = np.bincount(odds_of.ravel(), np.repeat(g, odds_of.shape[1]), minlength=DIM) - 0.01 * w
            gs = seen - pair - 0.01 * self.step
            for x, grad, m, v, rate in ((w, gw, mw, vw, 0.4), (self.step, gs, ms, vs, 0.1)):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                x += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        self.weights = w.astype(np.float32)

    def fit_score(self, x: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression by Newton's method, ridge-penalised."""
        x = np.c_[np.ones(len(x)), x]
        b = np.zeros(x.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 0.1, 0.1])
            b += np.linalg.solve(h, x.T @ (y - p) - np.array([1e-3, 0.1, 0.1]) * b)
        self.score = b

    def documents(self, p: np.ndarray, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
        """What a text's score is made of (its summed cubed marginals, so that many faint ones don't add up, and its
        largest one), and its expected toxic words."""
        sharp, top, total = np.zeros(n), np.zeros(n), np.zeros(n)
        np.add.at(sharp, words.row, p**3)
        np.add.at(total, words.row, p)
        np.maximum.at(top, words.row, p)
        return np.c_[np.log1p(sharp), top], total

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.score is None:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self.score[0] + x @ self.score[1:], -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int) -> list[tuple[str, int]]:
    """The labelled texts to learn from: at most 2 * per_class rows, a bounded table that is broadcast and collected. Of
    rows that repeat an id those of the smallest text hashes are taken, so that the bound holds after the join too."""
    known = labels.select(F.col("doc_id").alias("rid"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("rid is not null and toxic in (0, 1) and crc32(cast(cast(rid as string) as binary)) % 5 <> 0")
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("rid"), "rid").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))
    rows = docs.select(F.col("doc_id").alias("rid"), "text").where(F.length("text") <= max_chars).join(chosen, "rid").select("rid", "text", "toxic")
    rows = rows.orderBy(F.xxhash64("rid", "text"), "text", "toxic").limit(2 * per_class)
    return [(t, y) for _, t, y in sorted(map(tuple, rows.collect()))]


def learn(texts_: list[tuple[str, int]]) -> Field:
    """The field and the document score from labelled texts; copies count once."""
    rows = list(dict.fromkeys(texts_))
    y = np.array([c for _, c in rows])
    out = Field()
    if len(set(y.tolist())) < 2:
        return out
    words = Words(pa.array([t for t, _ in rows], pa.large_string()))
    names, at, word = np.unique(words.name, return_index=True, return_inverse=True)
    own = [words.data[words.start[i] : words.end[i]].tobytes().decode("utf-8", "replace") for i in at]
    # Words of toxic documents that clean ones lack.
    form = [forms(w) for w in own]
    index = {f: k for k, f in enumerate(dict.fromkeys(x for pair in form for x in pair))}
    of = np.array([[index[a], index[b]] for a, b in form])
    n = [max(1, int((y == c).sum())) for c in (0, 1)]
    seen = np.zeros((2, len(index)))
    for col in (0, 1):
        pair = np.unique(of[word, col] * len(rows) + words.row)
        f, doc = pair // len(rows), pair % len(rows)
        for c in (0, 1):
            seen[c] += np.bincount(f[y[doc] == c], minlength=len(index))
    # Seen in several toxic documents, and 20 times as often as in clean ones.
    toxic = (seen[1] >= max(5, 0.01 * n[1])) & (seen[1] / n[1] >= 20 * (seen[0] + 1) / n[0])
    label = (toxic[of].any(axis=1)[word] & (y[words.row] == 1)).astype(np.int64)
    feats = np.array([features(w) for w in own])
    begin = sentences(words)
    out.fit(feats, word, begin, label)
    p = out.marginals(out.weights[feats].sum(axis=1)[word].astype(np.float64), begin)
    out.fit_score(out.documents(p, words, len(rows))[0], y)
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1000, max_chars: int = 12_000) -> Field:
    return learn(sample(docs, labels, per_class, max_chars))


class Tagger:
    """Applies a field; remembers words it has met."""

    known: dict[int, float] = {}
    model_key: int | None = None

    @classmethod
    def odds(cls, model: Field, words: Words) -> np.ndarray:
        key = xxhash.xxh64_intdigest(model.weights.tobytes())
        if cls.model_key != key or len(cls.known) > CACHE:
            cls.known, cls.model_key = {}, key
        names, at, word = np.unique(words.name, return_index=True, return_inverse=True)
        known, own = cls.known, np.empty(len(names))
        for k, (name, i) in enumerate(zip(names.tolist(), at.tolist(), strict=True)):
            e = known.get(name)
            if e is None:
                w = words.data[words.start[i] : words.end[i]].tobytes().decode("utf-8", "replace")
                e = known[name] = float(model.weights[features(w)].sum())
            own[k] = e
        return own[word]


def score(docs: DataFrame, model: Field, id_col: str = "doc_id", spans: bool = True) -> DataFrame:
    """Per row: score, n_toxic (expected toxic words) and, with spans, the offending runs of words as [start, end) in characters."""

    def run(batch: pa.RecordBatch):
        for lo, hi in slices(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            words = Words(part.column("text"))
            p = model.marginals(Tagger.odds(model, words), sentences(words)) if len(words.start) else np.zeros(0)
            x, total = model.documents(p, words, len(part))
            out = {"rid": part.column("rid"), "score": model.scores(x), "n_toxic": total}
            if spans:
                out["spans"] = _spans(words, p > 0.5, len(part))
            yield out

    schema = "rid long, score double, n_toxic double" + ", spans array<struct<start: int, end: int>>" * spans
    return map_arrow(with_id(docs, id_col), schema, run).withColumn("rid", real_id()).withColumnRenamed("rid", id_col)


def reject(docs: DataFrame, model: Field, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for lo, hi in slices(batch.column("text")):
            words = Words(batch.column("text").slice(lo, hi - lo))
            p = model.marginals(Tagger.odds(model, words), sentences(words)) if len(words.start) else np.zeros(0)
            keep.append(model.scores(model.documents(p, words, hi - lo)[0]) < threshold)
        return batch.filter(pa.array(np.concatenate(keep))) if keep else batch

    return map_rows(docs, run)


def _spans(words: Words, bad: np.ndarray, n: int) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(n)]
    hit = np.flatnonzero(bad)
    if not len(hit):
        return out
    cut = np.flatnonzero((np.diff(hit) > 1) | (np.diff(words.row[hit]) > 0)) + 1
    follows = (words.data & 0xC0) == 0x80  # bytes that don't begin a character
    for run in np.split(hit, cut):
        k = int(words.row[run[0]])
        base, a, b = int(words.offsets[k]), int(words.start[run[0]]), int(words.end[run[-1]])
        before = a - base - int(follows[base:a].sum())
        out[k].append({"start": before, "end": before + b - a - int(follows[a:b].sum())})
    return out
