"""Plain functions behind the Arrow UDFs, importable on executors."""

from __future__ import annotations

import math
import re
import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np

from . import patterns as P


def cuts(s: str, low: int, high: int, mask: int) -> list[str]:
    """Chunks that end where a rolling sum of the last characters has low bits of zero, within bounds of length."""
    code = np.array([ord(c) for c in s], dtype=np.uint64)
    gear = ((code + np.uint64(1)) * np.uint64(0x9E3779B185EBCA87)).astype(np.uint64)
    total = gear.copy()
    for k in range(1, min(6, len(s))):  # only six characters reach the low six bits
        total[k:] += gear[:-k] << np.uint64(k)
    stop = np.flatnonzero((total & np.uint64(mask)) == 0)
    out, at = [], 0
    while at < len(s):
        near = np.searchsorted(stop, at + low - 1)
        end = min(int(stop[near]) + 1 if near < len(stop) else len(s), at + high, len(s))
        out.append(s[at:end])
        at = end
    return out


def _ranges(codes: list[int]) -> str:
    """A character class of code points."""
    out, at = [], 0
    for k in range(1, len(codes) + 1):
        if k == len(codes) or codes[k] != codes[k - 1] + 1:
            out.append(f"{re.escape(chr(codes[at]))}-{re.escape(chr(codes[k - 1]))}")
            at = k
    return "[" + "".join(out) + "]+"


#: NUL, U+FFFD and control or format characters but line ends and tabs.
CONTROL = re.compile(_ranges([c for c in range(sys.maxunicode + 1) if chr(c) not in "\n\t" and (c == 0xFFFD or unicodedata.category(chr(c)) in ("Cc", "Cf"))]))
_FOOTER, _SENTENCE_END = re.compile(P.FOOTER), re.compile(P.SENTENCE_END)


def clean(s: str, footer: bool) -> str:
    """Line ends as \\n, without control characters, in NFC, stripped, and (footer) without a page's footer."""
    s = CONTROL.sub("", s.replace("\r\n", "\n").replace("\r", "\n")).strip()
    return unicodedata.normalize("NFC", drop_footer(s) if footer else s)


def drop_footer(s: str, most: int = 8) -> str:
    """Without blank last lines and then at most so many last lines that look like a page's footer."""
    own = re.split("\r\n|\r|\n", s)
    while own and not own[-1].strip():
        own.pop()
    for _ in range(most):
        if not own or not _FOOTER.search(own[-1]):
            break
        own.pop()
    return "\n".join(own).strip()


def poison(s: str, least: int = 800, ratio: float = 0.15, share: float = 0.12) -> bool:
    """Long, compressible and with few distinct pairs of characters, white space aside."""
    t = "".join(s.split())
    if len(t) < least:
        return False
    raw = t.encode()
    return len(zlib.compress(raw, 1)) < ratio * len(raw) and len(set(pairwise(t))) < share * (len(t) - 1)


def repeated_chars(s: str, least: int, repeats: int, beyond_first: bool) -> int:
    """Characters in normalised sentences of `least` characters and more that occur `repeats` times and more."""
    own = (p.strip() for p in _SENTENCE_END.split(s.replace("\r", "").strip()))
    n = Counter(" ".join(p.split()).lower() for p in own if len(p) >= least)
    return sum(len(p) * (k - beyond_first) for p, k in n.items() if k >= repeats)


def repeated(s: str, least: int, repeats: int, chars: int, share: float) -> bool:
    """Whether repeated sentences make up so many characters and such a share of the text."""
    n = repeated_chars(s, least, repeats, False)
    return n >= chars and n >= max(chars, int(sum(map(len, s.split())) * share))


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def runs(s: str, size: int, wanted: np.ndarray | None) -> list[dict]:
    """Distinct runs of `size` characters as hash and first place (from 1), by place; of the wanted hashes only, if given."""
    h = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    if size < 1 or len(h) < size:
        return []
    joined = lambda a, b: (a * _FACTOR + b) ^ ((a * _FACTOR + b) >> np.uint64(29))
    # Runs of 1, 2, 4 ... characters, put together by the bits of the size.
    out, done, width = None, 0, 1
    while True:
        if size & width:
            out, done = (h[: len(h)], width) if out is None else (joined(out[: len(h) - done], h[done:]), done + width)
        if width * 2 > size:
            break
        h, width = joined(h[:-width], h[width:]), width * 2
    value = out[: len(s) - size + 1].view(np.int64)
    if wanted is not None:
        at = np.flatnonzero(np.isin(value, wanted))
        own, first = np.unique(value[at], return_index=True)
        first = at[first]
    else:
        own, first = np.unique(value, return_index=True)
    order = np.argsort(first, kind="stable")
    return [{"h": int(a), "at": int(b) + 1} for a, b in zip(own[order], first[order], strict=True)]


def gram_counts(s: str, longest: int, bits: int, block: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of up to `longest` characters that a text has, in order, and how often. A text of one block is
    sorted; a longer one is counted block by block."""
    code = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    n = np.zeros(1 << bits, dtype=np.int64) if len(code) > block else None
    for lo in range(0, max(len(code), 1), block):
        own = code[lo : lo + block + longest - 1]
        h, parts = np.zeros(len(own), dtype=np.uint64), []
        for k in range(1, longest + 1):
            h = h[: len(own) - k + 1] * _FACTOR + own[k - 1 :]
            parts.append(((h ^ (h >> np.uint64(31))) * _FACTOR >> np.uint64(64 - bits))[:block].astype(np.uint32))
            if len(own) <= k:
                break
        every = np.concatenate(parts)
        if n is None:
            every.sort()
            edge = np.flatnonzero(np.diff(every, prepend=every[:1] + 1, append=every[-1:] + 1))
            return every[edge[:-1]].astype(np.int64), np.diff(edge)
        n += np.bincount(every, minlength=1 << bits)
    at = np.flatnonzero(n)
    return at, n[at]


def runs_of(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most so many characters together; a longer row is one of its own."""
    total, lo = np.cumsum(lengths), 0
    while lo < len(total):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def sparse_terms(s: str, weight: np.ndarray, longest: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's terms: 1 + ln(count) times the term's weight, scaled to length 1."""
    at, n = gram_counts(s, longest, bits)
    v = (1 + np.log(n)) * weight[at]
    at, v = at[v > 0], v[v > 0]
    return at, v / (np.sqrt(v @ v) or 1.0)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point, as bits: CJK, a decimal digit, a Latin letter, a punctuation mark."""
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    out[0x3400:0xA000] = 1
    out[[c for c in range(0x20000) if chr(c).isdecimal()]] |= 2  # there are none beyond
    out[[*range(65, 91), *range(97, 123)]] |= 4
    out[[*map(ord, "，。！？；：,.!?;:")]] |= 8
    return out


_URL = re.compile(P.URL, re.ASCII)


def measures(s: str) -> list[float]:
    """The six measures of text.text_features, in their order."""
    kind = np.bincount(_kinds()[np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)], minlength=16)
    n, (cjk, digit, latin, punct) = max(len(s), 1), (int(kind[[k for k in range(16) if k & b]].sum()) for b in (1, 2, 4, 8))
    urls = len(_URL.findall(s)) if "://" in s or "www." in s.lower() else 0
    return [min(math.log2(n + 1) / 16, 1.0), cjk / n, digit / n, latin / n, min(urls / 5, 1.0), punct / n]


def term_texts(texts: Iterator[str], longest: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The terms that texts have, and how many of the texts have each."""
    n = np.zeros(1 << bits, dtype=np.int64)
    for s in texts:
        n[gram_counts(s, longest, bits)[0]] += 1
    at = np.flatnonzero(n)
    return at, n[at]
