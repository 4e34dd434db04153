"""Tokenizers of the installed libraries as Arrow UDFs: a worker loads a vocabulary once, whatever the number of batches.

The file decides the library: .json tokenizers, .model sentencepiece, .tiktoken (ranks in base 64) tiktoken. Its path is a
parameter, and the file must be where every worker reads it. Nothing is trained, cut, padded or framed by added tokens.
`raw` gives the bytes of ids where the library has them."""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

from . import kernels

#: Pieces that stand for one byte of a text that the vocabulary can't express.
BYTE = re.compile(r"<0x[0-9A-Fa-f]{2}>")
#: tiktoken's own splitting overflows its stack on much longer runs of white space; texts that hold one are split here first.
RUN = 10_000
BLANKS = re.compile(rf"\s{{{RUN}}}")


@dataclass(frozen=True)
class Encoder:
    encode: Callable[[list[str]], list[list[int]]]
    decode: Callable[[list[int]], str]
    unknown: int | None
    fallback: frozenset[int]
    size: int
    raw: Callable[[list[int]], bytes] | None = None


@functools.lru_cache(maxsize=4)
def load(path: str) -> Encoder:
    """The encoder of a file; kept by the process that asks for it."""
    kind = path.rpartition(".")[2]
    if kind == "json":
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        unknown = getattr(t.model, "unk_token", None)
        fallback = frozenset(i for piece, i in t.get_vocab().items() if BYTE.fullmatch(piece))
        return Encoder(lambda x: [e.ids for e in t.encode_batch_fast(x, add_special_tokens=False)], lambda ids: t.decode(ids, skip_special_tokens=False), t.token_to_id(unknown) if unknown else None, fallback, t.get_vocab_size())
    if kind == "model":
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        return Encoder(lambda x: m.encode(x, num_threads=1), m.decode, m.unk_id(), frozenset(i for i in range(m.vocab_size()) if m.is_byte(i)), m.vocab_size())
    if kind == "tiktoken":
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        pattern = regex.compile(public_tokenizers.PATTERN)

        def ids(s: str) -> list[int]:
            if len(s) < RUN or not BLANKS.search(s):
                return e.encode_ordinary(s)
            return [i for piece in pattern.findall(s) for i in e._encode_single_piece(piece)]

        return Encoder(lambda x: list(map(ids, x)), e.decode, None, frozenset(), len(ranks), e.decode_bytes)
    raise ValueError(f"no library for {path}")


#: Characters of text that are encoded at a time; what a library keeps of each token is many times its text.
SLICE = 1 << 18


def sliced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts, empty for null, by SLICE characters; a longer text is one of its own."""
    for x in batches:
        x = x.fillna("")
        for lo, hi in kernels.runs_of(x.str.len().to_numpy(), SLICE):
            yield x.iloc[lo:hi]


def token_ids(path: str) -> Callable[[Column | str], Column]:
    """The ids of a text; a null text has none."""

    @pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load(path)
        for x in sliced(batches):
            yield pd.Series([np.array(i, dtype=np.int32) for i in own.encode(x.tolist())], dtype=object)

    return ids


def decoded(path: str) -> Callable[[Column | str], Column]:
    """The text of an array of ids."""

    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load(path)
        for x in batches:
            yield x.map(lambda ids: own.decode([int(i) for i in ids]), na_action="ignore")

    return text


def audited(path: str) -> Callable[[Column | str], Column]:
    """What an audit of an encoder asks of a text: tokens, unknown and byte-fallback ones, whether it comes back as it was."""

    @pandas_udf("tokens int, unknown int, fallback int, returns boolean")
    def audit(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = load(path)
        for x in sliced(batches):
            texts = x.tolist()
            rows = [(len(ids), ids.count(own.unknown) if own.unknown is not None else 0, sum(i in own.fallback for i in ids) if own.fallback else 0, own.decode(ids) == s) for s, ids in zip(texts, own.encode(texts), strict=True)]
            yield pd.DataFrame(rows, columns=["tokens", "unknown", "fallback", "returns"])

    return audit
