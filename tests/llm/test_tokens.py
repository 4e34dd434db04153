import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from sparkmill.llm.token_prefix import PrefixCounter

HARD = list("ab1 '  \n\t\x1c\x85éß²½٣漢字🙂́!?.|<>srtvemldo᠎​")
PIECES = ["<|endoftext|>", "<|endof", "'ll", "'re", "'s", " the", "ing", "    ", "\n\n", "word", "Äpfel", "x", "..."]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def some(n, seed):
    r = random.Random(seed)
    for _ in range(n):
        yield "".join(r.choice(HARD if r.random() < 0.6 else PIECES) for _ in range(r.randint(0, 25)))


def test_every_prefix_has_the_library_count(counter, library):
    for s in some(400, 1):
        want = [len(e.ids) for e in library.encode_batch([s[:k] for k in range(len(s) + 1)], add_special_tokens=False)]
        assert counter.prefix_counts(s).tolist() == want, repr(s)


def test_long_runs(counter, library):
    for s in ("ab" * 700, "é" * 400, " " * 900 + "x", "1234567890" * 90, "hello" * 300 + "<|endoftext|>" + "\n" * 600):
        assert counter.prefix_counts(s)[-1] == len(library.encode(s, add_special_tokens=False).ids)


def test_two_tiers_give_the_library_ids():
    from sparkmill.llm.byte_bpe import ByteBPE

    path = P.path("byte_bpe_multi_50k.tiktoken")
    own = ByteBPE(path)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    many = ["", "a" * 3000, "é" * 999, *some(1500, 2)]
    for t, got in zip(many, own.encode(many), strict=True):
        assert got == lib.encode_ordinary(t), repr(t)
        assert own.decode(got) == t.encode()
    assert own.hash.find(list(ranks)) == list(range(len(ranks)))


def test_queries_on_awkward_rows(spark):
    from sparkmill.llm import byte_bpe, token_prefix

    rows = [(1, None, "x"), (2, "", "y"), (3, "a <|endoftext|> b", "z"), (None, "null id", None), (3, "a <|endoftext|> b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_prefix.token_counts(docs, P.path("byte_bpe_50k.json"), 3).collect()), key=str)
    assert got == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (3, 17, 4, 15), (3, 17, 4, 15), (None, 7, 2, 7)], key=str)
    cut = {r.doc_id: r.text for r in token_prefix.truncate_to_budget(docs, P.path("byte_bpe_50k.json"), 2).collect()}
    assert cut[2] == "" and cut[1] is None and cut[None] == "null id"
    path = P.path("byte_bpe_multi_50k.tiktoken")
    back = byte_bpe.decode(byte_bpe.encode(docs, path), path)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == [(0, "null id"), (1, ""), (2, ""), (3, "a <|endoftext|> b"), (3, "a <|endoftext|> b")]
    assert byte_bpe.round_trip(docs.limit(0), path).count() == 0 and token_prefix.token_counts(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0
