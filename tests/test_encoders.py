"""Encoders, tokenised tables, numbers in prose and the order of windows, against plain versions."""

import os
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkmill.functions import encoders, numbers, permute
from sparkmill.operators import tokens, windows
from sparkmill.sources import readers, writers

TEXTS = ["", None, "Hello, world!", "Ünïcode 🙂 and 漢字\n\nlines", "a  b\tc", "UPPER lower 123 4567", "<|endoftext|> inside", "x" * 3000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"])
def test_ids_equal_the_library(spark, name):
    public = pytest.importorskip("public_tokenizers")
    path = public.path(name)
    if name.endswith("json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        plain, back = (lambda s: t.encode(s, add_special_tokens=False).ids), (lambda i: t.decode(i, skip_special_tokens=False))
    elif name.endswith("model"):
        import sentencepiece

        t = sentencepiece.SentencePieceProcessor(model_file=path)
        plain, back = t.encode, t.decode
    else:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        t = tiktoken.Encoding("plain", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        plain, back = t.encode_ordinary, t.decode
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in tokens.encoded(df, path).withColumn("back", encoders.decoded(path)("ids")).collect()}
    for k, s in enumerate(TEXTS):
        assert got[k].ids == plain(s or "") and got[k].n_tokens == len(got[k].ids) + 1 and got[k].back == back(plain(s or ""))
    one = tokens.fertility(df.withColumn("d", F.lit("x")), path, "d").first()
    ids = [plain(s or "") for s in TEXTS]
    own = encoders.load(path)
    assert one.samples == len(TEXTS) and one.tokens == sum(map(len, ids)) and one.chars == sum(len(s or "") for s in TEXTS)
    assert one.roundtrip_failures == sum(back(i) != (s or "") for i, s in zip(ids, TEXTS, strict=True))
    assert one.byte_fallback_tokens == sum(x in own.fallback for i in ids for x in i)
    assert one.unk_tokens == (0 if own.unknown is None else sum(x == own.unknown for i in ids for x in i))
    assert not name.endswith("model") or one.byte_fallback_tokens > 0


def test_long_runs_of_white_space(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    own = encoders.load(public.path("byte_bpe_multi_50k.tiktoken"))
    long = ["\n" * 1_000_000, "a b" + " " * 400_000 + "c", "x" * 50_000]
    for s, ids in zip(long, own.encode(long), strict=True):
        assert own.raw(ids) == s.encode() and own.decode(ids) == s
    mixed = ["it's  a \n\n\t line" + " \n" * 9 + "of 12 words", " " * 40 + "end"]
    usual = own.encode(mixed)
    monkeypatch.setattr(encoders, "RUN", 0)
    monkeypatch.setattr(encoders, "BLANKS", encoders.re.compile(r"\s{2}"))
    assert own.encode(mixed) == usual


def test_encode_pack_lays_tokens_end_to_end(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    r = random.Random(3)
    rows = [(k, f"s{k % 2}", " ".join(r.choice(["the", "sun", "rises", "again"]) for _ in range(r.randrange(0, 200)))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    quotas = spark.createDataFrame([("s0", 700), ("s1", 100_000)], "source string, quota long")
    for own in (None, quotas):
        got = tokens.encode_pack(df, path, "source", 50256, 128, most=90, least=20, quotas=own).collect()
        for s in ("s0", "s1"):
            flat = []
            for k, source, text in rows:
                ids = encoders.load(path).encode([text])[0] if source == s else []
                cut = list(range(0, len(ids), 90))
                if len(cut) > 1 and len(ids) - cut[-1] < 20:
                    cut.pop()
                for i, j in zip(cut, [*cut[1:], len(ids)][: len(cut)], strict=True):
                    flat += [*ids[i:j], 50256]
            flat = flat[:700] if own is not None and s == "s0" else flat
            mine = [t for x in sorted((x for x in got if x.source == s), key=lambda x: (x.shard, x["at"])) for t in x.tokens]
            assert mine == flat
            sizes = {}
            for x in got:
                if x.source == s:
                    sizes[x.shard] = sizes.get(x.shard, 0) + len(x.tokens)
            assert [sizes[k] for k in sorted(sizes)] == [128] * (len(flat) // 128) + ([len(flat) % 128] if len(flat) % 128 else [])


def test_numerals():
    for s, want in {"十": 10, "三百零五": 305, "一万二千": 12000, "两亿": 2 * 10**8, "一万亿": 10**4 + 10**8, "万": 10**4, "二三": 3, "九十九": 99, "三点一四": Decimal("3.14"), "三点": 3, "零十": 10, "五点二十": Decimal("5.2"), "一二百": 200, "百五": 105}.items():
        assert numbers.numeral(s)[0] == numbers.Fraction(want), s
    for text, reference, want in [("about 3.14", "3.1415", True), ("about 3.14", "3.2", False), ("1,234 people", "1234", True), ("-5 now", "-5", True), ("3/4 of it", "0.75", True), ("3 / 4 / 5", "0.8", False), ("四分之三", "0.75", True), ("三百人", "300", True), ("三百万元", "3000000", True), ("三百万元", "300", True), ("no number", "1", False), ("1/0", "1", True), ("3/-4", "0.75", False), ("1.5/2", "2.5", True), ("百分之五十", "0.5", True)]:
        assert numbers.agrees(reference, text) is want, text


def test_windows_of_an_epoch_are_a_permutation(spark):
    for n in (0, 1, 2, 3, 7, 100, 1000, 4097):
        place = np.arange(n)
        seen = [permute.permuted(place, n, 7, e) for e in range(3)]
        assert all(sorted(s.tolist()) == place.tolist() for s in seen)
        assert all((permute.permuted(s, n, 7, e, True) == place).all() for e, s in enumerate(seen))
        assert n < 7 or (seen[0] != seen[1]).any()
    spread = permute.permuted(np.arange(10_000), 10_000, 1, 1)
    assert abs(np.corrcoef(np.arange(10_000), spread)[0, 1]) < 0.05 and abs(np.corrcoef(spread[:-1], spread[1:])[0, 1]) < 0.05
    whole = windows.epoch_windows(spark, 500, 3, 2, workers=4).collect()
    assert sorted(r.window for r in whole) == list(range(500)) and {r.worker for r in whole} == {0, 1, 2, 3}
    rest = windows.epoch_windows(spark, 500, 3, 2, workers=4, start=321).collect()
    assert sorted((r.place, r.window, r.worker) for r in rest) == sorted((r.place, r.window, r.worker) for r in whole if r.place >= 321)


def plain_budget(rows, budget):
    """(path, source, sha, size) in order of paths."""
    seen, used, kept = set(), {}, []
    for path, source, sha, size in sorted(rows):
        if sha in seen or used.get(source, 0) + size > budget:
            continue
        seen.add(sha)
        used[source] = used.get(source, 0) + size
        kept.append(path)
    return kept


@pytest.mark.parametrize("loop", [100_000, 3])
def test_budget_of_code_files(spark, monkeypatch, loop):
    monkeypatch.setattr(windows, "LOOP", loop)
    for seed in range(2 if loop > 10 else 1):
        r = random.Random(seed)
        sizes = {f"h{k}": r.choice([5, 40, 60, 90, 100, 300]) + r.randrange(5) for k in range(40)}
        rows = [(f"p{k:03}", f"s{r.randrange(3)}", h, sizes[h]) for k in range(90) for h in [f"h{r.randrange(40)}"]]
        df = spark.createDataFrame(rows, "path string, source string, sha string, bytes long")
        got = [x.path for x in readers.first_within_budget(df, "source", "path", "sha", "bytes", 500).collect()]
        assert sorted(got) == plain_budget(rows, 500)


def test_code_files_with_a_budget(spark, tmp_path):
    for source, name, n, c in [("a", "1", 60, "x"), ("a", "2", 50, "y"), ("a", "3", 30, "z"), ("b", "1", 50, "y"), ("b", "2", 60, "x")]:
        os.makedirs(f"{tmp_path}/{source}", exist_ok=True)
        with open(f"{tmp_path}/{source}/{name}.py", "w") as f:
            f.write(c * n)
    got = readers.read_code_files(spark, str(tmp_path), [".py"], [], 1000, 5, source=r"/([^/]+)/[^/]+$", budget=100).select("path").collect()
    assert sorted("/".join(r.path.rsplit("/", 2)[1:]) for r in got) == ["a/1.py", "a/3.py", "b/1.py"]


def test_token_shards_of_ids(spark):
    df = spark.createDataFrame([("a", 1, [1, 2, 3]), ("a", 2, [4, 5])], "k string, doc_id long, ids array<int>")
    assert [(r.shard, r.tokens) for r in writers.shard_manifest(writers.token_shards(df, "k", ["doc_id"], "ids", 4), "k").orderBy("shard").collect()] == [(0, 4), (1, 1)]


def test_texts_are_encoded_by_slices(spark):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    texts = pd.Series(["some words of a text " * 500, None, ""] * 100)
    plain = encoders.load(path).encode(texts.fillna("").tolist())
    for f in (encoders.token_ids(path), encoders.audited(path)):
        parts = list(f.func(iter([texts, texts[:0]])))
        assert len(parts) > 3 and max(map(len, parts)) < 100 and sum(map(len, parts)) == len(texts)
    got = [i for part in encoders.token_ids(path).func(iter([texts])) for i in part]
    assert [i.tolist() for i in got] == plain
