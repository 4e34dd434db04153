"""The registered queries over small tables with nulls, repeats, ties and clashing names, against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from sparkmill.llm import queries

from .test_models import plain_base
from .test_near import plain_components, plain_fingerprint, plain_repeats


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    r = random.Random(33)
    words = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    passage = words(40)
    rows, labels = [], []
    for k in range(160):
        w = words(r.choice([0, 5, 19, 60, 120, 300]))
        if k % 4 == 0:
            for _ in range(4):
                w.insert(r.randrange(len(w) + 1), r.choice(["idiot", "moron"]))
        if k % 9 == 1:
            w += passage
        if k % 7 == 2:
            w += ["mail", f"user{k}@example.com", "or", "+49 30 1234567"]
        rows.append((k, " ".join(w), "en" if k % 5 else None, f"src{k % 3}", 0, "x"))
        labels.append((k, 1 - k % 2, int(k % 4 == 0)))
    rows += [(1000, rows[7][1], "en", "src0", 0, "x"), (1001, None, None, None, None, None), (1002, "", "en", "s", 0, "x"), (1003, "Ünï🙂 " * 1500, "de", "s", 0, "x")]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rid string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    pages = [(k, f"http://www.{'spam' if k % 4 == 0 else 'fine'}.example.net/x/{k}") for k in range(160)] + [(500, None), (501, "http://a.org/x"), (502, "https://example.org/es/1")]
    spark.createDataFrame([(*p, "<p>") for p in pages], "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    v = np.random.default_rng(2).normal(size=(240, 8)).astype(np.float32)
    v[50:90] = v[50]
    spark.createDataFrame([(k, x.tolist(), 0) for k, x in enumerate(v)] + [(300, None, 0), (320, [0.0] * 8, 0)], "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    return at, {i: t for i, t, *_ in rows}, {k: v[k].astype(float) for k in range(240)}


def run(spark, sf, name):
    return queries.QUERIES[name](spark, sf[0]).collect()


def test_tokens(spark, sf):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import regex
    import tiktoken.load
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {x.doc_id: x for x in run(spark, sf, "op4_token_counts")}
    for k, t in sf[1].items():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((t or "").encode()), n, n > 1024)
    assert any(x.over_limit for x in got.values()) and len(got) == len(sf[1])
    ranks = tiktoken.load.load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert regex.compile(public_tokenizers.PATTERN)
    for x in run(spark, sf, "op9_byte_bpe"):
        ids = plain.encode_ordinary(sf[1][x.doc_id] or "")
        assert x.n_tokens == len(ids) and x.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256((sf[1][x.doc_id] or "").encode()).hexdigest()


def test_near_and_repeats(spark, sf):
    prints = {k: plain_fingerprint(t) for k, t in sf[1].items()}
    want = plain_components(list(prints.items()))
    assert {x.doc_id: (x.fingerprint, x.component_id) for x in run(spark, sf, "op3_simhash")} == {k: (f"{p:016x}", want[k]) for k, p in prints.items()}
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in run(spark, sf, "op8_substring_dedup")} == plain_repeats(list(sf[1].items()))


def test_scores(spark, sf):
    got = {x.doc_id: x for x in run(spark, sf, "op6_toxicity")}
    assert set(got) == set(sf[1])
    for k, x in got.items():
        assert x.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and x.predicted == int(x.score >= 0.5) and 0 <= x.score <= 1
    assert all(got[k].predicted == (k % 4 == 0) for k in range(160))
    judged = {x.doc_id: x for x in run(spark, sf, "op5_quality_rules")}
    assert set(judged) == set(sf[1]) and not any(x.base_failed and x.kept for x in judged.values()) and all(x.outlyingness is not None for x in judged.values() if not x.base_failed)
    for x in run(spark, sf, "op7_pii"):
        base = plain_base(sf[1][x.doc_id] or "")
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(len(base[c]) for c in ("email", "ip", "card", "phone"))


def test_urls_and_vectors(spark, sf):
    got = {x.page_id: (x.rule, x.verdict) for x in run(spark, sf, "op2_url_filter")}
    assert len(got) == 163 and got[500] == (None, "allow") and got[501] == ("org/", "allow") and got[502] == ("example.org/es/", "block")
    v = sf[2]
    found = {}
    for x in run(spark, sf, "op10_nearest"):
        found.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    assert set(found) == set(range(0, 240, 20))
    hit = 0
    for q, own in found.items():
        own.sort()
        score = {k: float(sum(a * b for a, b in zip(v[q].tolist(), x.tolist(), strict=True))) for k, x in v.items() if k != q}
        want = sorted(score, key=lambda k: (-score[k], k))[:20]
        hit += len(set(want) & {k for _, k, _ in own})
        assert [n for n, _, _ in own] == list(range(1, 21)) and all(abs(s - score[k]) < 1e-12 for _, k, s in own) and own == sorted(own, key=lambda f: (-f[2], f[1]))
    assert hit >= 0.9 * 240


def test_packing(spark, sf):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken.load

    ranks = tiktoken.load.load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    length, bins = {}, {}
    for x in run(spark, sf, "op1_best_fit_packing"):
        length[x.doc_id] = length.get(x.doc_id, 0) + x.length
        bins.setdefault((x.bin_id, x.bin_size, x.bin_fill), []).append(x.length)
    assert length == {k: len(plain.encode_ordinary(t or "")) + 1 for k, t in sf[1].items()}
    assert all(sum(own) == fill <= size for (_, size, fill), own in bins.items()) and len({b for b, _, _ in bins}) == len(bins)
