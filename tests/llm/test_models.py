import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from sparkmill.llm import ann, byte_bpe, packing, pii, quality, toxicity
from sparkmill.llm.ann import Index

BAD = ["idiot", "Trash", "loweiung", "loweikeit"]


def labelled(n, seed):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        w = [f"w{r.randrange(400)}" + r.choice(["", "", ".", ","]) for _ in range(r.randint(0, 60) if k % 9 else 3)]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w) + 1), r.choice(BAD))
        rows.append((k, " ".join(w), int(toxic)))
    return rows


def brute_marginals(odds, step):
    """P(state 1) of each word by summing over every sequence of states."""
    n, total, p = len(odds), 0.0, np.zeros(len(odds))
    for m in range(2**n):
        y = [m >> k & 1 for k in range(n)]
        w = np.exp(sum(o for o, s in zip(odds, y, strict=True) if s) + sum(step[a, b] for a, b in zip(y[:-1], y[1:], strict=True)))
        total += w
        p += w * np.array(y)
    return p / total


def test_marginals_are_exact():
    r = np.random.default_rng(0)
    f = toxicity.Field(step=r.normal(size=(2, 2)))
    lengths = [1, 7, 3, 5]
    odds = r.normal(size=sum(lengths)) * 2
    begin = np.r_[0, np.cumsum(lengths)[:-1]]
    p, inner, pair = f.marginals(odds, begin, pairs=True)
    assert np.allclose(p, np.concatenate([brute_marginals(odds[b : b + n], f.step) for b, n in zip(begin, lengths, strict=True)]))
    assert np.isclose(pair.sum(), len(inner))


def test_toxicity_on_held_out_rows(spark):
    rows = labelled(900, 1)
    docs = spark.createDataFrame([(k, t, 0.0) for k, t, _ in rows] + [(5000, None, 1.0), (5001, "", None), (None, "w1 idiot trash idiot", 2.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows] + [(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(k, y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(got[k].score >= 0.5) == (y == 1) for k, y in held]) > 0.97
    assert got[5000].score == got[5001].score < 0.5 and got[5000].spans == []
    assert got[None].score >= 0.5
    text = "w1 idiot trash idiot"
    assert [text[s.start : s.end] for s in got[None].spans] == ["idiot trash idiot"]
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.score < 0.5}
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(t):
    d = lambda s: re.sub(r"[^0-9]", "", s)

    def luhn(s):
        x = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(s))]
        return sum(v - 9 if v > 9 else v for v in x) % 10 == 0

    return {
        "email": [m.span() for m in EMAIL.finditer(t)],
        "ip": [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(t) if 16 <= len(d(m.group())) <= 19 and luhn(d(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(d(m.group())) <= 15],
    }


def test_base_spans_match_the_patterns():
    r = random.Random(4)
    bits = ["a.b@c", "@", ".com", "x", " ", "-", "é", "1.2.3.4", "255.", "0255.1.1.1", "+49 (30) 12", "4111 1111 1111 1111", "7", "12", ".", "+", "\n", "a@b.c@d.e", "٣", "00004111111111111111"]
    for _ in range(6000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 12)))
        assert pii.base_spans(t) == plain_base(t), repr(t)
    assert pii.base_spans("1" * 300_000 + "." + "x@" * 100_000)["ip"] == []


def sentences_with_pii(n, seed):
    r = random.Random(seed)
    card = lambda: next(x for x in (str(r.randrange(10**15, 10**16)) for _ in iter(int, 1)) if pii.luhn(x))
    word = lambda: "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 8)))
    rows = []
    for k in range(n):
        own = [f"write to {word()}.{word()}@{word()}.{r.choice(['com', 'org', 'de'])}", f"server at {r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}", f"card {card()}", f"call +{r.randint(20, 70)} {r.randrange(100, 999)} {r.randrange(10**6, 10**7)}", f"code {r.randrange(10**15, 10**16)}", f"on 2021-0{r.randint(1, 9)}-1{r.randint(0, 9)} 12:30", f"version {r.randint(1, 9)}.{r.randint(1, 9)}"]
        r.shuffle(own)
        rows.append((k, " ".join(f"{' '.join(word() for _ in range(8))} {x} ," for x in own)))
    return rows


OTHER_FORMS = {
    "email": ["mail anna.b (at) host (dot) com today", "contact max [at] mail.example.org please", "write joe at post dot net now"],
    "ip": ["server 10[.]20[.]30[.]40 is up", "host 192 dot 168 dot 0 dot 12 down"],
    "card": ["card 4111/1111/1111/1111 ok", "pay by 3782 822463 10005 soon"],
    "phone": ["call 0049 301 2345678 or", "tel (030) 1234567 now", "phone 030/4455667 later"],
}


def test_other_forms_are_added_and_clean_text_is_not(spark):
    rows = sentences_with_pii(400, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    models = pii.fit(docs)
    assert set(models) == set(pii.KINDS)
    found = {k: [pii.redactions(t, models, pii.base_spans(t)) for t in own] for k, own in OTHER_FORMS.items()}
    assert all(not any(plain_base(t).values()) for own in OTHER_FORMS.values() for t in own)
    hit = [any(x[0] == k for x in spans) for k, own in found.items() for spans in own]
    assert np.mean(hit) >= 0.8, found
    assert all(any(x[0] == k for spans in own for x in spans) for k, own in found.items())
    clean = ["the 12.03.2021 at noon. Then we met", "from 1990-2005 and 10.000.000 times", "code 1234567890123456 of the list", "see at page.two and 3.14.15", "in 2020-11-12 12:30:45 it was"]
    assert all(pii.redactions(t, models, pii.base_spans(t)) == [] for t in clean)


def test_boosted_trees_against_a_plain_version():
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(int)
    m = pii.Boosted().fit(x, y)

    def walk(tree, row):
        k = 0
        while tree[k][0] >= 0:
            k = 2 * k + 1 + (row[tree[k][0]] > tree[k][1])
        return tree[k][2]

    want = [1 / (1 + np.exp(-(m.start + sum(m.rate * walk(t, row) for t in m.trees)))) for row in x]
    assert np.allclose(m.predict(x), want) and np.mean((m.predict(x) > 0.5) == y) > 0.95
    p, z = np.array([0.9, 0.9, 0.8, 0.7, 0.6, 0.55]), np.array([1, 1, 1, 0, 1, 1])
    m.calibrate(p, z, 1.0)
    assert m.threshold == 0.75
    m.calibrate(p, z, 0.8)
    assert m.threshold == 0.55
    m.calibrate(p, 1 - z, 0.99)
    assert m.threshold > 1


def test_base_spans_and_redaction(spark):
    rows = sentences_with_pii(200, 3) + [(900, "two 4111111111111111 and 4111 1111 1111 1111 of them"), (901, None), (902, ""), (None, "mail a.b@c.de now"), (903, "x" * 200_000 + " a@b.c " + "1." * 50_000)]
    rows += [rows[0], (1, "again +49 30 1234567 here")]
    docs = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, spans int")
    models = pii.fit(docs)
    got = [(x.doc_id, x.base_sha256, x.spans, x.text, (x.n_email, x.n_ip, x.n_card, x.n_phone)) for x in pii.find(docs, models, text=True).collect()]
    want = []
    for k, t in rows:
        base = plain_base(t or "")
        listed = [f"{kind}:{a}:{b}" for kind in pii.KINDS for a, b in base[kind]]
        want.append((k, hashlib.sha256(",".join(listed).encode()).hexdigest(), tuple(len(base[c]) for c in pii.KINDS)))
        assert any(k == i and set(listed) <= set(filter(None, s.split(","))) for i, _, s, _, _ in got)
    assert sorted(map(str, want)) == sorted(str((k, h, n)) for k, h, _, _, n in got)
    text = {k: t for k, _, _, t, _ in got}
    assert text[900] == "two [CARD] and [CARD] of them" and text[None] == "mail [EMAIL] now" and text[901] == ""
    assert pii.find(docs.limit(0), models).count() == 0
    out = pii.redact_documents(docs, {})
    assert {x.doc_id for x in out.collect() if x.text is None} == {901} and out.columns == docs.columns


def test_packing_holds_every_token_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 120)
    r = random.Random(6)
    text = lambda n: " ".join("wö"[: r.randint(1, 2)] for _ in range(n))
    rows = [(k, text(r.choice([0, 1, 30, 700, 3000, 8191, 8192, 20000 if k % 50 == 0 else 40, r.randrange(900)]))) for k in range(300)] + [(1, None), (None, text(7)), (None, ""), (3, text(700)), (3, "a b"), (3, "a b"), (4, " \n ")]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, bin_id string")
    got = packing.pack(docs).collect()
    bins, parts = {}, {}
    for x in got:
        assert x.start == x.piece * 8192
        bins.setdefault(x.bin_id, []).append(x)
        parts.setdefault(x.doc_id, []).append(x)
    assert sum(x.length for x in got) == sum(len((t or "").split()) + 1 for _, t in rows)
    assert sorted(str(x.doc_id) for x in got if x.piece == 0) == sorted(str(k) for k, _ in rows)
    for k, t in rows:
        own = sorted(parts[k], key=lambda x: x.piece)
        if k is not None and sum(i == k for i, _ in rows) == 1:
            cut = [t[x.char_start : x.char_end] for x in own]
            assert "".join(cut) == t and sum(map(len, map(str.split, cut))) == len(t.split())
            assert [len(c.split()) for c in cut[:-1]] == [8192] * (len(cut) - 1) and own[-1].length == len(cut[-1].split()) + 1
    for b in bins.values():
        at = 0
        for x in sorted(b, key=lambda x: (x.bin_offset, x.length)):
            assert x.bin_offset == at
            at += x.length
        assert at == b[0].bin_fill and b[0].bin_size == min(s for s in packing.SIZES if s >= at)
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_by_tokens(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(k, " ".join(f"wörd{j * k}," for j in range(60 * k))) for k in range(6)] + [(9, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), packing.by_tokens(path), sizes=(64, 256)).collect()
    for k, t in rows:
        own = sorted((x for x in got if x.doc_id == k), key=lambda x: x.piece)
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert sum(x.length for x in own) == n + 1 and "".join((t or "")[x.char_start : x.char_end] for x in own) == (t or "")


def test_packing_by_ranks(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken.load

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tiktoken.load.load_tiktoken_bpe(path), special_tokens={})
    alphabet = ["wörd", " the", "🙂", "漢字", "\n\n", " 12", "ɸ", "\u200b", "  "]
    r = random.Random(14)
    rows = [(k, "".join(r.choice(alphabet) for _ in range(n))) for k, n in enumerate([0, 1, 20, 63, 64, 65, 500, 3000])]
    rows += [(20, "🙂" * 400), (21, " the" * 255), (22, " the" * 256), (23, " " * 30_000 + "x"), (24, None), (3, rows[6][1]), (3, rows[6][1]), (None, "ɸ" * 700)]
    docs = spark.createDataFrame([(*x, "x") for x in rows], "doc_id long, text string, rid string")
    got = packing.pack(docs, packing.by_ranks(path), sizes=(64, 256)).collect()
    for k, t in rows:
        own = sorted((x for x in got if x.doc_id == k), key=lambda x: x.piece)
        if k == 3:
            continue
        ids = plain.encode_ordinary(t) if k not in (23, 24) else [i for i in byte_bpe.bpe(path).encode([t or ""])[0]]
        assert [x.length for x in own] == [min(256, len(ids) + 1 - b) for b in range(0, len(ids) + 1, 256)]
        assert "".join((t or "")[x.char_start : x.char_end] for x in own) == (t or "")
        for x in own:  # the characters that are whole within the first tokens
            assert x.char_end == len(plain.decode_bytes(ids[: x.start + x.length]).decode(errors="ignore"))
    twice = len(plain.encode_ordinary(rows[6][1])) + 1
    assert sum(x.length for x in got if x.doc_id == 3) == 2 * twice + len(plain.encode_ordinary(rows[3][1])) + 1
    assert packing.pack(docs.limit(0), packing.by_ranks(path)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_against_a_plain_version(seed):
    r = random.Random(seed)
    lengths = sorted((r.randint(0, 100) for _ in range(200)), reverse=True)
    sizes = (40, 64, 100)
    bins, want, left = [], [], sum(lengths)
    for n in lengths:
        fits = [k for k, b in enumerate(bins) if b[0] - b[1] >= n]
        if fits:
            room = min(bins[k][0] - bins[k][1] for k in fits)
            ks = {k for k in fits if bins[k][0] - bins[k][1] == room}
        else:
            size = min((s for s in sizes if s >= n), key=lambda s: ((s + 5 + s * s / 900) / max(1, min(s, left)), s))
            ks = {len(bins)}
            bins.append([size, 0])
        want.append(ks)
        k = packing.best_fit(lengths, sizes, None, 5, 900)[0][len(want) - 1]
        assert k in ks
        bins[k][1] += n
        left -= n


def test_sizes_chosen_together_beat_each_alone():
    r = random.Random(3)
    price = lambda p: sum(packing.cost(s) for s in p[2])
    for lengths in ([r.choice([100, 600, 1100] * 5 + [5000]) for _ in range(400)], [min(8192, int(r.expovariate(1 / 700))) for _ in range(1000)]):
        own = packing.least_cost(sorted(lengths, reverse=True))
        largest = packing.best_fit(sorted(lengths, reverse=True), open_=(8192,))
        assert price(own) < price(largest) and sum(own[2]) <= 1.1 * sum(largest[2])
        assert price(own) <= price(packing.best_fit(sorted(lengths, reverse=True)))


def test_quality_counts_and_outliers(spark):
    r = random.Random(8)
    rows = []
    for k in range(700):
        w = [f"wörd{r.randrange(3000)}" for _ in range(r.randint(60, 200))]
        t = " ".join(w)
        if k % 50 == 0:
            t = "\n".join(["one same line here"] + [f"# | $ {x} * & <" for x in w])
        rows.append((k, t, "en" if k % 3 else None, "src0"))
    rows += [(8000, None, "en", "src0"), (8001, "", None, None), (8002, "a b a b a b\n \n \nx\nx\n", "de", "s"), (8003, " ".join(f"x{k}" for k in range(80)), "de", "s")]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, source string, n_words int")
    got = {x.doc_id: x for x in quality.judge(docs).collect()}
    for k, t, _, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {i + j for i, x in enumerate(tri) if tri.count(x) > 1 for j in range(3)} if k >= 8000 or k % 50 == 1 else None
        x = got[k]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup)
        if hit is not None:
            assert x.n_repeat_words == len(hit)
        assert x.base_failed == (len(w) < 50 or 100 * x.n_repeat_words > 50 * len(w)) and not (x.base_failed and x.kept)
    assert all(got[k].kept == (k % 50 != 0) for k in range(700))
    assert got[8003].outlyingness is not None  # judged by the estimate of all rows
    assert quality.judge(docs.limit(0)).count() == 0


def test_small_groups_are_judged_by_coarser_estimates(spark):
    r = random.Random(13)
    text = lambda bad: "\n".join(f"#|$w{r.randrange(3000)}*&<" if bad else f"w{r.randrange(3000)} w{r.randrange(3000)}" for _ in range(r.randint(60, 120)))
    bad = {7, 95, 196, 205}
    rows = [(k, text(k in bad), "en" if k < 180 else f"l{k}" if k % 2 else None, f"s{k % 30}") for k in range(210)]  # no group has LEAST rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x for x in quality.judge(docs).collect()}
    assert set(got) == set(range(210)) and all(x.outlyingness is not None for x in got.values() if not x.base_failed)
    assert {k for k, x in got.items() if not x.kept} == bad and not any(got[k].base_failed for k in bad)
    few = quality.judge(docs.where("doc_id < 3")).collect()
    assert len(few) == 3 and all(x.kept and x.outlyingness is not None for x in few)
    assert quality.judge(docs.limit(0)).count() == 0
    assert abs(quality.chi_squared(0.25) - 6.6257) < 1e-3


def plain_mcd(x, r, trials=60):
    """FAST-MCD: concentration from random starts to the end; the subset of least determinant."""
    n, h = len(x), int(np.ceil(quality.SUPPORT * len(x)))
    best = (np.inf, None)
    for _ in range(trials):
        own = x[r.choice(n, 20, replace=False)]
        for _ in range(50):
            cov = np.cov(own.T, bias=True) + np.diag(np.square(quality.FLOOR))
            d = np.einsum("ij,jk,ik->i", x - own.mean(axis=0), np.linalg.inv(cov), x - own.mean(axis=0))
            chosen = x[np.argsort(d, kind="stable")[:h]]
            if np.array_equal(chosen, own):
                break
            own = chosen
        best = min(best, (np.linalg.det(np.cov(own.T, bias=True) + np.diag(np.square(quality.FLOOR))), own.tolist()))
    own = np.array(best[1])
    cov = np.cov(own.T, bias=True) + np.diag(np.square(quality.FLOOR))
    d = np.einsum("ij,jk,ik->i", x - own.mean(axis=0), np.linalg.inv(cov), x - own.mean(axis=0))
    return best[0], d / (np.sort(d)[h - 1] / quality.SUPPORT_QUANTILE)


def test_estimates_against_plain_mcd(spark):
    r = np.random.default_rng(4)
    mix_ = r.normal(size=(5, 5))
    x = np.r_[r.normal(size=(600, 5)) @ mix_, r.normal(size=(120, 5)) * 0.3 + 25]
    frame = spark.createDataFrame([("en", "s", *map(float, row)) for row in x], "lang string, source string, x0 double, x1 double, x2 double, x3 double, x4 double")
    (m,) = quality.estimates(frame).where("level = 0").collect()
    det, want = plain_mcd(x, r)
    assert m.det <= 1.1 * det
    p = np.zeros((5, 5))
    for i in range(5):
        for j in range(i, 5):
            p[i, j] = p[j, i] = m[f"p{i}{j}"]
    d = x - np.array([m[f"m{i}"] for i in range(5)])
    got = np.einsum("ij,jk,ik->i", d, p, d) / m.scale
    assert np.array_equal(got > quality.CUTOFF, want > quality.CUTOFF) and (want[600:] > quality.CUTOFF).all() and np.median(got[:600] / want[:600]) < 1.15


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1500, 16))
    v[200:700] = v[200]  # one very frequent vector
    rows = [(k, x.tolist()) for k, x in enumerate(v)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] + [1.0] * 15), (2004, [None] + [1.0] * 15), (2005, [1.0] * 3), (None, v[1].tolist())]
    df = spark.createDataFrame([(*x, "n") for x in rows], "vec_id long, embedding array<double>, leaf string")
    index = Index(df)
    got = {}
    for x in index.search(index.rows.where("vid % 20 = 0")).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    assert set(got) == set(range(0, 1500, 20))
    hit = 0
    for q, found in got.items():
        found.sort()
        s = np.array([sum(a * b for a, b in zip(v[q].tolist(), x, strict=True)) for x in v.tolist()])
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:20]
        hit += len({i for _, i, _ in found} & set(want.tolist()))
        assert [r for r, _, _ in found] == list(range(1, 21)) and np.allclose([x for _, _, x in found], s[[i for _, i, _ in found]])
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
    assert hit / (20 * len(got)) >= 0.9
    few = Index(df.where("vec_id < 5"))
    assert few.search(few.rows).count() == 20
    none = Index(df.limit(0))
    assert none.search(none.rows).count() == 0
    again = Index(df.where("vec_id < 3").union(df.where("vec_id = 1")))
    assert [x.query_id for x in again.search(again.rows).orderBy("query_id").collect()] == [0] * 3 + [1] * 4 + [2] * 3


def test_leaves_stay_bounded_and_fewer_are_visited(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 200)
    monkeypatch.setattr(ann, "SPLIT", 150)
    monkeypatch.setattr(ann, "GROUP_ROWS", 500)
    rng = np.random.default_rng(6)
    share = {}
    for n in (1000, 8000):
        centre = rng.normal(size=(n // 40, 16))
        v = np.repeat(centre, 40, axis=0) + 0.15 * rng.normal(size=(n, 16))
        index = Index(spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>"), sample_rows=800)
        assert max(index.size.values()) <= 200 and sum(index.size.values()) == n
        share[n] = index.visits / len(index.size)
        ids = list(range(0, n, n // 50))
        got = {(x.query_id, x.vec_id) for x in index.search(index.rows.where(f"vid % {n // 50} = 0")).collect()}
        s = v[ids] @ v.T
        s[np.arange(len(ids)), ids] = -np.inf
        want = {(q, int(i)) for q, row in zip(ids, s, strict=True) for i in np.argsort(-row)[:20]}
        assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)
    assert share[8000] < 0.8 * share[1000] < 0.2


@pytest.mark.parametrize(("times", "alike"), [(6, False), (30, True)])
def test_nearest_of_repeated_ids(spark, times, alike):
    r = np.random.default_rng(times)
    rows = [(k, r.normal(size=6).tolist()) for k in range(60)]
    again = rows[20][1] if alike else None
    rows += [(20, again or r.normal(size=6).tolist()) for _ in range(times - 1)] + [(40, rows[20][1])]
    index = ann.Index(spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, rank int"))
    got = {}
    for x in index.search(index.rows.where("vid % 20 = 0")).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, round(x.score, 9)))
    want = {}
    for i, q in rows:
        if i % 20 == 0:
            best = sorted((-round(float(np.dot(q, v)), 9), j) for j, v in rows if j != i)[:20]
            want.setdefault(i, []).extend((k, j, -s) for k, (s, j) in enumerate(best, 1))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    assert all(len(x) % 20 == 0 for x in got.values())


def test_pii_of_the_given_tables_finds_forms_in_new_contexts(spark):
    at = "/root/testdata/sf0.1/documents.parquet"
    if not os.path.exists(at):
        pytest.skip("no given tables")
    models = pii.fit(spark.read.parquet(at))
    r = random.Random(99)
    found = {k: [0, 0] for k in pii.KINDS}
    contexts = ["Mail {} now please.", "You can reach us under {} at any time", "El texto sigue aqui {} y termina.", "see also: {}\nNext line"]
    for kind in pii.KINDS:
        for _ in range(25):
            span = pii.made_up(kind, r)
            for form in range(pii.FORMS[kind]):
                own = pii.rewritten(kind, span, r, form)
                for c in ["Call {} now please.", "tel. {} at any time", "Fax {}\nNext line"] if kind == "phone" else contexts:
                    text = c.format(own)
                    got = pii.redactions(text, models, pii.base_spans(text))
                    found[kind][0] += any(k == kind and own in text[a:b] for k, a, b in got)
                    found[kind][1] += 1
    assert all(hit >= 0.9 * n for hit, n in found.values()), found
    clean = ["We met at noon. Then at nine. Later 12.10.2024 came, and 3.14.15.92 was no number of ours.", "Values (at) 1.25 or at 2.50 rose; 2019-2024; 12 of 100.000 and 7/8/9.", "look at this. Dot by dot it went on at home."]
    assert all(not pii.redactions(t, models, pii.base_spans(t)) or pii.redactions(t, models, pii.base_spans(t)) == [(k, *s) for k in pii.KINDS for s in pii.base_spans(t)[k]] for t in clean)
