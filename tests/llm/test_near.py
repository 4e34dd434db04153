import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from sparkmill.llm import near_copies, simhash, substring
from sparkmill.llm.common import maybe
from sparkmill.llm.components import components


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    sh = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(items):
    """{id: smallest id reachable} from (id, number) by links at 2 bits."""
    root = dict((i, i) for i, _ in items)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in items:
        for j, b in items:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in items}


def test_masks_cover_every_pair():
    for i in range(64):
        for j in range(i, 64):
            d = 1 << i | 1 << j
            hit = [v for v in range(7) if not d & simhash.MASKS[v]]
            assert hit
            for v in hit:
                assert any(not d & m for m in simhash.FINER[v])
    assert max(64 - m.bit_count() for own in simhash.FINER for m in own) <= 12


def test_groups_match_brute_force(spark):
    r = random.Random(5)
    vocab = [f"w{k}" for k in range(60)]
    base = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 40))) for _ in range(25)]
    rows = []
    for k in range(160):
        w = r.choice(base).split(" ")
        if w and r.random() < 0.5:
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((k * 3 + 1, " \t".join(w).upper() if r.random() < 0.2 else " ".join(w), "x"))
    rows += [(9000, None, "y"), (9001, "", None), (9002, " \n ", "z"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    want_fp = {i: plain_fingerprint(t) for i, t, _ in rows}
    want = plain_components(list(want_fp.items()))
    for bucket in (1024, 1):
        got = simhash.near_groups(df, bucket=bucket).collect()
        assert len(got) == len(rows)
        assert all(x.fingerprint == f"{want_fp[x.doc_id]:016x}" for x in got)
        assert all(x.component_id == want[x.doc_id] for x in got)
    assert {x.doc_id for x in simhash.keep_one(df).collect()} == {i for i in want if want[i] == i}
    assert simhash.near_groups(df.limit(0)).count() == 0
    # Rows go by their own text, not by their id; a row that repeats an id and its text stays once.
    repeats = spark.createDataFrame([(1, "a b c d e", "p"), (None, "a b c d e", "q"), (None, "x y z u v", "r"), (5, "a b c d e", "s"), (5, "f g h i j k", "t"), (9, "l m n o p q", "u"), (9, "l m n o p q", "u")], "doc_id long, text string, rid string").withColumnRenamed("rid", "_near_id")
    for keep in (simhash.keep_one, near_copies.keep_one):
        kept = keep(repeats)
        assert kept.columns == repeats.columns and sorted(x._near_id for x in kept.collect()) == ["p", "r", "t", "u"]
    none = spark.createDataFrame([(None, "a b c d"), (None, "e f g h i"), (7, "a b c d")], "doc_id long, text string")
    assert sorted((x.doc_id or 0, x.component_id or 0) for x in simhash.near_groups(none).collect()) == [(0, 0), (0, 7), (7, 7)]


def test_many_close_fingerprints_link_exactly(spark):
    r = random.Random(9)
    numbers = {r.getrandbits(64) & ~0xFFF | r.getrandbits(12) if r.random() < 0.2 else 0x1234567800000000 | r.getrandbits(9) << 3 for _ in range(300)}
    items = [(k, x) for k, x in enumerate(sorted(numbers))]
    unique = spark.createDataFrame([(simhash.signed(x),) for _, x in items], "fp long")
    want = plain_components(items)
    for bucket in (1024, 16):
        root = dict(map(tuple, components(simhash.links(unique, bucket)).collect()))
        own = {k: root.get(simhash.signed(x), simhash.signed(x)) for k, x in items}
        assert len(set(own.values())) == len(set(want.values())) == len({(own[k], want[k]) for k in own})


def test_components_of_long_paths(spark):
    order = list(range(300))
    random.Random(3).shuffle(order)
    edges = [(order[k], order[k + 1]) for k in range(149)] + [(order[k], order[150]) for k in range(151, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: min(order[:150]) for x in order[:150]} | {x: min(order[150:]) for x in order[150:]}


def plain_repeats(rows, window=20):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first, out = {}, {}
    for i in sorted(words):
        w = words[i]
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first.setdefault(tuple(w[s : s + window]), (i, s)) != (i, s):
                gone[s : s + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def test_repeats_match_brute_force(spark, monkeypatch):
    r = random.Random(11)
    vocab = [f"{'ÄbcÖ'[k % 4]}{k}" for k in range(2000)]
    passages = [[r.choice(vocab) for _ in range(r.randint(15, 90))] for _ in range(12)] + [["a"] * 70, ["a", "b"] * 40, ["a", "b", "c"] * 30]
    rows = []
    for i in range(120):
        w = []
        for _ in range(r.randint(0, 5)):
            w += r.choice(passages)[r.randint(0, 30) : r.randint(40, 120)] if r.random() < 0.6 else [r.choice(vocab) for _ in range(r.randint(1, 50))]
        rows.append((i * 7, r.choice([" ", "\n", " \t "]).join(w)))
    rows += [(5000, None), (5001, ""), (5002, rows[3][1]), (5003, rows[3][1] + " x")]
    want = plain_repeats(rows)
    assert sum(v[1] for v in want.values()) > 500
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int").repartition(5)
    for held in (1 << 20, 40):
        monkeypatch.setattr(substring, "HELD", held)
        got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in substring.remove_repeats(df).collect()}
        assert got == want
    for x in substring.remove_repeats(df).collect():
        assert hashlib.sha256(" ".join(x.text.split()).encode()).hexdigest() == x.kept_sha256
    assert substring.remove_repeats(df.limit(0)).count() == 0
    twice = spark.createDataFrame([rows[3], rows[3], (None, rows[3][1]), (None, "q")], "doc_id long, text string")
    assert sorted((x.doc_id or -1, x.n_removed) for x in substring.remove_repeats(twice).collect())[-1][1] == want[rows[3][0]][1] or rows[3][0] == 0


def test_windows_take_the_same_name_wherever_they_are():
    r = np.random.default_rng(1)
    word = r.integers(0, 2**63, 40).astype(np.uint64)
    part = [word[r.integers(0, k, 60)] for k in (1, 2, 3, 8, 40)] + [np.tile(word[:2], 40), np.tile(word[:3], 30), np.tile(word[[0, 0, 1]], 30)]
    names, seen = {}, 0
    for _ in range(40):
        text = np.concatenate([part[k][: r.integers(20, 60)] for k in r.integers(0, len(part), 6)])
        p = substring.Parsed(PlainWords(text))
        assert len(p.start) == len(text) - 19 and (p.key != 0).all()
        for s, key, mark in zip(p.start, p.key, p.mark, strict=True):
            own = names.setdefault(text[s : s + 20].tobytes(), (key, mark - 3 * s))
            seen += own == (key, mark - 3 * s)
            assert own == (key, mark - 3 * s)
    assert seen > len(names) + 1000
    same = substring.parsed(np.array([7] * 5 + [9], dtype=np.uint64), np.zeros(6, dtype=np.int64))
    assert len(same.name) <= 2  # a run is one symbol


class PlainWords:
    """What Parsed needs of the words of one text."""

    def __init__(self, name):
        self.name, self.row = name, np.zeros(len(name), dtype=np.int64)


def test_repeated_ids_null_ids_and_a_large_group_of_copies(spark):
    r = random.Random(17)
    text = lambda n: " ".join(f"w{r.randrange(9000)}" for _ in range(n))
    shared, unique, copy = text(60), text(100), text(80)
    rows = [(7, shared + " " + text(30)), (7, unique + " " + shared), (None, shared), (None, text(50)), (None, copy), (None, "")]
    rows += [(100 + k, copy) for k in range(1500)] + [(5000, "short text"), (5001, "short text"), (8, copy + " end"), (9, "a b " * 300), (9, "a b " * 300)]
    docs = spark.createDataFrame([(i, t, f"k{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, rid string").repartition(200)
    docs = docs.withColumn("spans", docs.rid).withColumn("first", docs.rid)
    got = {}
    for x in substring.cut_repeats(docs).collect():
        assert x.spans == x.first == x.rid
        got[int(x.rid[1:])] = x.text
    assert set(got) == set(range(len(rows)))
    kept = {k: len((got[k] or "").split()) for k in got}
    # The two texts of id 7 are two documents: one of them keeps the passage that both have, nothing else goes.
    assert sorted([kept[0], kept[1]]) in ([30, 160], [90, 100]) and unique in got[1]
    assert kept[2] == 0 and kept[3] == 50 and kept[4] == 0
    assert [kept[k] for k in range(6, 1506)] == [0] * 1500  # id 8 has their text first
    assert kept[1506] == kept[1507] == 2 and kept[1508] == 81
    assert kept[1509] == kept[1510] and 0 < kept[1509] < 30  # rows that repeat a document don't cover each other
    assert substring.cut_repeats(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    r = random.Random(18)
    passage = [f"p{r.randrange(10**6)}" for _ in range(50)]
    w = [f"w{r.randrange(10**6)}" for _ in range(300_000)]
    w[1000:1000] = passage
    w[250_000:250_000] = passage
    (x,) = substring.remove_repeats(spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")).collect()
    assert (x.n_words, x.n_removed) == (300_100, 50)


def edited(r, n, words, edits, tag=""):
    base = [f"{tag}b{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in r.sample(range(words), edits):
            w[k] = f"{tag}e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def plain_near(rows, size=5, least=0.8):
    """All pairs through a bit matrix; the components' smallest ids."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)})
    names = {s: k for k, s in enumerate({s for x in sets for s in x})}
    m = np.zeros((len(sets), len(names)), dtype=np.float32)
    for k, x in enumerate(sets):
        m[k, [names[s] for s in x]] = 1
    shared, n = m @ m.T, m.sum(axis=1)
    i, j = np.nonzero(shared >= least * (n[:, None] + n[None] - shared) - 1e-6)
    root = np.arange(len(rows))
    while (root[i] != root[j]).any():
        np.minimum.at(root, np.maximum(root[i], root[j]), np.minimum(root[i], root[j]))
        root = root[root]
    least_id = {}
    for k, g in enumerate(root.tolist()):
        least_id[g] = min(least_id.get(g, rows[k][0]), rows[k][0])
    return {rows[k][0]: least_id[g] for k, g in enumerate(root.tolist())}


@pytest.mark.parametrize("tile", [64])
def test_near_copies_of_large_groups(spark, monkeypatch, tile):
    monkeypatch.setattr(near_copies, "TILE", tile)
    r = random.Random(11)
    texts = edited(r, 300, 200, 3, "x") + edited(r, 400, 120, 2, "y") + edited(r, 200, 150, 1, "z") + [f"short {k % 40}" for k in range(80)] + edited(r, 12, 40, 1, "v")
    rows = list(enumerate(texts)) + [(5000, texts[3]), (5001, None), (5002, "")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, tile int")
    got = {x.doc_id: x.component_id for x in near_copies.near_groups(docs).collect()}
    assert got == plain_near(rows)
    assert sum(got[k] == k for k in range(300)) > 10


def test_few_texts_are_fetched_and_none_is_missed(spark):
    docs = spark.range(0, 6000, 3).selectExpr("if(id % 7 = 0, null, id) as doc_id", "concat('text ', id % 900) as text").repartition(5)
    own = near_copies._own(docs, "doc_id").select("rid", "h", "text")
    for share in (0, 1, 50):
        wanted = own.where(f"pmod(xxhash64(text), 1000) < {share}").select("rid", "h").distinct()
        want = {(x.rid, x.h, x.text) for x in own.join(wanted, ["rid", "h"]).collect()}
        sent = [tuple(x) for x in maybe(own, wanted, "rid", "h").collect()]
        assert want <= set(sent) and len(set(sent) - want) <= 2
        got = near_copies._texts(docs, "doc_id", wanted.selectExpr("struct(rid, h) as node"))
        assert {tuple(x) for x in got.select("rid", "h", "text").collect()} == want


def test_shared_counts():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 6000, 3000).astype(np.uint64)) for _ in range(12)] + [np.zeros(0, dtype=np.uint64)]
    left, right = np.arange(5), np.arange(5, 13)
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]
    assert near_copies.shared_counts(sets, left, right).astype(int).tolist() == want
