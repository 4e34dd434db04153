"""The pipeline against its operators' plain versions, on planted documents."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from sparkmill.llm import byte_bpe, near_copies, toxicity

from .test_near import plain_components, plain_fingerprint, plain_near, plain_repeats


def n_tokens(text):
    return len(byte_bpe.bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).encode([text or ""])[0]) + 1


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    r = random.Random(12)
    words = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    passage = words(60)
    rows, labels = [], []
    for k in range(400):
        w = words(r.randint(40, 120))
        if k % 5 == 0:
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "trash", "moron"]))
        if k % 11 == 1:
            w += passage
        if k % 13 == 2:
            w += ["mail", f"user{k}@example.com"]
        rows.append((k, " ".join(w), "en", f"src{k % 3}", 0))
        labels.append((k, 1, int(k % 5 == 0)))
    rows += [(1000 + k, rows[3][1], "en", "src0", 0) for k in range(30)] + [(2000, None, None, None, None), (2001, "", "en", "src1", 0)]
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_stages(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    columns = docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{planted}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("score >= 0.5").collect()}
    assert toxic == set(range(0, 400, 5))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "pii", "best_fit_packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, planted)
        assert out.columns == columns
        got = {r.doc_id: r for r in out.collect()}
        if k == 0:
            assert set(got) == set(before) - toxic
        elif k == 1:
            root = plain_components([(i, plain_fingerprint(t)) for i, t in before.items()])
            assert set(got) == {i for i in before if root[i] == i}
        elif k == 2:
            want = plain_repeats(list(before.items()))
            assert {i: len((x.text or "").split()) for i, x in got.items()} == {i: n - gone for i, (n, gone, _) in want.items()}
            assert sum(gone for _, gone, _ in want.values()) > 500
        else:
            assert set(got) == set(before) and all("@" not in (x.text or "") for x in got.values())
            assert all(x.text == before[i] for i, x in got.items() if "@" not in (before[i] or ""))
        assert all(x.n_chars == len(x.text) for x in got.values() if x.text is not None and k >= 2)
        out.write.parquet(at := f"{planted}/stage{k}")
        docs = spark.read.parquet(at)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, planted).collect()
    assert {p.doc_id: p.length for p in pieces} == {r.doc_id: n_tokens(r.text) for r in docs.collect()}


def test_run_gives_what_the_stages_give(spark, planted):
    assert corpus_pipeline.run(spark, planted).select("doc_id").distinct().count() > 300
    assert corpus_pipeline.ORACLE_SQL is None


def test_edited_copies_go(spark):
    r = random.Random(21)
    base = [[f"w{r.randrange(5000)}" for _ in range(r.randint(60, 400))] for _ in range(60)] + [["one", "short", "text"], []]
    rows = []
    for w in base:
        for _ in range(4):
            edited = list(w)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                if edited:
                    edited[r.randrange(len(edited))] = f"x{r.randrange(5000)}"
            rows.append((len(rows), " ".join(edited)))
    docs = spark.createDataFrame([*rows, (len(rows), None), (None, "q")], "doc_id long, text string").repartition(3)
    sets = {i: frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) for i, t in rows for w in [t.split()]}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = [x.doc_id for x in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(x for x in got if x is not None) == [i for i in sets if root[i] == i] and got.count(None) == 1
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0


def test_no_pair_within_the_radius_is_missed(spark):
    pairs = []
    for seed, k in ((10, 724), (38, 300), (39, 583)):  # pairs of similarity 0.81 that share no MinHash block
        r = random.Random(seed)
        for _ in range(k + 1):
            passage = " ".join(f"w{r.randrange(9000)}" for _ in range(17))
            pair = [" ".join([passage] * 10 + [f"w{r.randrange(9000)}" for _ in range(2)]) for _ in range(2)]
        _, name, first = near_copies.shingles(pa.array(pair))
        assert len(set(near_copies.minima(name, first).ravel().tolist())) == 2 * near_copies.BANDS and len(set(map(plain_fingerprint, pair))) == 1
        pairs += pair
    docs = spark.createDataFrame(list(enumerate(pairs)), "doc_id long, text string")
    assert sorted(x.doc_id for x in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [0, 2, 4]


def test_large_buckets_of_fingerprints_are_compared_wholly(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "TILE", 16)
    r = random.Random(34)
    words = lambda n: [f"w{r.randrange(9000)}" for _ in range(n)]
    texts = []
    for n, of, tail in ((9, 40, 2), (9, 31, 6), (15, 21, 9)):  # a passage many times and a few words of one's own
        passage = words(n) * of
        texts += [" ".join(passage + words(tail)) for _ in range(40)]
    texts += [" ".join(words(40)) for _ in range(30)]
    r.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.component_id for x in near_copies.near_groups(docs, similarity=0.4, by_fingerprint=True).collect()}
    all_pairs, fp = plain_near(rows, least=0.4), [plain_fingerprint(t) for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    assert all(all_pairs[i] == all_pairs[c] for i, c in got.items())
    close = [(i, j) for i in got for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 2 and len(sets[i] & sets[j]) >= 0.4 * len(sets[i] | sets[j])]
    assert len(close) > 500 and all(got[i] == got[j] for i, j in close)


def test_stages_on_repeated_and_null_ids_and_clashing_columns(spark, planted, tmp_path):
    r = random.Random(31)
    text = lambda n: " ".join(f"w{r.randrange(9000)}" for _ in range(n))
    one, two, copy = text(90), text(80), text(70)
    rows = [(7, one), (7, two), (None, text(60)), (None, copy), (5, copy), (9, "mail a.b@c.de now " + text(60)), (9, "mail a.b@c.de now " + text(50)), (11, None), (None, ""), (12, text(20_000))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, k, k, k, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, _near_id int, __rid int, __spans int, spans int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{planted}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        kept = {x.spans: x for x in out.collect()}
        assert all(x._near_id == x["__rid"] == x["__spans"] == k for k, x in kept.items())
        assert all(kept[k].doc_id == rows[k][0] for k in kept) and {0, 1, 2, 4, 5, 6, 9} <= set(kept)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert 3 not in kept and kept[0].text == one and kept[1].text == two and "[EMAIL]" in kept[5].text and len(kept[9].text.split()) == 20_000
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sum(x.length for x in packed) == sum(n_tokens(x.text) for x in kept.values()) and {x.doc_id for x in packed} == {x.doc_id for x in kept.values()}
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
