"""Registered queries without SQL over planted rows, one for each outcome."""

import hashlib
import random

import pytest

from sparkmill import catalog, plans  # noqa: F401


def prose(seed, n=90):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnopqrsuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(n))


def between(piece, n, seed):
    return "\n".join(f"{prose(seed + k, 25)}.\n{piece}" for k in range(n))


SAID = "this very same sentence comes back again and again here."
TEXTS = {
    1: prose(1),
    2: "short",
    3: "",
    4: "ab cd ef gh " * 400,
    5: between(SAID, 6, 50),
    6: prose(6) + " http://a.example/x www.b.example http://c.example https://d.example/y",
    7: "".join(f"<b>{prose(70 + k, 8)}</b> " for k in range(8)),
    8: "\n".join(f"always the same beginning of {prose(80 + k, 6)}" for k in range(14)),
    9: "12 34 " * 60 + prose(9, 3),
    10: prose(10) + " As an AI language model " + prose(11),
    11: prose(12) + " TODO " + prose(13),
    12: prose(14) + "�" * 40,
    13: prose(15, 12_000),
}


def documents(spark, at, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("planted"))
    documents(spark, at, [(k, t, "en" if k == 9 else "de", "src1", len(t)) for k, t in TEXTS.items()])
    return at


def reasons(spark, at, name):
    return {x.doc_id: x.reason for x in catalog.QUERIES[name](spark, at).collect()}


def test_clean_document(spark, planted):
    own = {2: "too_short", 3: "too_short", 4: "poison_repetition", 5: "repeated_sentences", 6: "url_density", 7: "markup_density", 8: "repeated_line_prefix", 9: "language_mismatch"}
    assert reasons(spark, planted, "f11_clean_document") == dict.fromkeys(TEXTS, "") | own


def test_mix_clean(spark, planted):
    own = {2: "too_short", 3: "empty", 4: "poison_repetitive", 5: "repeated_sentences", 10: "ai_mention", 11: "placeholder", 12: "mojibake"}
    assert reasons(spark, planted, "f17_mix_clean") == dict.fromkeys(TEXTS, "") | own


def test_text_health(spark, planted):
    want = {}
    for k, t in TEXTS.items():
        n = int(hashlib.sha256(t.encode()).hexdigest()[:8], 16) % 10_000
        own = want.setdefault("train" if n < 9600 else "val" if n < 9800 else "test", [0, 0, 0, []])
        own[0] += 1
        own[1] += k == 4
        own[2] += k == 5
        own[3] += [k] if k in (4, 5) else []
    got = {x.split: x for x in catalog.QUERIES["a25_text_health_scan"](spark, planted).collect()}
    mean = got.pop("mean")
    assert {s: [x.samples, x.poison, x.repeated, x.examples or []] for s, x in got.items()} == want
    rates = {s: 1 - (p + r) / n for s, (n, p, r, _) in want.items()}
    assert {s: x.safe_rate for s, x in got.items()} == pytest.approx(rates, abs=1e-6)
    assert mean.samples == len(TEXTS) and mean.safe_rate == pytest.approx(sum(rates.values()) / len(rates), abs=1e-6)


def test_near_admission(spark, tmp_path):
    twice = between("x" * 30 + " one sentence of some length that is said so often here.", 14, 900)
    rows = [
        (1, prose(1), "de", "src5", 1),
        (2, prose(2), "de", "src5", 1),
        (3, prose(1).upper(), "de", "src1", 1),  # the same in the comparison form
        (4, prose(2) + " tail", "de", "src1", 1),
        (5, prose(5), "de", "src1", 1),  # in the manifest
        (6, "y " + twice, "de", "src1", 1),
        (7, prose(7), "de", "src2", 1),
        (8, prose(1), "de", "src2", 1),  # in the manifest too: the first reason counts
        (9, "", "de", "src2", 1),
    ]
    documents(spark, tmp_path, rows)
    labels = [(5, 0, 0), (5, 0, 0), (7, 1, 0), (8, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = {3: "legacy_exact_overlap", 4: "legacy_near_overlap", 5: "manifest", 6: "severe_repetition", 7: "", 8: "legacy_exact_overlap", 9: ""}
    assert reasons(spark, str(tmp_path), "g04_near_admission") == want


def test_pages_to_documents(spark, tmp_path):
    pages = {
        1: ("<html><head><title>no</title></head><body><h1>Head</h1><p>One &amp; two<br>three</p><script>x < y</script></body></html>", "Head\nOne & two\nthree"),
        2: ("<nav>menu</nav><!-- hidden -->\n<style>p {}</style>", ""),
        3: ("<div>a</div><div> </div><div> </div><div> </div><div>b</div>", "a\n\nb"),
        4: ("plain &lt;b&gt; &quot;text&quot;", 'plain <b> "text"'),
        5: ("", ""),
    }
    spark.createDataFrame([(k, f"http://p/{k}", h) for k, (h, _) in pages.items()], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {x.page_id: (x.text, x.raw_sha256, x.text_sha256, x.reason) for x in catalog.QUERIES["s11_pages_to_documents"](spark, str(tmp_path)).collect()}
    assert got == {k: (t, sha(h), sha(t), "" if t else "empty") for k, (h, t) in pages.items()}
