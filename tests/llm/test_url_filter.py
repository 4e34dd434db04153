from sparkmill.llm import url_filter as u


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:k], rest[k:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for block, h, p in u.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and len(h + p) > len(best[0] if best else ""):
            best = (h + p, block)
    return host, path, best


URLS = [None, "", "nothing", "http://x.org", "http://x.org/", "http://X.ORG/a?b#c", "http://a.example.org/es/1", "http://example.org/es", "http://example.org/en/12", "http://example.org/en/2", "ftp://com/fr/x", "http://a.com/de/", "http://acom/de/", "http://a.com?de/", "a://b://c.org/d", "http://É.com/de/ü", "http://notexample.org/es/"]


def test_rules_match_brute_force(spark):
    pages = spark.createDataFrame([(k, x, "h") for k, x in enumerate(URLS)], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in u.judge(pages, u.mine(pages, labels)).collect()}
    for k, x in enumerate(URLS):
        host, path, best = plain(x)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, best and best[0]), x
        assert got[k].verdict == ("block" if best and best[1] else "allow")
    assert u.judge(pages.limit(0), u.mine(pages, labels)).count() == 0


def test_mined_rules_match_brute_force(spark):
    rows, labels = [], []
    for k in range(600):
        bad = k % 5 == 0
        host = f"m.{'cheap-pills' if bad else 'news'}.example.net"
        path = "de" if k % 2 else "en"
        rows.append((k, f"http://{host}/{path}/{k}.html" + "?ref=x" * (k % 3 == 0)))
        if k % 7:
            labels.append((k, 0 if bad and path == "de" else 1, None))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    mined = u.mine(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), support=0.02)
    rules = [set(r.rule_tokens) for r in mined.collect()]
    assert rules and all("host=cheap-pills" in r and "path=de" in r for r in rules)
    got = {r.page_id: r.verdict for r in u.judge(pages, mined).collect()}
    assert got == {k: "block" if k % 5 == 0 and k % 2 else "allow" for k in range(600)}


def test_few_pages_prove_nothing_and_longer_rules_go(spark):
    rows = [(k, f"http://www.{'rare' if k < 8 else 'spam' if k % 4 == 0 else 'fine'}.example.net/a/b/{k}") for k in range(400)] + [(999, "http://www.spam.example.net/a/b/x"), (999, None)]
    pages = spark.createDataFrame([(*x, 1.0) for x in rows], "page_id long, url string, confidence double")
    labels = spark.createDataFrame([(k, int(not (k < 8 or k % 4 == 0)), 0) for k in range(400)] + [(1, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    mined = u.mine(pages, labels)
    assert [r.rule_tokens for r in mined.collect()] == [["host=spam"]] and mined.first().pages == 98
    got = [(r.page_id, r.verdict) for r in u.judge(pages, mined).collect()]
    assert sorted(got) == sorted([(k, "block" if k >= 8 and k % 4 == 0 else "allow") for k in range(400)] + [(999, "block"), (999, "allow")])
    assert u.mine(pages.limit(0), labels).count() == 0


def test_pages_of_many_tokens(spark):
    frame = "/".join(f"f{c}{d}" for c in "abcdefgh" for d in "klmno")  # 40 tokens on every page
    rows = [(k, f"http://www.example.net/{frame}/{'zz-spam' if k % 4 == 0 else 'fine'}/{'late' if k % 2 else 'soon'}/{k}") for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k % 4 != 0), 0) for k in range(400)], "doc_id long, quality int, toxic int")
    mined = u.mine(pages, labels)
    assert [r.rule_tokens for r in mined.collect()] == [["path=zz-spam"]]
    assert {r.page_id: r.verdict for r in u.judge(pages, mined).collect()} == {k: "block" if k % 4 == 0 else "allow" for k in range(400)}
