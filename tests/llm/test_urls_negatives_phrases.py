"""URL filters, hard-negative mining and phrase collocations against brute
force, cut into many shards and blocks, and on awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import collocations, hard_negatives, queries, url_filter

CLASH = "host string, path string, rule string, fit string, address string, component string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship_package(spark)


def link(href):
    return f"<html><head><LINK href='{href}' rel=canonical></head></html>"


def refresh(url):
    return f'<meta http-equiv="refresh" content="0; URL={url}">'


PAGES = [
    (1, "http://A.example.org/en/12", link("https://shop.net/x#top")),  # blocked by a rule, an alias of shop.net/x
    (2, "https://shop.net/x?", None), (3, "https://shop.net/x", refresh("/y?a=1&amp;b=2")), (4, "ftp://shop.net/y?a=1&b=2", ""),
    (5, "http://shop.net/y", None),
    (6, "http://b.org/z", refresh("//shop.net/y?a=1&b=2")),  # an alias too, but allowed by its rule
    (7, "http://example.org/es", link("http://free.net/")), (8, "http://free.net/", link("other/page")), (9, "http://free.net/other/page", None),
    (10, None, link("http://shop.net/x")), (11, "no scheme", None), (None, "http://x.com/de/", None), (13, "http://xcom/de/", None),
    (13, "http://xcom/de/", None), (14, "http://", None), (15, "http://org", "<link rel='canonical' href='mailto:a@b'>"),
    (16, "http://big.net/p", "x" * 300_000 + "<link rel=\"nofollow canonical\" href=\"http://hidden.com/de/q\">" + "<link " * 10_000),
    (17, "http://loop.net/a", link("http://loop.net/a")), (18, "HTTP://U.EXAMPLE.ORG/es/k?x#y", None)]
VERDICTS = [
    (1, "a.example.org", "/en/12", "example.org/en/1", "block"), (2, "shop.net", "/x", None, "allow"),
    (3, "shop.net", "/x", None, "block"), (4, "shop.net", "/y", None, "block"), (5, "shop.net", "/y", None, "allow"),
    (6, "b.org", "/z", "org/", "allow"), (7, "example.org", "/es", "org/", "allow"), (8, "free.net", "/", None, "allow"),
    (9, "free.net", "/other/page", None, "allow"), (10, "", "", None, "allow"), (11, "", "", None, "allow"),
    (None, "x.com", "/de/", "com/de/", "block"), (13, "xcom", "/de/", None, "allow"), (13, "xcom", "/de/", None, "allow"),
    (14, "", "", None, "allow"), (15, "org", "", None, "allow"), (16, "big.net", "/p", None, "block"),
    (17, "loop.net", "/a", None, "allow"), (18, "u.example.org", "/es/k", "example.org/es/", "block")]


def _key(r):
    return tuple((x is not None, x) for x in r)


def test_urls(spark):
    pages = spark.createDataFrame([(*r, *"abcdef") for r in PAGES], f"page_id long, url string, html string, {CLASH}")
    want = sorted(VERDICTS, key=_key)
    assert sorted(map(tuple, url_filter.judge_urls(pages).collect()), key=_key) == want
    table = spark.createDataFrame(url_filter.RULES, "action string, rule string")
    assert sorted(map(tuple, url_filter.judge_urls(pages, table).collect()), key=_key) == want
    assert url_filter.judge_urls(pages.where("false")).count() == 0
    assert url_filter.judge_urls(pages.drop("html").selectExpr("*", "cast(null as string) html")).where("page_id = 3").first()["verdict"] == "allow"


def test_observed_redirects_reach_over_long_chains(spark):
    chain = [(f"http://n{i}.net/a", f"http://n{i + 1}.net/a") for i in range(25)] + [("http://n25.net/a", "http://k.com/de/")]
    chain += [(None, "http://n1.net/a"), ("http://lone.net/", None), ("http://lone.net/", "no url")]
    pages = spark.createDataFrame([(i, f"http://n{i}.net/a", None) for i in range(27)] + [(99, "http://lone.net/", None)],
                                  "page_id long, url string, html string")
    got = dict(url_filter.judge_urls(pages, redirects=spark.createDataFrame(chain, "src string, dst string")).select(
        "page_id", "verdict").collect())
    assert got == {i: "block" if i <= 25 else "allow" for i in [*range(27), 99]}


def test_url_rules_as_a_table_equal_the_list(spark):
    rng = random.Random(5)
    hosts = ["a.b.c", "b.c", "c", "x.b.c", "xb.c", "a.c"]
    rules = list({(rng.choice(["allow", "block"]), rng.choice(hosts) + rng.choice(["", "/", "/p", "/pq/", "/pq/r"])) for _ in range(14)})
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/p', '/pq', '/pq/', '/pq/rs', '/q'])}", None) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    a, b = (url_filter.judge_urls(pages, r).toPandas().sort_values("page_id", ignore_index=True)
            for r in (rules, spark.createDataFrame(rules, "action string, rule string")))
    assert a.equals(b) and a["rule"].notna().any()


def brute_negatives(rows, every, n_pos, n_neg, low, high):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = (label, [math.floor(256 * x) for x in v])
        best[i] = min(best.get(i, one), one)
    out = []
    for a, (la, va) in best.items():
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, (label, v) in best.items() if i != a)
        for p, i in [(-s, i) for s, i, label in scores if label == la][:n_pos]:
            fit = [(-s, j) for s, j, label in scores if label != la and low * p <= 100 * -s <= high * p]
            out += [(a, i, r + 1, j, p, s) for r, (s, j) in enumerate(fit[:n_neg])]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [hard_negatives.BLOCK_BYTES, 4000])
def test_hard_negatives(spark, block_bytes):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in np.float32(rng.integers(-2, 6, 6) / 4)], int(rng.integers(0, 3))) for i in rng.permutation(np.arange(-20, 260))]
    rows += [(300, None, 1), (301, [1.0] * 6, None), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1), (304, [1.0, None, 1.0], 1),
             (None, [1.0] * 6, 1), (305, [], 1), (306, [1.0, 1.0], 2), (10, [1.0] * 6, 0), (10, [1.0] * 6, 0), (20, [1.0] * 6, 9)]
    rows += [(i, [1.0] * 6, i % 2) for i in range(400, 440)]  # ties
    table = spark.createDataFrame([(*r, 1, 2, "s") for r in rows],
                                  "vec_id long, embedding array<float>, label int, score long, slot int, anchor_id string")
    kw = dict(anchor_every=10, n_positives=4, n_negatives=3, low=50, high=95)
    got = hard_negatives.mine_hard_negatives(table, block_bytes=block_bytes, **kw)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10, 4, 3, 50, 95)
    if block_bytes > 4000:
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert hard_negatives.mine_hard_negatives(table.where("false"), **kw).dtypes == got.dtypes
        assert hard_negatives.mine_hard_negatives(table.where("vec_id = 305"), **kw).count() == 0


def test_slot_bests_equal_a_whole_sort():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-9, 9, (7, 5)), rng.integers(-9, 9, (400, 5))
    high, low = np.array([[60, 20, -10]] * 7), np.array([[21, -5, -200]] * 7)
    best = hard_negatives.SlotBests(low, high, 3)
    ids = rng.permutation(400)
    for i in range(0, 400, 37):
        best.add(0, hard_negatives._products(a, b[i:i + 37]), ids[i:i + 37], np.ones((7, len(ids[i:i + 37])), bool))
    got = sorted(zip(best.at.tolist(), (-best.score).tolist(), best.ids.tolist()))
    s = a @ b.T
    want = sorted((i * 3 + j, -x, y) for i in range(7) for j in range(3)
                  for x, y in sorted(((x, y) for x, y in zip(s[i].tolist(), ids.tolist()) if low[i, j] <= x <= high[i, j]), key=lambda t: (-t[0], t[1]))[:3])
    assert got == want


def test_products_are_exact_beyond_floating_point():
    a = np.array([[(1 << 40) + 1, 3]])
    assert hard_negatives._products(a, np.array([[(1 << 20) + 1, 5]])).tolist() == [[((1 << 40) + 1) * ((1 << 20) + 1) + 15]]
    assert hard_negatives._products(a, np.array([[1 << 60, 5]])).tolist() == [[(1 << 63) - 1]]
    assert hard_negatives._products(a[:, :0], np.array([[1]])).tolist() == [[0]]


def brute_collocations(rows, support, top, max_words=4, absorbed=80):
    f = {}
    for text, lang in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            for k in range(1, max_words + 1):
                f.setdefault(lang or "und", Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n, found = sum(x for p, x in c.items() if len(p) == 1), []
        cand = {p: x for p, x in c.items() if len(p) > 1 and x >= support}
        around = Counter()
        for p, x in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i:i + k]] = max(around[p[i:i + k]], x)
        for p, a in cand.items():
            if 100 * around[p] >= absorbed * a:
                continue
            s, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("shard_bytes, support, top", [(1 << 20, 5, 2000), (2000, 5, 40), (150, 3, 25)])
def test_collocations(spark, shard_bytes, support, top):
    rng = random.Random(4)
    words = ["of", "The", "new", "york", "Über", "a", "été", "日本", "x y", "rare%d"]
    rows = []
    for i in range(160):
        w = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        w = [x % rng.randint(0, 999) if "%" in x else x for x in w]
        rows.append((rng.choice([" ", "\t", "  "]).join(w) + rng.choice(["", ".", " New york, new York!\nof the a"]), rng.choice(["en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", "en"), ("...", "fr"), (" ", None), ("of the new york " * 2000, "de")] + [("same text of the new york", "en")] * 40
    docs = spark.createDataFrame([(i, *r, 1, "p", 3) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, phrase string, shard long").repartition(5)
    got = collocations.mine_collocations(docs, support=support, top=top, shard_bytes=shard_bytes, bucket_bytes=shard_bytes // 2)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, support, top)
    if shard_bytes > 2000:
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert collocations.mine_collocations(docs.where("false")).count() == 0


def test_bitmap_has_every_hash(spark):
    h = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63 - 1, 500).tolist() + [0, -1, collocations.BITMAP_BITS - 1, collocations.BITMAP_BITS, 32767, 32768]
    bitmap = collocations._bitmap(spark.createDataFrame([(x,) for x in h], "h long"))
    assert bitmap.has(np.array(h, np.int64).view(np.uint64)).all()
    assert int(np.unpackbits(bitmap.bits).sum()) == len({x & (collocations.BITMAP_BITS - 1) for x in h})


@pytest.mark.parametrize("name", ["op11_url_filter", "op12_hard_negatives", "op13_collocations"])
def test_query_equals_its_oracle(spark, name):
    from tests.oracle_check import compare, duck
    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES[name](spark, sf)
    cur = duck(sf).execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert df.columns == names
    assert compare([r.asDict() for r in df.collect()], [dict(zip(names, r)) for r in cur.fetchall()]) is None
