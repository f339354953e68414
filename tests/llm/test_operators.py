"""Training-data operators against brute force, round trips and held-out
accuracy, and on awkward rows: nulls, empty and long texts, repeated rows,
empty tables, extra columns whose names clash with internal ones."""

import random
from collections import Counter

import numpy as np
import pytest

from quarry.llm import (bpe, decontaminate, exact_dedup, hpylm, langid, licences, line_dedup, queries, simhash,
                        suffix_dedup, toxicity)
from quarry.llm.components import connected_components

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} item{i % 1009}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from home today", "en", "a", 1),
    (2, "the QUICK brown fox jumps over the lazy dog and runs far away from home today", "en", "a", 2),
    (3, None, None, None, None), (4, "", "en", "b", 0), (5, "  \t\n ", "en", "b", 0), (6, "123 456", None, "b", 7),
    (7, "Ärger über Öl\nand a line that stands in two texts, more or less the same", "de", "c", 9),
    (8, "and a line that stands in two texts, more or less the same\nmore", "en", "c", 9),
    (9, LONG, "en", "c", 9), (10, "before " + PASSAGE + " after", "en", "d", 1), (11, "other " + PASSAGE + " words", "en", "d", 1),
    (11, "other " + PASSAGE + " words", "en", "d", 1), (12, "<|endoftext|> it's ΑΣ 'll aaaa 42", "en", "d", 1),
    (None, "a text without an id", "en", "d", 1), (13, LONG + " end", "en", "c", 9)]


@pytest.fixture(scope="module")
def docs(spark):
    queries.ship_package(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long, n int, rk string, gid long, hits int"
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in ROWS], schema)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, PASSAGE), (2, "lazy dog"), (3, None), (None, "fox"), (4, "..."), (2, "lazy dog"), (10, "Aa bb Ärger über")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_exact_groups(docs, none):
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    for r in got:
        own = next(ids for ids in groups.values() if r["doc_id"] in ids)
        ids = [i for i in own if i is not None]
        assert r["group_size"] == len(own) and r["keep_id"] == (max(ids) if ids else None)
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
    assert exact_dedup.exact_groups(none).count() == 0
    assert set(exact_dedup.drop_copies(docs).columns) == set(docs.columns)


def test_decontamination(docs, none, bench):
    got = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, bench).collect()}
    assert got[1]["n_hit"] == 2 and got[1]["items"] == ["2"]
    assert got[10]["n_hit"] == 60 and got[10]["items"] == ["1"]
    text = ROWS[9][1]
    assert [text[a:b] for a, b in got[10]["spans"]] == [PASSAGE]
    assert got[3]["n_words"] == 0 and got[5]["n_words"] == 0 and got[7]["n_hit"] == 0
    # The same result from an automaton cut into many blocks.
    again = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, bench, max_block_bytes=200).collect()}
    assert {k: (r["n_hit"], r["items"]) for k, r in got.items()} == {k: (r["n_hit"], r["items"]) for k, r in again.items()}
    assert decontaminate.find_contamination(docs, bench.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(none, bench).count() == 0
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.where("doc_id in (1, 2, 10, 11)").count() == 0


def _components(n, near):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in near:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_simhash(spark, docs, none):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = simhash.near_groups(table).toPandas().sort_values("doc_id")
    text = dict(table.select("doc_id", "text").collect())
    import xxhash
    fp = []
    for i, h in zip(got["doc_id"], got["fingerprint"]):
        w = text[i].encode().lower().split()
        hs = [xxhash.xxh64_intdigest(b" ".join(w[a:a + 3]), 42) for a in range(max(1, len(w) - 2))]
        fp.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hs) > len(hs)))
        assert f"{fp[-1]:016x}" == h
    near = [(a, b) for a in range(len(fp)) for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= 2]
    ids = got["doc_id"].tolist()
    assert got["component_id"].tolist() == [ids[r] for r in _components(len(ids), near)]
    odd = simhash.near_groups(docs).collect()
    assert len(odd) == len(ROWS) and {r["component_id"] for r in odd if r["doc_id"] in (3, 4, 5)} == {3}
    assert simhash.near_groups(none).count() == 0


def test_simhash_links_every_near_pair(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2 ** 63, 40)]
    codes = sorted({(b ^ (1 << int(i)) ^ (1 << int(j))) for b in base for i, j in rng.integers(0, 63, (12, 2))} | set(base))
    for most in (1, 2, 3):
        links = simhash.near_links(spark.createDataFrame([(c,) for c in codes], "fp long"), most).collect()
        assert all((r["src"] ^ r["dst"]).bit_count() <= most for r in links)
        at = {c: i for i, c in enumerate(codes)}
        near = [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= most]
        assert _components(len(codes), [(at[r["src"]], at[r["dst"]]) for r in links]) == _components(len(codes), near)


def test_simhash_segments_and_crowded_values(spark):
    """Any number of segments, and values that more fingerprints share than an
    entry may hold, give the components of the brute force."""
    rng = np.random.default_rng(5)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    codes = {int(x) for x in rng.integers(0, 1 << 64, 30, np.uint64)}
    for c in list(codes)[:8]:  # fingerprints around these share whole segments
        codes |= {c ^ sum(1 << int(b) for b in rng.integers(0, 64, k)) for k in (1, 1, 2, 2, 3, 4)}
    crowd = next(iter(codes))
    codes |= {crowd ^ (int(x) << 40) for x in rng.integers(0, 1 << 10, 60)}
    codes = sorted(codes)
    table = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    at = {signed(c): i for i, c in enumerate(codes)}
    for distance, segments, most in ((2, 2, 64), (2, 2, 5), (2, 3, 0), (2, 4, 8), (3, 2, 4), (4, 4, 64), (1, 1, 64)):
        near = [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= distance]
        links = [(at[r["src"]], at[r["dst"]]) for r in simhash.near_links(table, distance, segments, most).collect()]
        assert {(max(x), min(x)) for x in links} <= set(near)
        assert _components(len(codes), links) == _components(len(codes), near), (distance, segments, most)


def test_simhash_joins_broadcast_nothing(spark, monkeypatch):
    plans, was = [], simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), was(df))[1])
    codes = spark.range(500).selectExpr("xxhash64(id) as fp")
    simhash.near_links(codes).count()
    assert plans and not [p for p in plans if "BroadcastExchange" in p]


def test_simhash_keeps_one_row_of_each_group(spark, docs, none):
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and simhash.drop_near_copies(none).count() == 0
    groups = {r["component_id"] for r in simhash.near_groups(docs).collect()}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, groups))
    far = "an entirely different text of its own " * 3
    rows = [(1, "one text that is here three times", 1), (None, "one text that is here three times", 2),
            (None, far, 3), (None, far, 4), (None, "and a third one " * 4, 5), (2, "one text that is here three times", 6)]
    small = spark.createDataFrame(rows, "doc_id long, text string, stay_id int")
    assert sorted(r["stay_id"] for r in simhash.drop_near_copies(small).collect()) == [1, 3, 5]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (6, 6), (None, 3), (20, 5), (2, 1)]
    got = dict(connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 20: 1, 7: 7, 8: 7, 9: 7}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer
    path = queries._tokenizer()
    tok, codec = Tokenizer.from_file(path), bpe.Codec(bpe.load_spec(path))
    texts = [t or "" for _, t, *_ in ROWS] + ["ᾈ ǅ İx", "é  é", "aaaaaaa bbb", "<|startoftext|>x<|endoftext|>"]
    for t in texts:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == ids and codec.decode(ids) == tok.decode(ids, skip_special_tokens=False)
    coded = bpe.encode_documents(docs, path)
    by = {r["doc_id"]: r for r in coded.collect()}
    assert by[3]["n_tokens"] == 0 and by[12]["token_ids"] == tok.encode(ROWS[12][1], add_special_tokens=False).ids
    back = {r["doc_id"]: r["decoded"] for r in bpe.decode_documents(coded, path).collect()}
    assert back[1] == tok.decode(by[1]["token_ids"], skip_special_tokens=False)
    assert bpe.encode_documents(none, path).count() == 0


def test_line_dedup(spark, docs, none):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in line_dedup.line_report(table).collect()}
    occ = [(i, k, x.strip(" ").lower()) for i, t in sorted(table.collect()) for k, x in enumerate(t.split("\n")) if x.strip(" ")]
    names = list(dict.fromkeys(x for *_, x in occ))
    k = line_dedup.SHINGLE_CHARS
    sets = [{x[a:a + k] for a in range(max(1, len(x) - k + 1))} for x in names]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a]) * 1.3 > len(sets[b]) > len(sets[a]) / 1.3
            and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    part, seen, drops = dict(zip(names, _components(len(names), near))), set(), Counter()
    for i, _, x in occ:
        drops[i] += part[x] in seen
        seen.add(part[x])
    assert {i: r["n_dropped"] for i, r in got.items()} == {i: drops[i] for i in got}
    odd = line_dedup.drop_duplicate_lines(docs)
    by = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert by[8] == "more" and by[7] == ROWS[6][1] and by[3] is None and by[4] == "" and by[2] == ""
    assert odd.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert line_dedup.drop_duplicate_lines(none).count() == 0


def test_line_dedup_of_a_bucket_without_one_original(spark):
    """Variants of a line, near to few others each, are compared over several
    rounds; the components are those of all near pairs."""
    rng, rows = random.Random(11), []
    base = [rng.choice(["thon", "ring", "sel", "oum", "ba", "tio"]) + str(rng.randrange(100)) for _ in range(60)]
    for _ in range(250):
        words = list(base)
        for at in rng.sample(range(60), rng.randrange(1, 9)):
            words[at] = f"w{rng.randrange(10**6)}"
        rows.append(" ".join(words[:rng.choice([60, 60, 60, 30])]))
    k = line_dedup.SHINGLE_CHARS
    sets = [{x[a:a + k] for a in range(max(1, len(x) - k + 1))} for x in rows]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    part = _components(len(rows), near)
    want = {frozenset(i for i in range(len(rows)) if part[i] == p) for p in set(part) if part.count(p) > 1}
    named = line_dedup.near_lines(spark.createDataFrame(list(enumerate(rows)), "id long, norm string"))
    groups = {}
    for r in named.collect():
        groups.setdefault(r["component"], set()).add(r["node"])
    assert {frozenset(g) for g in groups.values()} == want


def test_line_dedup_columns_of_clashing_names(spark):
    names = ["_gone", "gone", "gone_lines", "gone_kept", "n_lines", "rk", "line_no"]
    docs = spark.createDataFrame([(1, "a line\nother", *names), (2, "A line \nthird", *names)],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = line_dedup.drop_duplicate_lines(docs)
    assert got.columns == [*(c for c in docs.columns if c != "n_lines"), "n_lines", "n_dropped"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[2]["text"] == "third" and rows[1]["text"] == "a line\nother" and rows[2]["gone_lines"] == "gone_lines"
    assert (rows[2]["n_lines"], rows[2]["n_dropped"]) == (2, 1)


def test_line_sketches_drop_no_near_pair(spark):
    """Every pair of lines around the limit, very short and repetitive ones too."""
    rng, rows = random.Random(5), []
    for n in (1, 9, 12, 60, 400, 3000):
        base = "".join(rng.choice("abcde é") for _ in range(n))
        for k in range(12):
            t = list(base)
            for _ in range(k * n // 200 + k % 2):
                t[rng.randrange(n)] = rng.choice("xyz")
            rows.append("".join(t))
    rows += ["ab" * 200, "ab" * 300, "a" * 50]
    lines = spark.createDataFrame(list(enumerate(rows)), "id long, norm string")
    bits = line_dedup.sketches(lines.selectExpr("id", "encode(norm, 'UTF-16BE') as units"))
    k = line_dedup.SHINGLE_CHARS
    sets = [{x[a:a + k] for a in range(max(1, len(x) - k + 1))} for x in rows]
    every = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows))]
    want = {(a, b) for a, b in every if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    left = line_dedup.possible(spark.createDataFrame(every, "a long, b long"), bits, 0.8)
    kept = {tuple(r) for r in left.collect()}
    assert want <= kept and len(kept) < len(every)
    assert {tuple(r) for r in line_dedup.verified(left, lines, 0.8, k).collect()} == want


def test_line_bucket_join_refuses_pairs_below_the_limit(spark):
    """Variants just below the limit pass the bitmaps of long lines; the 16-bit
    hashes keep every near pair and hardly another."""
    rng, rows = random.Random(3), []
    base = [rng.choice(["thon", "ring", "sel", "oum", "ba", "tio"]) + str(rng.randrange(100)) for _ in range(90)]
    for k in range(40):
        words = list(base)
        for at in rng.sample(range(90), 4 + k % 4):
            words[at] = f"w{rng.randrange(10**6)}"
        rows.append(" ".join(words))
    rows += ["ab" * 200, "ab" * 300, "abc", "abc d", "abc"]
    lines = spark.createDataFrame(list(enumerate(rows)), "id long, norm string")
    k = line_dedup.SHINGLE_CHARS
    sets = [{x[a:a + k] for a in range(max(1, len(x) - k + 1))} for x in rows]
    every = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows))]
    want = {(a, b) for a, b in every if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    bits = line_dedup.sketches(lines.selectExpr("id", "encode(norm, 'UTF-16BE') as units"))
    passed = {tuple(r) for r in line_dedup.possible(spark.createDataFrame(every, "a long, b long"), bits, 0.8).collect()}
    full = bits.join(line_dedup.short_sets(lines), "id")
    sides = [line_dedup._side(full, x, line_dedup.SKETCH_WORDS) for x in "ab"]
    left = sides[0].join(sides[1], line_dedup._near_enough(0.8)).where("a < b")
    kept = {(r["a"], r["b"]) for r in left.select("a", "b").collect()}
    assert want <= kept <= passed and len(kept) - len(want) < (len(passed) - len(want)) / 4


def test_line_buckets_of_shared_parts_are_those_of_all_bands(spark):
    from itertools import combinations
    rng = random.Random(8)
    minima = [[rng.randrange(2) for _ in range(6)] for _ in range(40)] + [[i * 6 + j + 9 for j in range(6)] for i in range(40)]
    sig = spark.createDataFrame([(i, *m) for i, m in enumerate(minima)], "id long, " + ", ".join(f"m{i} int" for i in range(6)))
    for rows in (5, 4):
        got = {}
        for r in line_dedup.buckets(sig, 0, 6, rows).collect():
            got.setdefault(r["bucket"], []).append((r["id"], r["lead"], r["n"]))
        want = {}
        for some in combinations(range(6), rows):
            for i, m in enumerate(minima):
                want.setdefault((some, *[m[x] for x in some]), []).append(i)
        want = [sorted((i, min(g), len(g)) for i in g) for g in want.values() if len(g) > 1]
        assert sorted(map(sorted, got.values())) == sorted(want)


def test_suffix_dedup(docs, none):
    got = {r["doc_id"]: r for r in suffix_dedup.repeated_passages(docs).collect()}
    assert got[10]["passages"] == [[1, 61]] and got[10]["other_ids"] == [11] and got[11]["passages"] == [[1, 61]]
    assert got[9]["n_repeated"] == 60_000 and got[13]["n_repeated"] >= 60_000
    assert set(got) == {9, 10, 11, 13}
    assert suffix_dedup.repeated_passages(none).count() == 0


def _passages_case(seed):
    """Frequent sentences inside rare passages, passages of many lengths, repeats within a text."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(100_000)}"
    frequent = [[word() for _ in range(12)] for _ in range(3)]
    rare = [[word() for _ in range(rng.randrange(15, 60))] + rng.choice(frequent) + [word() for _ in range(rng.randrange(15, 150))] for _ in range(12)]
    texts = []
    for i in range(90):
        parts = [[word() for _ in range(rng.randrange(30))]]
        for _ in range(rng.randrange(1, 4)):
            parts += [rng.choice(rare if rng.random() < 0.4 else frequent), [word() for _ in range(rng.randrange(30))]]
        texts.append(" ".join(x for p in parts for x in p))
    return list(enumerate(texts))


def test_suffix_dedup_against_brute_force(spark):
    rows, rng = _passages_case(1), random.Random(4)
    word = lambda: f"v{rng.randrange(10 ** 6)}"
    often = [[word() for _ in range(12)] for _ in range(20)]
    for k in range(100):  # rare passages that end in a frequent sentence, each in two texts; the sentence stands in others
        p = [word() for _ in range(40)] + often[k % 20]
        rows += [(1000 + k * 10 + j, " ".join([word(), *x, *(word() for _ in range(60))])) for j, x in enumerate((p, often[k % 20], p))]
    places = {}
    for i, t in rows:
        w = t.split()
        for s in range(len(w) - 49):
            places.setdefault(tuple(w[s:s + 50]), []).append((i, s))
    want = {}
    for at in places.values():
        for i, s in at if len(at) > 1 else []:
            want.setdefault(i, set()).update(range(s, s + 50))
    got = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r["doc_id"]: {x for a, b in r["passages"] for x in range(a, b)} for r in got} == want
    assert {r["doc_id"]: r["n_repeated"] for r in got} == {i: len(x) for i, x in want.items()}


def test_suffix_dedup_leaves_one_copy_of_each_word(spark):
    rows = [(i, t) for seed in (2, 3) for i, t in ((100 * seed + i, t) for i, t in _passages_case(seed))]
    rng = random.Random(9)
    for k in range(0, 40, 2):  # two copies of a long passage, with other words around them
        p = [f"p{rng.randrange(10 ** 6)}" for _ in range(200)]
        rows += [(1000 + k + j, " ".join([f"a{rng.randrange(10 ** 6)}", *p, f"b{rng.randrange(10 ** 6)}"])) for j in (0, 1)]
    got = {r["doc_id"]: r["removable"] for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = {i: {x for a, b in r for x in range(a, b)} for i, r in got.items()}
    assert all(sum(len(gone.get(1000 + k + j, ())) for j in (0, 1)) == 200 for k in range(0, 40, 2))
    kept = {i: [x in gone.get(i, ()) for x in range(len(t.split()))] for i, t in rows}
    copies = {}
    for i, t in rows:
        w = t.split()
        for s in range(len(w) - 49):
            copies.setdefault(tuple(w[s:s + 50]), []).append((i, s))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for at in copies.values():  # words at the same place of equal runs are copies of each other
        for i, s in at[1:]:
            for o in range(50):
                a, b = find((at[0][0], at[0][1] + o)), find((i, s + o))
                root[max(a, b)] = min(a, b)
    left = {find((i, x)) for i, g in kept.items() for x, removed in enumerate(g) if not removed}
    assert all(find((i, x)) in left for i, g in gone.items() for x in g) and any(gone.values())


def test_minimisers_are_dense_and_agree():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2 ** 63, 5000).astype(np.uint64)
    pos, g = suffix_dedup.minimisers(words, 50, 8)
    assert np.diff(np.concatenate([[-1], pos])).max() <= 43
    part = suffix_dedup.minimisers(words[1000:1050], 50, 8)
    assert {(p + 1000, x) for p, x in zip(*part)} <= set(zip(pos, g)) and len(part[0])


def test_run_hashes_come_from_their_halves():
    class Counted(np.ndarray):
        products = 0

        def __array_ufunc__(self, ufunc, method, *inputs, out=None, **kw):
            Counted.products += ufunc is np.multiply
            plain = [x.view(np.ndarray) if isinstance(x, Counted) else x for x in inputs]
            if out:
                kw["out"] = tuple(x.view(np.ndarray) for x in out)
            return getattr(ufunc, method)(*plain, **kw).view(Counted)

    h = np.random.default_rng(3).integers(0, 2 ** 63, 300).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for k in (1, 2, 3, 8, 13, 50, 300):
        Counted.products = 0
        got = suffix_dedup.grams(h.view(Counted), k)
        assert Counted.products <= 2 * k.bit_length()  # not a product a word
        for at in (0, len(h) - k):
            g = 0
            for x in h[at:at + k].tolist():
                g = (g * 0x9E3779B97F4A7C15 + x) % 2 ** 64
            assert got[at] == (g ^ g >> 29) * 0xBF58476D1CE4E5B9 % 2 ** 64


def test_language(spark, docs, none):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(table, fit_rows=400, landmarks=60).join(table.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97 and got["score"].between(0, 1).all()
    odd = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(odd) == len({r[0] for r in ROWS}) and all(odd[i]["lang_pred"] == "und" for i in (3, 4, 5, 6))
    assert langid.identify(none).count() == 0 and langid.predict(docs, None).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark, docs, none):
    table, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_report(table, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all() and got["score"].between(0, 1).all()
    assert got.loc[got["toxic"] == 1, "score"].mean() > got.loc[got["toxic"] == 0, "score"].mean() + 0.3
    mixed = labels.limit(0).unionByName(spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 0), (1, 0, 1)], "doc_id long, quality int, toxic int"))
    assert toxicity.toxicity_report(docs, mixed).count() == len(ROWS)
    assert toxicity.toxicity_report(none, labels).count() == 0 and toxicity.toxicity_report(docs, labels.limit(0)).count() == len(ROWS)
    assert toxicity.drop_toxic(docs, mixed).columns == docs.columns


def test_maximal_segments_against_brute_force():
    rng = np.random.default_rng(2)

    def maximal(s):  # the definition: recursively the best segment, then left and right of it
        best = max(((sum(s[a:b]), a, b) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0), key=lambda x: (x[0], -(x[2] - x[1])))
        if best[0] <= 0:
            return []
        _, a, b = best
        return [*maximal(s[:a]), (a, b), *[(x + b, y + b) for x, y in maximal(s[b:])]]
    for _ in range(200):
        s = rng.integers(-9, 9, 12).astype(float) + rng.random(12) / 10
        s[s <= 0] = -3.0
        at = [i for i in range(12) if s[i] > 0]
        assert [(a, b) for a, b, _ in toxicity.segments(at, [s[i] for i in at], -3.0)] == maximal(list(s))


def test_language_model(spark, docs, none):
    got = {(r["doc_id"]): r for r in hpylm.score_documents(docs, block_bytes=100_000).collect()}
    import zlib
    train = Counter()
    for i, t, *_ in ROWS:
        if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1:
            train.update([*(t or "").encode().lower().split(), "end"])
    n, v = sum(train.values()), len(train)
    for i, t, *_ in ROWS:
        words = [*(t or "").encode().lower().split(), "end"]
        assert got[i]["n_tokens"] == len(words) and got[i]["train_tokens"] == n
        assert got[i]["n_known"] == sum(w in train for w in words)
        assert got[i]["base_score"] == pytest.approx(sum(np.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        assert np.isfinite(got[i]["score"]) and got[i]["score"] < 0
    assert hpylm.score_documents(none).count() == 0
    # Ids beyond 2^53 beside a null id come back as they are.
    ids = [2 ** 60 + 1, 2 ** 60 + 3, None]
    far = hpylm.score_documents(spark.createDataFrame([(i, "a few words") for i in ids], "doc_id long, text string"))
    assert {r["doc_id"]: r["held_out"] for r in far.collect()} == {
        i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i in ids}


def test_language_model_seats_every_pair(spark):
    """A rare word has its own context restaurant, and each word its own dish there."""
    import zlib
    train = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(train[k], f"left{k % 500} right{k % 500}") for k in range(1500)]
    rows += [(held[0], "left7 right7"), (held[1], "left7 right8")]
    got = {r["doc_id"]: r for r in hpylm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=5000).collect()}
    same, other = got[held[0]], got[held[1]]
    assert same["base_score"] == pytest.approx(other["base_score"])
    assert same["score"] > other["score"] + 0.9
    texts = [b"a b a b c", b"", b"b a"]
    bucket, c, w, place, size = hpylm.block_pairs(texts, np.array([], np.int64), 3)
    assert size.tolist() == [6, 1, 3] and (np.diff(bucket) >= 0).all()
    words = [x for t in texts for x in [hpylm.END_HASH, *map(hpylm._hash, t.split()), hpylm.END_HASH]]
    pairs = [p for t in texts for p in zip(*(lambda x: (x[:-1], x[1:]))([hpylm.END_HASH, *map(hpylm._hash, t.split()), hpylm.END_HASH]))]
    assert list(zip(c[place].tolist(), w[place].tolist())) == pairs and set(c.tolist()) <= set(words)


def test_seating_matches_the_chinese_restaurant():
    rng = np.random.default_rng(4)
    for a, c in ((0.5, 12), (3.0, 60), (20.0, 400)):
        slow = []
        for _ in range(3000):
            t, u = 1, rng.random(c)
            for j in range(1, c):
                t += u[j] < a / (a + j - 0.5 * t)
            slow.append(t)
        fast = hpylm.seat(np.full(3000, c), np.full(3000, a), rng, 0.5)
        assert fast.mean() == pytest.approx(np.mean(slow), rel=0.05)


def test_licences(docs, none, spark):
    model = licences.train([b"a plain paragraph about nothing in particular, with some words in it"] * 3)
    rows = [(1, "Intro words here\nLicensed under the Apache License, Version 2.0.\nmore"), (2, "He was licensed to drive a car in the city"), (3, None),
            (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and\nassociated documentation files (the \"Software\"), to deal in the Software without restriction,\n"
                "including without limitation the rights to use, copy, modify, merge, publish, distribute,\nsublicense, and/or sell copies of the Software"), (5, "")]
    got = {r["doc_id"]: r for r in licences.scan_documents(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i]["licence"] for i in range(1, 6)] == ["Apache-2.0", None, None, "MIT", None]
    x = next(f for f in got[1]["found"] if f["confirmed"])
    assert rows[0][1][x["start"]:x["end"]] == "Licensed under the Apache License, Version 2.0."
    # A wrapped notice inside a block of 300 lines, between wide lines, and at a block's end.
    notice = licences.TEMPLATES["MIT"][2].split()
    wrapped = "\n".join(" ".join(notice[k:k + 7]) for k in range(0, len(notice), 7))
    filler = [f"some plain words {k} of a source file that say nothing at all" for k in range(300)]
    wide = " ".join(filler[:20])
    texts = ["\n".join([*filler[:140], wrapped, *filler[140:]]), f"{wide}\n{wrapped}\n{wide}", "\n".join([*filler, wrapped]),
             "\n".join(filler), "Ärger\n" * 50 + wrapped + "\n" + wide]
    got = {r["doc_id"]: r for r in licences.scan_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert [got[i]["licence"] for i in range(5)] == ["MIT", "MIT", "MIT", None, "MIT"]
    for i in (0, 1, 2, 4):
        x = max((f for f in got[i]["found"] if f["confirmed"]), key=lambda f: f["probability"])
        assert "copies of" in texts[i][x["start"]:x["end"]] or "free of" in texts[i][x["start"]:x["end"]]
    # Every run of half a window's words stands whole in some window of that size.
    grams = sorted(model.index)
    words = [w for k in range(200) for w in grams[k % 40][:2]]
    for size, _ in licences.window_sizes():
        spans = [(a, b) for a, b, _ in model.windows(words, [(size, 0)])]
        assert all(any(a <= k and k + size // 2 <= b for a, b in spans) for k in range(len(words) - size // 2 + 1))
    assert licences.licence_report(docs).count() == len(ROWS) and licences.licence_report(none).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as p
    assert [n for n, _ in p.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "bpe"]
    empty = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, empty, SF)
        assert out.columns == p.COLUMNS and out.count() == 0
    all_ = spark.read.parquet(f"{SF}/documents.parquet")
    got = p.run(spark, SF)
    assert 0 < got.count() < all_.count() and "token_ids" in got.columns


def test_bpe_codes_a_small_run_of_text_at_a_time(monkeypatch):
    """What a Python worker holds beside its cache is bounded by a megabyte of text, ids as numbers of four bytes."""
    import numpy as np
    import pyarrow as pa
    import public_tokenizers
    from types import SimpleNamespace as Named
    from quarry.llm import bpe
    seen = {}
    monkeypatch.setattr(bpe, "_rows", lambda *a: None)
    monkeypatch.setattr(bpe, "map_batches", lambda df, fn, schema, start, most=8 << 20: seen.update(start=start, most=most))
    docs = Named(sparkSession=Named(sparkContext=Named(broadcast=lambda v: Named(value=v))))
    bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    got = seen["start"]()({"doc_id": pa.array([1, 2]), "text": pa.array(["two words", None])})
    assert seen["most"] <= 1 << 20 and all(x.dtype == np.int32 for x in got["token_ids"])
    assert [len(x) for x in got["token_ids"]] == got["n_tokens"] and got["n_tokens"][1] == 0
