"""Hand-checked cases (FIXTURES.md §4) and invariants."""

import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_tokenize_and_bigram(spark):
    from quarry.functions.text import adjacent_pairs, tokenize
    df = spark.createDataFrame([("Don't stop the 'Quoted' WORLD",)], "t string")
    r = df.select(tokenize("t", remove_stopwords=True).alias("tok")).first()["tok"]
    assert r == ["stop", "world"]
    pairs = df.select(adjacent_pairs(tokenize("t", remove_stopwords=True)).alias("p")).first()["p"]
    assert pairs == ["stop world"]


def test_duplicates_nulls_equal(spark):
    from quarry.operators.profile import duplicates
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "c string")
    assert duplicates(df, {"c": ["c"]}).first()["duplicates"] == 2


def test_histogram_edges(spark):
    from quarry.operators.dist import histogram_edges
    df = spark.createDataFrame([(float(v),) for v in [0, 4, 5, 10, 11]], "v double")
    out = sorted(rows(histogram_edges(df, "v", [0, 5, 10]), "bin", "cnt"))
    assert out == [(0, 2), (1, 2)]


def test_right_closed_bins(spark):
    from quarry.operators.dist import cut_labels
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 5, 6, 30, 31]], "v double")
    labels = ["1", "2", "3", "4-5", "6-10", "10+"]
    got = [r[0] for r in df.select(cut_labels(F.col("v"), [0, 1, 2, 3, 5, 10, 30], labels)).collect()]
    assert got == [None, "1", "2", "4-5", "6-10", "10+", None]


def test_class_weights(spark):
    from quarry.operators.dist import class_weights
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    got = dict(rows(class_weights(df, "c"), "c", "weight"))
    assert got == {"a": pytest.approx(0.6667), "b": pytest.approx(2.0)}


def test_cramers_v_yates(spark):
    from quarry.operators.stats import cramers_v
    data = [("x", "p")] * 10 + [("y", "q")] * 10
    r = cramers_v(spark.createDataFrame(data, "a string, b string"), "a", "b").first()
    assert r["chi2"] == pytest.approx(16.2)
    assert r["cramers_v"] == pytest.approx(0.8941, abs=1e-4)


def test_corr_constant_is_zero(spark):
    from quarry.operators.stats import corr_matrix
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, k double")
    m = {(a, b): c for a, b, c in rows(corr_matrix(df, ["x", "k"]), "col_a", "col_b", "corr")}
    assert m[("x", "k")] == 0.0 and m[("x", "x")] == 1.0


def test_minmax_constant_is_zero(spark):
    from quarry.operators.features import minmax
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r[0] for r in minmax(df, ["x"]).select("x_mm").collect()] == [0.0, 0.0]


def test_target_encoding_formula(spark):
    from quarry.operators.ml import TargetEncoder
    train = spark.createDataFrame([("a", 100.0)] * 30 + [("b", 60.0)] * 120, "c string, y double")
    # prior = (30*100 + 120*60) / 150 = 68
    model = TargetEncoder(["c"], "y").fit(train)
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    got = [r[0] for r in model.transform(test).select("c_te").collect()]
    w = 1 / (1 + math.exp(-(30 - 20) / 10))
    assert got[0] == pytest.approx(68 * (1 - w) + 100 * w)
    assert got[1] == pytest.approx(68.0) and got[2] == pytest.approx(68.0)


def test_target_encoding_fixture_value():
    w = 1 / (1 + math.exp(-(30 - 20) / 10))
    assert round(80 * (1 - w) + 100 * w, 4) == 94.6212


def test_smooth_idf(spark):
    from quarry.operators import text as tx
    df = spark.createDataFrame([(1, ["t"]), (2, ["u"]), (3, ["v"])], "d int, toks array<string>")
    tf = tx.term_frequencies(df, "d", F.col("toks"))
    idf = {r["term"]: r["idf"] for r in tx.idf_table(tf, tx.doc_counts(df)).collect()}
    assert idf["t"] == pytest.approx(math.log(4 / 2) + 1, abs=1e-4)


def test_stratified_proportional_sizes(spark):
    from quarry.operators.sampling import sample_stratified_proportional
    data = [(i, "a") for i in range(50)] + [(100 + i, "b") for i in range(30)] + [(200, "c"), (201, "c")]
    df = spark.createDataFrame(data, "id int, cls string")
    got = dict(rows(sample_stratified_proportional(df, "cls", "id", 10).groupBy("cls").count(), "cls", "count"))
    assert got == {"a": 6, "b": 4, "c": 2}


def test_classification_metrics_fixture(spark):
    from quarry.operators import evaluate as ev
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 2)], "actual int, predicted int")
    m = ev.classification_metrics(df, "actual", "predicted").first()
    assert m["accuracy"] == 0.75 and m["macro_f1"] == pytest.approx(0.7778) and m["weighted_f1"] == 0.75
    assert ev.quadratic_kappa(df, "actual", "predicted").first()["qwk"] == pytest.approx(0.8)
    same = spark.createDataFrame([(0, 0), (1, 1), (2, 2)], "actual int, predicted int")
    assert ev.quadratic_kappa(same, "actual", "predicted").first()["qwk"] == 1.0


def test_feature_subsets_count(spark):
    from quarry.operators.rank import feature_subsets
    g = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    assert feature_subsets(g, "g", 2).count() == 6


def test_cosine_fixture(spark):
    from quarry.operators.similarity import cosine_pairs
    m = spark.createDataFrame([("p", [1.0, 0.0]), ("q", [1.0, 1.0])], "g string, vec array<double>")
    got = {(a, b): c for a, b, c in rows(cosine_pairs(m, m, "g", "g"), "group_a", "group_b", "cosine")}
    assert got[("p", "q")] == pytest.approx(0.7071)


def test_key_from_filename(spark):
    from quarry.functions.scalar import key_from_filename
    df = spark.createDataFrame([("a-b-1.jpg",)], "f string")
    assert df.select(key_from_filename("f")).first()[0] == "a-b"


def test_bbox_pct(spark):
    from quarry.functions.scalar import bbox_from_vertices, bbox_pct
    df = spark.createDataFrame([([{"x": 10, "y": 20}, {"x": 30, "y": 60}],)], "v array<struct<x:long,y:long>>")
    r = df.select(bbox_pct(bbox_from_vertices(F.col("v")), F.lit(100), F.lit(200)).alias("p")).first()["p"]
    assert (r["x_pct"], r["y_pct"], r["w_pct"], r["h_pct"]) == (10.0, 10.0, 20.0, 20.0)


def test_unknown_ids(spark):
    from quarry.operators.joins import lookup_unknown_id
    ann = spark.createDataFrame([(999, True), (1, True), (1, False)], "breed int, matched boolean")
    dim = spark.createDataFrame([(1, "Labrador")], "id int, name string")
    got = [r[0] for r in lookup_unknown_id(ann, dim, "breed", "id", "name", "nm", F.col("matched"))
           .select("nm").collect()]
    assert sorted(got) == sorted(["Unknown(999)", "Labrador", "Unknown"])


def test_exact_quantiles_match_numpy(spark):
    from quarry.operators.quantiles import exact_quantiles
    rng = np.random.RandomState(3)
    vals = np.concatenate([rng.exponential(5, 997), [0.0, 0.0, 250.0]])
    grp = ["hot"] * 900 + ["cold"] * 100
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(grp, vals)], "g string, v double")
    out = {r["g"]: r for r in exact_quantiles(df, "g", "v", {"q1": 0.25, "med": 0.5, "q3": 0.75}).collect()}
    for g in ("hot", "cold"):
        x = vals[np.array(grp) == g]
        assert out[g]["med"] == pytest.approx(np.median(x))
        assert out[g]["q1"] == pytest.approx(np.quantile(x, 0.25))
        assert out[g]["q3"] == pytest.approx(np.quantile(x, 0.75))


def test_partition_independence(spark):
    from quarry.operators.quantiles import exact_quantiles
    from quarry.operators.sampling import split_stratified
    df = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 3).alias("c"), (F.col("id") * 7 % 101).alias("v"))
    a = exact_quantiles(df.repartition(1), "c", "v", {"m": 0.5}).orderBy("c").collect()
    b = exact_quantiles(df.repartition(8), "c", "v", {"m": 0.5}).orderBy("c").collect()
    assert a == b
    s1 = split_stratified(df.repartition(1), "c", "id").orderBy("id").collect()
    s8 = split_stratified(df.repartition(8), "c", "id").orderBy("id").collect()
    assert s1 == s8


def test_empty_table(spark):
    from quarry.operators.dist import histogram_edges
    from quarry.operators.profile import column_profile
    empty = spark.createDataFrame([], "v double, s string")
    h = histogram_edges(empty, "v", [0, 1, 2])
    assert sorted(rows(h, "bin", "cnt")) == [(0, 0), (1, 0)]
    prof = {r["column"]: r for r in column_profile(empty).collect()}
    assert prof["v"]["missing"] == 0 and prof["v"]["missing_pct"] == 0.0


def test_f_distribution_tail():
    from quarry.operators.stats import f_sf_numpy
    # P(F(2, 10) > 4.1028) ≈ 0.05 (tabulated critical value)
    assert float(f_sf_numpy(4.1028, 2, 10)) == pytest.approx(0.05, abs=1e-4)
    # F(1, d) = t² : P(F(1, 20) > 4.3512) ≈ 0.05
    assert float(f_sf_numpy(4.3512, 1, 20)) == pytest.approx(0.05, abs=1e-4)


def test_hard_vote_ties_smallest(spark):
    from quarry.operators.evaluate import hard_vote
    df = spark.createDataFrame([("b", "a", "c"), ("b", "b", "a")], "m1 string, m2 string, m3 string")
    assert [r[0] for r in df.select(hard_vote(df, ["m1", "m2", "m3"])).collect()] == ["a", "b"]


def test_randomized_svd_matches_numpy(spark):
    from pyspark.ml.linalg import Vectors
    from quarry.operators.ml import TruncatedSVD
    rng = np.random.RandomState(0)
    low = rng.standard_normal((200, 3)) @ rng.standard_normal((3, 30))
    x = low + 0.01 * rng.standard_normal((200, 30))
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x], ["f"])
    m = TruncatedSVD(inputCol="f", outputCol="s", k=3, n_iter=2).fit(df)
    assert np.allclose(m.singular_values, np.linalg.svd(x, compute_uv=False)[:3], rtol=1e-3)


def _png(rgb):
    """An uncompressed-filter PNG, for the tests of the file source."""
    import struct
    import zlib
    h, w, _ = rgb.shape

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))
    raw = b"".join(b"\x00" + row.tobytes() for row in rgb.astype(np.uint8))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + \
        chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images_solid_colour_and_invalid(spark):
    from quarry.operators import images as im
    from quarry.sources.files import read_images
    d = tempfile.mkdtemp(prefix="quarry-img-test-")
    with open(os.path.join(d, "solid-1.png"), "wb") as fh:
        fh.write(_png(np.full((20, 30, 3), 120, dtype=np.uint8)))
    with open(os.path.join(d, "junk-1.png"), "wb") as fh:
        fh.write(b"\x00junk")
    imgs = read_images(spark, d, "*.png")
    assert imgs.count() == 1
    r = im.image_quality(imgs).first()
    assert r["contrast"] == 0.0 and r["sharpness"] == 0.0 and r["brightness"] == pytest.approx(120.0)


def test_bgr_order(spark):
    from quarry.operators import images as im
    from quarry.sources.files import read_images
    d = tempfile.mkdtemp(prefix="quarry-img-test-")
    rgb = np.zeros((4, 4, 3), dtype=np.uint8)
    rgb[:, :, 0] = 200  # red
    with open(os.path.join(d, "red-1.png"), "wb") as fh:
        fh.write(_png(rgb))
    r = read_images(spark, d, "*.png").first()
    arr = im.to_array(r["data"], r["height"], r["width"], r["channels"])
    assert arr[0, 0, 2] == 200 and arr[0, 0, 0] == 0


def test_image_table(spark):
    """Bitmaps in a table decode like the same bitmaps as files; bytes that are
    no image, cut bitmaps, empty and null content are listed but not read."""
    import struct
    from quarry.operators import images as im
    from quarry.plans.files_plan import vector_bitmap
    from quarry.sources import images as src
    from quarry.sources.files import read_images
    vecs = [(1, [float(i * i % 37) for i in range(64)]), (2, [1.0, -2.0, 0.5, 9.0, 3.0]), (3, [4.0]), (4, []), (5, None)]
    rows = spark.createDataFrame(vecs, "id int, v array<float>").select(
        F.concat(F.col("id").cast("string"), F.lit("-1.bmp")).alias("path"), vector_bitmap(F.col("v")).alias("content")).collect()
    content = dict(rows)
    top_down = b"BM" + struct.pack("<IIIIiiHHIIiiII", 54 + 16, 0, 54, 40, 3, -1, 1, 32, 0, 16, 0, 0, 0, 0) + bytes(range(12)) + b"...."
    more = [("cut-1.bmp", content["1-1.bmp"][:-1]), ("junk-1.bmp", b"junk"), ("none-1.bmp", None), ("empty-1.bmp", b""), ("bgra-1.bmp", top_down)]
    base = tempfile.mkdtemp(prefix="quarry-img-test-")
    files = os.path.join(base, "files")
    os.makedirs(files)
    for path, b in [*content.items(), *more[:2]]:
        if b is not None:
            with open(os.path.join(files, path), "wb") as fh:
                fh.write(b)
    table = os.path.join(base, "table")
    src.write_image_table(spark.createDataFrame([*content.items(), *more], "path string, content binary"), table)
    got = {r["stem"]: r for r in src.read_image_table(spark, table).collect()}
    want = {r["stem"]: r for r in read_images(spark, files, "*.bmp").collect()}
    assert set(got) == {"1-1", "2-1", "3-1", "bgra-1"} and {"1-1", "2-1", "3-1"} <= set(want)
    for k in ("1-1", "2-1", "3-1"):
        assert all(got[k][c] == want[k][c] for c in ("height", "width", "channels", "mode")) and bytes(got[k]["data"]) == bytes(want[k]["data"])
    assert (got["bgra-1"]["height"], got["bgra-1"]["width"], bytes(got["bgra-1"]["data"])) == (1, 3, bytes([0, 1, 2, 4, 5, 6, 8, 9, 10]))
    first = im.to_array(got["1-1"]["data"], 8, 8, 3)[0]
    v = np.array(vecs[0][1], np.float32)
    assert first[:, 0].tolist() == [int(x) for x in np.floor((v[:8] - v.min()) / (v.max() - v.min()) * 255)]
    assert src.read_image_table(spark, table, pixels=False).where("data is null").count() == 4
    listed = {r["stem"]: r["length"] for r in src.table_listing(spark, table).collect()}
    assert len(listed) == 10 and listed["1-1"] == 54 + 192 and listed["none-1"] == 0 and listed["5-1"] == 0
    plan = src.table_listing(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert im.image_dominant_colors(src.read_image_table(spark, table), ("stem",)).count() == 12


def test_stratified_parts_of_skewed_classes(spark):
    """A hot class, a class of one row, rows without a class and repeated ids;
    wide rows meet no shuffle on their class."""
    from quarry.operators.sampling import sample_stratified_proportional, split_stratified
    df = spark.range(0, 3000).select(F.col("id"), F.when(F.col("id") < 2500, "hot").when(F.col("id") < 2990, "mid")
                                     .when(F.col("id") == 2990, "one").alias("c"), F.repeat(F.lit("x"), 50).alias("wide"))
    out = split_stratified(df, "c", "id", test=0.2, val=0.1)
    assert out.columns == ["id", "c", "wide", "split"]
    n = {(r["c"], r["split"]): r["count"] for r in out.groupBy("c", "split").count().collect()}
    assert n == {("hot", "test"): 500, ("hot", "val"): 250, ("hot", "train"): 1750, ("mid", "test"): 98,
                 ("mid", "val"): 49, ("mid", "train"): 343, ("one", "test"): 1}
    twice = split_stratified(df.unionByName(df), "c", "id", test=0.2, val=0.1)
    assert twice.groupBy("id").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0
    picked = sample_stratified_proportional(df, "c", "id", 100)
    assert {r["c"]: r["count"] for r in picked.groupBy("c").count().collect()} == {"hot": 83, "mid": 16}
    assert picked.columns == df.columns
    assert split_stratified(df.where("false"), "c", "id").count() == 0


def test_exact_quantiles_heavy_tail(spark):
    """One extreme value, far beyond all others, changes no other position."""
    from quarry.operators.quantiles import exact_quantiles
    vals = [float(i % 97) + i / 1000.0 for i in range(3000)] + [1e12]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = exact_quantiles(df, [], "v", {"q1": 0.25, "med": 0.5, "q3": 0.75}).first()
    x = np.array(vals)
    assert r["med"] == pytest.approx(np.median(x)) and r["q1"] == pytest.approx(np.quantile(x, 0.25))
    assert r["q3"] == pytest.approx(np.quantile(x, 0.75)) and r["n"] == len(vals)


def test_exact_quantiles_at_two_scales(spark):
    """Values at scales from 1e-12 to 1e12, a hot group with a null key, no
    piece to rank larger than a partition, and box statistics from the counts."""
    from quarry.operators.dist import box_stats
    from quarry.operators.quantiles import exact_quantiles, exact_quantiles_of, quantiles_of_counts, sorted_counts
    rng = np.random.RandomState(9)
    vals = np.concatenate([rng.rand(4000) * 1e-12, rng.rand(3000), rng.rand(2000) * 1e12, np.full(1500, 0.5)])
    rng.shuffle(vals)
    rows = [(None if i % 3 else "small", float(v)) for i, v in enumerate(vals)] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p01": 0.01, "q1": 0.25, "med": 0.5, "p99": 0.99}
    counts = sorted_counts(df, "g", "v", 16)
    assert counts.groupBy("_part").count().agg({"count": "max"}).first()[0] < counts.count() / 4
    got = {r["g"]: r for r in quantiles_of_counts(counts, "g", probs).collect()}
    assert set(got) == {None, "small"}
    for g, r in got.items():
        x = np.array([v for k, v in rows if k == g])
        assert r["n"] == len(x) and [r[p] for p in probs] == pytest.approx([np.quantile(x, q) for q in probs.values()], rel=1e-9)
    many = {r["measure"]: r for r in exact_quantiles_of(df.withColumn("w", F.col("v") * 2), [], ["v", "w"], {"m": 0.5}).collect()}
    assert many["v"]["m"] == pytest.approx(np.median(vals)) and many["w"]["m"] == pytest.approx(2 * np.median(vals))
    assert exact_quantiles(df.where("false"), [], "v", {"m": 0.5}).collect()[0]["m"] is None
    assert exact_quantiles(df.where("false"), "g", "v", {"m": 0.5}).count() == 0
    box = box_stats(df.where("g = 'small'"), "g", "v").first()
    x = np.array([v for k, v in rows if k == "small"])
    q1, q3 = np.quantile(x, [0.25, 0.75])
    out = (x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))
    assert box["outliers"] == out.sum() and box["whisker_high"] == pytest.approx(x[~out].max(), abs=1e-4)


def test_typed_lookup_and_first_existing(spark):
    from quarry.sources.files import first_existing, read_typed_lookup
    d = tempfile.mkdtemp(prefix="quarry-src-test-")
    with open(os.path.join(d, "breeds.csv"), "w") as fh:
        fh.write('BreedID,BreedName\n1,"""Akita"""\n0,Nothing\n')
    got = dict(rows(read_typed_lookup(spark, os.path.join(d, "breeds.csv"), "BreedID", "BreedName"), "id", "name"))
    assert got == {1: "Akita", 0: "Not Specified"}
    assert first_existing(spark, [os.path.join(d, "missing"), d]) == d
    with pytest.raises(FileNotFoundError):
        first_existing(spark, [os.path.join(d, "missing")])


def test_json_sink_nan_and_dates(spark):
    from quarry.sources.sinks import json_ready
    df = spark.createDataFrame([(float("nan"), "2024-01-02")], "x double, d string").select(
        "x", F.to_date("d").alias("d"))
    r = json_ready(df).first()
    assert r["x"] is None and r["d"] == "2024-01-02"


def test_vocabulary_vectorizer_matches_long_form(spark):
    """The MLlib feature path (vocabulary + Arrow weighting) gives the same
    sublinear, smooth-idf, L2-normalised weights as the long-form SQL path."""
    from quarry.operators import text as tx
    from quarry.operators.ml import VocabularyVectorizer
    docs = [(1, ["a", "b", "a", "c"]), (2, ["b", "c", "c"]), (3, ["a", "d"])]
    df = spark.createDataFrame(docs, "doc int, grams array<string>")
    model = VocabularyVectorizer(inputCol="grams", outputCol="v", min_df=1, max_df=1.0, vocab_size=100).fit(df)
    vocab = model.models[0].vocabulary
    vec = {r["doc"]: r["v"].toArray() for r in model.transform(df).collect()}
    tf = tx.term_frequencies(df, "doc", F.col("grams"))
    nd = tx.doc_counts(df)
    w = tx.tfidf_weights(tf, tx.select_vocabulary(tf, nd), nd, "doc", sublinear=True)
    for r in w.collect():
        assert vec[r["doc"]][vocab.index(r["term"])] == pytest.approx(r["weight"])


def test_metrics_scan_the_predictions_once(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", None), (None, "c")], "actual string, predicted string")
    from quarry.operators import evaluate as ev
    per = {r["label"]: (r["tp"], r["support"], r["n_pred"])
           for r in ev._per_label(ev.confusion_cells(pred, "actual", "predicted"), []).collect()}
    assert per == {"a": (1, 2, 1), "b": (0, 1, 1), "c": (0, 0, 1), None: (0, 0, 0)}


def test_linear_models_have_the_penalty_of_c_one(spark):
    """Coefficients of each one-vs-rest logistic model against a Newton solver."""
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from quarry.operators.learners import LinearOvR
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2)) * [1.0, 5.0]
    y = (x[:, 0] + 0.1 * x[:, 1] + rng.normal(size=60) > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"])
    got = LinearOvR(loss="log", weighting="none", penalise_intercept=False, tol=1e-8).fit(df).coefficients[:, 1]
    a, w = np.c_[x, np.ones(60)], np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        grad = a.T @ (p - y) + np.r_[w[:2], 0]
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag([1, 1, 0.0]), grad)
    assert np.allclose(got, w, atol=1e-4)


def test_term_statistics_and_row_weights_without_a_document_shuffle(spark):
    """Documents are counted and weighted in their own task; rows that share an id count as one document."""
    from quarry.functions.text import text_words
    from quarry.operators import text as tx
    rows = [(1, "x", "the cat the cat a"), (2, "x", "cat dog"), (2, "x", "dog the"), (None, "x", "cat ab"), (3, None, "dog"),
            (4, "y", ""), (5, "y", None), (6, "y", "the dog the dog \u00e9\U0001f600n")]
    df = spark.createDataFrame(rows, "doc int, lang string, text string")
    words = text_words("text")
    for keys in ([], ["lang"]):
        for kind, old in (("", tx.term_frequencies(df, "doc", words, keys)),
                          ("bigrams", tx.term_frequencies(df, "doc", words, keys, bigrams=True)),
                          ("chars", tx.char_ngram_frequencies(df, "doc", F.col("text"), keys))):
            want = old.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cnt"))
            got = tx.term_statistics(df, "doc", words, keys, kind)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            nd = tx.doc_counts(df, keys)
            weights = [w.withColumn("weight", F.round("weight", 9)).collect() for w in (
                tx.tfidf_weights(old, want, nd, "doc", keys, sublinear=True),
                tx.tfidf_rows(df, "doc", words, want, nd, keys, sublinear=True, kind=kind))]
            assert weights[0] and sorted(map(str, weights[0])) == sorted(map(str, weights[1]))
    alone = tx.term_statistics(df.where("doc is not null and doc <> 2"), "doc", words, kind="bigrams")
    assert alone._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_character_ngrams_in_small_pieces(spark, monkeypatch):
    from quarry.functions.text import text_words
    from quarry.operators import text as tx
    df = spark.createDataFrame([(i, "some words " * (i % 3 + 1) + "w" * (i % 7 + 1)) for i in range(40)], "doc int, text string").coalesce(1)
    got = [sorted(map(tuple, tx.row_statistics(df, text_words("text"), (), "chars").collect()))]
    monkeypatch.setattr(tx, "_PAIRS", 50)
    pieces = list(tx._row_counts(__import__("pyarrow").array([r["text"].split() for r in df.collect()]), "chars"))
    total = {}
    for terms, row, code, tf in pieces:
        for c, n in zip(code.tolist(), tf.tolist()):
            d, k = total.get(terms[c].as_py(), (0, 0))
            total[terms[c].as_py()] = (d + 1, k + n)
    assert len(pieces) > 5 and sorted((t, d, n) for t, (d, n) in total.items()) == got[0]


def test_stratified_split_does_not_shuffle_rows_by_class(spark):
    from quarry.operators.sampling import split_stratified
    df = spark.createDataFrame([(i, "abc"[i % 3], "text") for i in range(60)], "id int, label string, text string")
    out = split_stratified(df, "label", "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert out.where("split = 'test'").count() == 12


def test_ablation_scores_the_rows_once(spark):
    from pyspark.ml.functions import array_to_vector
    from quarry.operators import models as md
    from quarry.plans.models_plan import VectorRule
    from quarry.operators.rank import feature_subsets
    rows = [(i % 3, [float(i * j % 7) for j in range(11)]) for i in range(30)]
    df = spark.createDataFrame(rows, "outcome int, x array<double>").select("outcome", array_to_vector("x").alias("features"))
    slices = {"a": (0, 4), "b": (4, 11)}
    subs = feature_subsets(spark.createDataFrame([("a",), ("b",)], "g string"), "g", 2)
    out = md.ablate(VectorRule(), df, "outcome", slices, subs, baseline=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_x" not in plan and "features" not in plan
    assert {r["subset_name"] for r in out.collect()} == {"<none>", "a", "b", "a+b"}


def test_chi2_scores_by_hand_with_rows_of_no_class(spark):
    from quarry.operators.stats import chi2_terms
    rows = [(1, "a", "t", 4), (2, "b", "t", 1), (3, "b", "u", 2), (4, None, "t", 3), (5, None, "v", 2)]
    tf = spark.createDataFrame(rows, "doc int, cls string, term string, n long")
    got = {r["term"]: r["chi2"] for r in chi2_terms(tf, "doc", "term", "n", "cls").collect()}
    share, seen = {"a": 0.2, "b": 0.4}, {"t": {"a": 4, "b": 1}, "u": {"b": 2}}
    total, want = {"t": 8, "u": 2}, {}
    for term, cells in seen.items():
        e = {c: share[c] * total[term] for c in cells}
        want[term] = round(sum((o - e[c]) ** 2 / e[c] for c, o in cells.items()) + total[term] - sum(e.values()), 6)
    assert got == want


def test_chi2_terms_are_grouped_by_term_once(spark):
    from quarry.operators.stats import chi2_terms
    tf = spark.createDataFrame([(1, "a", "t", 4), (2, "b", "u", 1)], "doc int, cls string, term string, n long")
    plan = chi2_terms(tf, "doc", "term", "n", "cls", docs=tf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_images_are_scored_a_bounded_run_at_a_time(spark, tmp_path):
    """The model sees at most ``batch_size`` images at once, in one Python pass; values by the plain formula."""
    import numpy as np
    from quarry.operators import images as im
    data = [(f"{i}.bmp", 4, 5, 3, bytes((np.arange(60) * (i + 1) % 251).astype(np.uint8))) for i in range(23)]
    df = spark.createDataFrame(data, "path string, height int, width int, channels int, data binary").coalesce(1)

    def make():
        return lambda x: np.stack([x.sum(axis=1), np.full(len(x), len(x), np.float32)], axis=1)
    out = im.embed_images(df, make, dim=2, size=6, batch_size=5)
    assert "ArrowEvalPython" not in out._jdf.queryExecution().toString()
    got = {r["path"]: r["embedding"] for r in out.collect()}
    assert len(got) == 23 and max(v[1] for v in got.values()) == 5
    for path, h, w, c, pixels in data:
        want = im.resize_bilinear(im.to_array(pixels, h, w, c), 6, 6).sum() / 255
        assert got[path][0] == pytest.approx(want, rel=1e-5)


def test_resize_interpolates_rows_and_columns():
    import numpy as np
    from quarry.operators.images import resize_bilinear, saturation
    img = np.random.RandomState(3).randint(0, 256, (7, 5, 3)).astype(np.uint8)
    got = resize_bilinear(img, 9, 4)
    for y in range(9):
        for x in range(4):
            at = [min(max((p + 0.5) * n / m - 0.5, 0), n - 1) for p, n, m in ((y, 7, 9), (x, 5, 4))]
            (a, b), (c, d) = ((int(v), min(int(v) + 1, n - 1)) for v, n in zip(at, (7, 5)))
            s, t = at[0] - a, at[1] - c
            want = (img[a, c] * (1 - t) + img[a, d] * t) * (1 - s) + (img[b, c] * (1 - t) + img[b, d] * t) * s
            assert np.allclose(got[y, x], want)
    assert got[:, :, 0].T.flags.c_contiguous   # a channel lies by itself
    assert saturation(np.array([[[0.0, 5, 10], [0, 0, 0]]])) == pytest.approx(127.5)


def test_count_vectorizer_has_the_vocabulary_of_mllib(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
    from quarry.operators import models as md
    texts = ["red green blue", "red green", "red blue blue", "red red yellow", "green blue"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    grams = Pipeline(stages=md.word_ngram_stages()).fit(df).transform(df)
    made = md.count_vectorizer(df, "grams", "tf", 2, 0.95, 100)
    want = CountVectorizer(inputCol="grams", outputCol="tf", minDF=2.0, maxDF=0.95, vocabSize=100).fit(grams)
    assert isinstance(made, CountVectorizerModel) and sorted(made.vocabulary) == sorted(want.vocabulary)


def test_tfidf_covers_every_category(spark, monkeypatch):
    import duckdb
    from quarry.operators import text as tx
    from quarry.plans.registry import load_all
    words = ["apple", "pear", "plum", "fig"]
    data = [(c * 10 + i, f"l{c}", f"{words[(c + i) % 4]} {words[i % 3]} own{c}") for c in range(9) for i in range(c + 1)]
    docs = spark.createDataFrame([*data, (500, None, "apple"), (501, "l3", None)], "doc_id long, lang string, text string")
    folder = tempfile.mkdtemp()
    docs.write.parquet(f"{folder}/documents.parquet")
    query, cols = load_all()["text_tfidf_by_category"], ("lang", "term", "score")   # equal scores may differ in their last bits
    sent = sorted(rows(query.build(spark, folder), *cols))
    assert {r[0] for r in sent} == {f"l{c}" for c in range(9)}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert sent == sorted(con.execute(f"SELECT lang, term, score FROM ({query.oracle})").fetchall())
    monkeypatch.setattr(tx, "SENT_TERMS", 0)
    assert sorted(rows(query.build(spark, folder), *cols)) == sent
