"""Source/sink round trips and image jobs.

Every file these queries read is first written by Spark from the driver
tables into the shared scratch area under ``spark.checkpoint.dir``; the
SQL oracles compute the same values straight from the tables, so a round
trip that loses or alters rows fails the check.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import scalar as fsc
from quarry.operators import images as im
from quarry.plans.registry import query
from quarry.session import checkpoint_dir
from quarry.sources import files as src
from quarry.sources import images as img
from quarry.sources import sinks
from quarry.sources.tables import Tables


def scratch(spark, name: str) -> str:
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "quarry-io", f"{name}-{uuid.uuid4().hex[:12]}")


@query("src_csv_table", "S1", oracle="SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS n_text, source FROM documents")
def src_csv_table(spark, sf_dir):
    """Documents (multi-line, quoted text) written as CSV and read back."""
    d = Tables(spark, sf_dir).documents.select("doc_id", "text", "lang", "source")
    path = scratch(spark, "csv")
    d.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    back = src.read_csv_table(spark, path, "doc_id long, text string, lang string, source string")
    return back.select("doc_id", "lang", F.length("text").alias("n_text"), "source")


@query("src_csv_typed_lookup", "S2 F4", oracle="""
SELECT CAST(n_nationkey + 1 AS INTEGER) AS id, n_name AS name FROM nation
UNION ALL SELECT 0, 'Not Specified'""")
def src_csv_typed_lookup(spark, sf_dir):
    """Nation lookup written as text CSV with quoted names, read with int
    casts, quotes stripped and the default id 0 row added."""
    n = Tables(spark, sf_dir).nation.select((F.col("n_nationkey") + 1).cast("string").alias("BreedID"),
                                            F.concat(F.lit('"'), "n_name", F.lit('"')).alias("BreedName"))
    path = scratch(spark, "lookup")
    n.write.option("header", True).option("quote", "\u0000").csv(path)
    return src.read_typed_lookup(spark, path, "BreedID", "BreedName")


@query("src_jsonl_articles", "S3", oracle="SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS n_text FROM documents")
def src_jsonl_articles(spark, sf_dir):
    """Documents as JSON lines, read from the first existing candidate path."""
    d = Tables(spark, sf_dir).documents.select("doc_id", "text", "lang")
    path = scratch(spark, "jsonl")
    d.write.json(path)
    back = src.read_jsonl(spark, [path + "-missing", path], "doc_id long, text string, lang string")
    return back.select("doc_id", "lang", F.length("text").alias("n_text"))


def _metadata(t: Tables):
    """Nested per-event metadata documents (label / colour / crop-hint
    annotations) derived from ``events``; ``x`` is absent when k is even."""
    e = t.events
    k = F.get_json_object("props", "$.k").cast("long")
    labels = F.array(F.struct(F.col("event_type").alias("description"), (F.col("value") / 100).alias("score")),
                     F.struct(F.lit("user").alias("description"), ((F.col("user_id") % 10) / 10.0).alias("score")),
                     F.struct(F.lit("k").alias("description"), (k / 100.0).alias("score")))
    colors = F.array(F.struct(F.struct(k.cast("double").alias("red"), F.lit(None).cast("double").alias("green"),
                                       F.col("value").alias("blue")).alias("color"), F.lit(0.5).alias("score")))
    xa = F.when(k % 2 == 1, k)
    verts = F.array(F.struct(xa.alias("x"), F.lit(10).cast("long").alias("y")),
                    F.struct((k + F.floor("value")).cast("long").alias("x"), F.lit(50).cast("long").alias("y")))
    return e.select(F.concat(F.col("event_id").cast("string"), F.lit("-1")).alias("stem"),
                    labels.alias("labelAnnotations"),
                    F.struct(F.struct(colors.alias("colors")).alias("dominantColors")).alias("imagePropertiesAnnotation"),
                    F.struct(F.array(F.struct(F.struct(verts.alias("vertices")).alias("boundingPoly")))
                             .alias("cropHints")).alias("cropHintsAnnotation"))


def _metadata_roundtrip(spark, sf_dir):
    path = scratch(spark, "meta")
    _metadata(Tables(spark, sf_dir)).write.json(path)
    schema = T.StructType([T.StructField("stem", T.StringType())] + src.METADATA_SCHEMA.fields)
    return src.read_nested_json(spark, path, schema)


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query("fn_json_topk_labels", "F7 S4", oracle=f"""
WITH l AS (SELECT event_id, [{{'d': event_type, 's': value / 100, 'i': 1}},
                             {{'d': 'user', 's': (user_id % 10) / 10.0, 'i': 2}},
                             {{'d': 'k', 's': {_K} / 100.0, 'i': 3}}] AS labels FROM events)
SELECT CAST(event_id AS VARCHAR) || '-1' AS stem,
       array_to_string(list_transform(list_slice(list_sort(list_transform(labels, lambda x: {{'neg': -x.s, 'i': x.i, 'd': x.d}})), 1, 2),
                                      lambda x: x.d), ',') AS top_labels FROM l""")
def fn_json_topk_labels(spark, sf_dir):
    """Two highest-scoring label descriptions per metadata document."""
    m = _metadata_roundtrip(spark, sf_dir)
    return m.select("stem", F.concat_ws(",", fsc.top_labels(F.col("labelAnnotations"), 2)).alias("top_labels"))


@query("fn_json_colors", "F8", oracle=f"""
SELECT CAST(event_id AS VARCHAR) || '-1' AS stem, CAST({_K} AS DOUBLE) AS red, CAST(0.0 AS DOUBLE) AS green,
       value AS blue, CAST(0.5 AS DOUBLE) AS score FROM events""")
def fn_json_colors(spark, sf_dir):
    """Dominant colours with absent channels defaulting to 0."""
    m = _metadata_roundtrip(spark, sf_dir)
    c = m.select("stem", F.explode(fsc.colors(F.col("imagePropertiesAnnotation.dominantColors.colors"))).alias("c"))
    return c.select("stem", "c.red", "c.green", "c.blue", "c.score")


@query("proj_bbox_pct", "P21", oracle=f"""
WITH v AS (SELECT event_id, CASE WHEN {_K} % 2 = 1 THEN {_K} ELSE 0 END AS x0, 10 AS y0,
                  {_K} + CAST(floor(value) AS BIGINT) AS x1, 50 AS y1 FROM events),
b AS (SELECT event_id, least(x0, x1) AS x, least(y0, y1) AS y, greatest(x0, x1) - least(x0, x1) AS w,
             greatest(y0, y1) - least(y0, y1) AS h FROM v)
SELECT CAST(event_id AS VARCHAR) || '-1' AS stem, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y,
       CAST(w AS BIGINT) AS w, CAST(h AS BIGINT) AS h,
       round(x * 100.0 / 400, 2) AS x_pct, round(y * 100.0 / 200, 2) AS y_pct,
       round(w * 100.0 / 400, 2) AS w_pct, round(h * 100.0 / 200, 2) AS h_pct FROM b""")
def proj_bbox_pct(spark, sf_dir):
    """Crop-hint polygon → x, y, w, h → percentages of a 400 × 200 image."""
    m = _metadata_roundtrip(spark, sf_dir)
    b = m.select("stem", F.explode("cropHintsAnnotation.cropHints").alias("hint")) \
        .select("stem", fsc.bbox_from_vertices(F.col("hint.boundingPoly.vertices")).alias("bb"))
    pct = fsc.bbox_pct(F.col("bb"), F.lit(400), F.lit(200))
    return b.select("stem", "bb.x", "bb.y", "bb.w", "bb.h", pct.x_pct.alias("x_pct"), pct.y_pct.alias("y_pct"),
                    pct.w_pct.alias("w_pct"), pct.h_pct.alias("h_pct"))


@query("sink_json", "S7 F6", oracle="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_totalprice END AS price FROM orders""")
def sink_json(spark, sf_dir):
    """Orders written as JSON (NaN → null, dates as text) and read back."""
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_totalprice") > 400000, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"))
    path = scratch(spark, "json")
    sinks.write_json(o, path)
    return spark.read.schema("o_orderkey long, o_orderdate string, price double").json(path)


@query("sink_csv_stage", "S8", oracle="""
SELECT l_returnflag, count(*) AS cnt, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY ALL""")
def sink_csv_stage(spark, sf_dir):
    """A stage table materialised and re-read by the next stage."""
    path = scratch(spark, "stage")
    sinks.write_stage(Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_extendedprice"), path)
    back = sinks.read_stage(spark, path)
    return back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("cnt"),
                                            F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("sink_partial_append", "S9", oracle="""
SELECT o_orderstatus, count(*) AS cnt FROM orders GROUP BY ALL""")
def sink_partial_append(spark, sf_dir):
    """One appended row per finished unit of work (here: per order status)."""
    o = Tables(spark, sf_dir).orders
    path = scratch(spark, "append")
    statuses = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"))
    sinks.append_rows(statuses.where(F.col("o_orderstatus") == "F"), path)
    sinks.append_rows(statuses.where(F.col("o_orderstatus") != "F"), path)
    return spark.read.schema("o_orderstatus string, cnt long").json(path)


@query("sink_named_report", "S11", oracle="""
SELECT 'quality_by_lang' AS config, lang, count(*) AS docs FROM documents GROUP BY ALL""")
def sink_named_report(spark, sf_dir):
    base = scratch(spark, "reports")
    rep = Tables(spark, sf_dir).documents.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    sinks.write_named_report(rep, base, "quality_by_lang")
    return spark.read.json(base).select("config", "lang", F.col("docs").cast("long").alias("docs"))


@query("sink_model", "S10")
def sink_model(spark, sf_dir):
    """A fitted text pipeline (built-in, writable stages) saved, reloaded and
    used for scoring."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, Normalizer
    from quarry.operators import models as md
    d = Tables(spark, sf_dir).documents.select("doc_id", "text", F.col("lang").alias("category"))
    stages = [md.label_indexer()] + md.word_ngram_stages() + [
        md.count_vectorizer(d, "grams", "tf", min_df=5, max_df=0.95, vocab=50000),
        IDF(inputCol="tf", outputCol="tfidf"), Normalizer(inputCol="tfidf", outputCol="features"),
        NaiveBayes(smoothing=0.15)]
    model = Pipeline(stages=stages).fit(d)
    path = scratch(spark, "model")
    sinks.save_model(model, path)
    back = sinks.load_model(path)
    return back.transform(d).groupBy("category").agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))
                                                     .alias("train_accuracy"))


# ---------------------------------------------------------------------------
# Images: the embeddings table as a table of bitmaps
# ---------------------------------------------------------------------------
_IMAGE_TABLES: dict[str, str] = {}


def _little_endian(c) -> Column:
    """Hex digits of a 32-bit number, lowest byte first."""
    h = F.lpad(F.hex(c.cast("long")), 8, "0")
    return F.concat(*[F.substring(h, at, 2) for at in (7, 5, 3, 1)])


def vector_bitmap(vec) -> Column:
    """A 24-bit bitmap of a vector, built by column functions: the values,
    scaled to 0-255, in rows of a multiple of four pixels; the channels are
    the vector, the vector one row on, and the vector backwards."""
    n = F.size(vec)
    w = F.ceil(F.ceil(F.sqrt(n)) / 4) * 4
    h = F.ceil(n / w)
    lo, span = F.array_min(vec), F.array_max(vec) - F.array_min(vec)

    def level(j):
        scaled = F.when((j < n) & (span > 0), (F.get(vec, j.cast("int")) - lo) / span * 255).otherwise(0)
        return F.lpad(F.hex(F.floor(scaled).cast("long")), 2, "0")

    def pixel(i):  # rows are stored from the bottom up
        j = (h - 1 - F.floor(i / w)) * w + i % w
        return F.concat(level(j), level((j + w) % (w * h)), level(w * h - 1 - j))
    body = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), w * h - 1), pixel), "")
    head = F.concat(F.lit("424D"), _little_endian(w * h * 3 + 54), F.lit("000000003600000028000000"),
                    _little_endian(w), _little_endian(h), F.lit("01001800"), F.lit("00" * 24))
    return F.when(n > 0, F.unhex(F.concat(head, body)))


def image_table(spark, sf_dir) -> str:
    """Every embedding as ``<vec_id>-1.bmp``, plus one unreadable row, written
    as an image table once per session and scale factor."""
    key = f"{id(spark.sparkContext)}:{sf_dir}"
    if key not in _IMAGE_TABLES:
        out = scratch(spark, "images")
        e = Tables(spark, sf_dir).embeddings
        rows = e.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "vec_id").select(
            F.concat(F.col("vec_id").cast("string"), F.lit("-1.bmp")).alias("path"), vector_bitmap(F.col("embedding")).alias("content"))
        junk = spark.range(1).select(F.lit("junk-1.bmp").alias("path"), F.lit("not an image at all").cast("binary").alias("content"))
        img.write_image_table(rows.unionByName(junk), out)
        _IMAGE_TABLES[key] = out
    return _IMAGE_TABLES[key]


# The size of an embedding's bitmap in SQL, for the oracles.
_BITMAPS = """
g AS (SELECT vec_id, label, CAST(4 * ceil(ceil(sqrt(len(embedding))) / 4) AS BIGINT) AS w, len(embedding) AS n FROM embeddings),
f AS (SELECT CAST(vec_id AS VARCHAR) AS key, CASE WHEN label % 2 = 0 THEN 'Dog' ELSE 'Cat' END AS type,
             CAST(w AS INTEGER) AS width, CAST(ceil(n * 1.0 / w) AS INTEGER) AS height,
             CAST(54 + 3 * w * ceil(n * 1.0 / w) AS BIGINT) AS length FROM g)"""


def _listing_types(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.select(F.col("vec_id").cast("string").alias("key"), "label",
                                                F.when(F.col("label") % 2 == 0, "Dog").otherwise("Cat").alias("type"))
    return e


@query("src_file_listing", "S5 P7", oracle=f"""WITH {_BITMAPS}, a AS (
  SELECT key, length FROM f UNION ALL SELECT 'junk', 19)
SELECT key || '-1.bmp' AS path, key || '-1.bmp' AS file_name, key || '-1' AS stem, key,
       CAST(round(length / 1024.0, 1) AS DOUBLE) AS size_kb, CAST(length AS BIGINT) AS length FROM a""")
def src_file_listing(spark, sf_dir):
    path = image_table(spark, sf_dir)
    return img.table_listing(spark, path)


@query("src_images", "S6", oracle=f"""WITH {_BITMAPS}
SELECT key || '-1.bmp' AS path, height, width, 3 AS channels, 16 AS mode FROM f""")
def src_images(spark, sf_dir):
    path = image_table(spark, sf_dir)
    return img.read_image_table(spark, path, pixels=False).select("path", "height", "width", "channels", "mode")


@query("img_metadata", "I1 J7 A11", oracle=f"""WITH {_BITMAPS}
SELECT type, count(*) AS images, count(DISTINCT key) AS listings, round(avg(round(length / 1024.0, 1)), 1) AS avg_kb,
       quantile_cont(CAST(width AS DOUBLE), 0.5) AS median_width, quantile_cont(CAST(height AS DOUBLE), 0.5) AS median_height,
       quantile_cont(CAST(round(length / 1024.0, 1) AS DOUBLE), 0.5) AS median_size_kb FROM f GROUP BY type""")
def img_metadata(spark, sf_dir):
    """Per type: image and listing counts, median width / height / size."""
    from quarry.operators.quantiles import exact_quantiles_of
    path = image_table(spark, sf_dir)
    files = img.table_listing(spark, path)
    imgs = img.read_image_table(spark, path, pixels=False).select("stem", "width", "height")
    meta = files.join(imgs, "stem").join(_listing_types(spark, sf_dir), "key")
    counts = meta.groupBy("type").agg(F.count(F.lit(1)).alias("images"), F.count_distinct("key").alias("listings"),
                                      F.round(F.avg("size_kb"), 1).alias("avg_kb"))
    q = exact_quantiles_of(meta, "type", ["width", "height", "size_kb"], {"median": 0.5}, count_col=None)
    med = q.groupBy("type").pivot("measure", ["width", "height", "size_kb"]).agg(F.first("median"))
    med = med.select("type", *[F.col(c).alias(f"median_{c}") for c in ("width", "height", "size_kb")])
    return counts.join(med, "type")


@query("img_quality", "I2 E3 E4 K1 D1")
def img_quality(spark, sf_dir):
    """Quality metrics per image and the composite min-max score."""
    from quarry.operators.features import composite_score
    path = image_table(spark, sf_dir)
    imgs = img.read_image_table(spark, path)
    # The pixels are measured once: the extremes and the scores read the written metrics.
    q = im.image_quality(imgs).checkpoint()
    return composite_score(q, ["brightness", "sharpness", "contrast", "colorfulness", "saturation"],
                           "quality_score")


@query("img_dominant_colors", "I3 V3")
def img_dominant_colors(spark, sf_dir):
    """Three dominant colours of at most 20 images per outcome, and of at
    most 20 per type."""
    from quarry.operators.sampling import sample_cap_per_group
    path = image_table(spark, sf_dir)
    files = img.table_listing(spark, path).select("stem", "key").join(_listing_types(spark, sf_dir), "key")
    picked = None
    for grouping, group in (("by_outcome", F.col("label")), ("by_type", F.col("label") % 2)):
        rows = sample_cap_per_group(files.select("stem", "key", group.alias("group")), "group", "key", 20)
        rows = rows.select("stem", F.lit(grouping).alias("grouping"), F.col("group").cast("int").alias("group"))
        picked = rows if picked is None else picked.unionByName(rows)
    # An image drawn for both groupings is read and clustered once.
    images = img.read_image_table(spark, path).join(picked.select("stem").distinct(), "stem", "left_semi")
    return im.image_dominant_colors(images, ("stem",)).join(picked, "stem")


def _annotations(spark, sf_dir):
    """Images ⟕ their metadata by file stem (J11), boxes with positive area."""
    path = image_table(spark, sf_dir)
    files = img.table_listing(spark, path).select("stem", "key")
    imgs = img.read_image_table(spark, path, pixels=False).select("stem", "width", "height")
    meta = _metadata_roundtrip(spark, sf_dir)
    j = files.join(imgs, "stem").join(meta, "stem", "left")
    boxes = j.select("stem", "key", "width", "height",
                     fsc.top_labels(F.col("labelAnnotations"), 3).alias("labels"),
                     fsc.colors(F.col("imagePropertiesAnnotation.dominantColors.colors")).alias("colors"),
                     F.posexplode_outer("cropHintsAnnotation.cropHints").alias("box_idx", "hint"))
    boxes = boxes.withColumn("bbox", fsc.bbox_from_vertices(F.col("hint.boundingPoly.vertices"))).drop("hint")
    return boxes.where((F.col("bbox.w") > 0) & (F.col("bbox.h") > 0)).withColumn(
        "annotation_id", F.xxhash64("stem", "box_idx")).withColumn("image_id", F.xxhash64("stem")).withColumn("area", F.col("bbox.w") * F.col("bbox.h"))


@query("img_annotations", "I4 J11")
def img_annotations(spark, sf_dir):
    """One row per box: ids of the box and its image, box, area, labels and colours."""
    return _annotations(spark, sf_dir).select("annotation_id", "image_id", "stem", "width", "height", "bbox", "area",
                                              "labels", "colors")


@query("img_annotation_images", "I4")
def img_annotation_images(spark, sf_dir):
    """The bundle's image list: every readable image, with or without boxes."""
    path = image_table(spark, sf_dir)
    sizes = img.read_image_table(spark, path, pixels=False)
    return sizes.select(F.xxhash64("stem").alias("image_id"), F.col("path").alias("file_name"), "width", "height")


@query("img_gallery", "I5 J6 P21")
def img_gallery(spark, sf_dir):
    """Per type and label: up to 100 listings with their first box (as %
    of the image) and top label."""
    from quarry.operators.joins import first_match
    from quarry.operators.sampling import sample_cap_per_group
    ann = _annotations(spark, sf_dir)
    first = first_match(ann, "stem", [F.col("box_idx")])
    listings = _listing_types(spark, sf_dir)
    picked = sample_cap_per_group(listings, "label", "key", 100)
    g = picked.join(first, "key", "left")
    pct = fsc.bbox_pct(F.col("bbox"), F.col("width"), F.col("height"))
    return g.select("type", "label", "key", F.col("labels")[0].alias("bbox_label"), pct.alias("bbox_pct"))


@query("img_embedding_scoring", "I6")
def img_embedding_scoring(spark, sf_dir):
    """Batch feature extraction over the images with a given model function."""
    path = image_table(spark, sf_dir)
    imgs = img.read_image_table(spark, path)
    out = im.embed_images(imgs, im.projection_model(32 * 32 * 3, 8), dim=8, size=32)
    return out.select("path", "embedding")
