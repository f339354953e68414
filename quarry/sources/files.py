"""File sources: CSV, typed lookups, JSON lines, nested
JSON, file listings and decoded images — all with explicit schemas (no
inference pass) so the scans prune columns and push filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True,
                   empty_value: str | None = None) -> DataFrame:
    """CSV with a header and quoted (possibly multi-line) text fields.

    Blank and missing cells stay distinguishable: missing → null, quoted
    empty → ``empty_value`` (default empty string)."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", multiline)
            .option("escape", '"').option("quote", '"').option("mode", "PERMISSIVE")
            .option("emptyValue", "" if empty_value is None else empty_value).option("nullValue", None)
            .csv(path))


def read_typed_lookup(spark: SparkSession, path: str, id_col: str, name_col: str,
                      default_id: int = 0, default_name: str = "Not Specified") -> DataFrame:
    """Id → name lookup from CSV: ids cast to int, quotes stripped from
    names, and the default id row added (it wins over a file row with the
    same id, as a later dict assignment would)."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    rows = raw.select(F.col(id_col).cast("int").alias("id"),
                      F.regexp_replace(F.col(name_col), '"', "").alias("name")).where(F.col("id") != default_id)
    default = spark.createDataFrame([(default_id, default_name)], "id int, name string")
    return rows.unionByName(default)


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """S3 helper: the first candidate path that exists (Hadoop FS check)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for c in candidates:
        p = jvm.org.apache.hadoop.fs.Path(c)
        if p.getFileSystem(conf).exists(p):
            return c
    raise FileNotFoundError(f"none of {list(candidates)} exists")


def read_jsonl(spark: SparkSession, candidates: Sequence[str] | str, schema: T.StructType | str) -> DataFrame:
    """S3: JSON-lines table from the first existing candidate path."""
    path = candidates if isinstance(candidates, str) else first_existing(spark, candidates)
    return spark.read.schema(schema).json(path)


# Nested per-image metadata layout (any field may be absent).
METADATA_SCHEMA = T.StructType([
    T.StructField("labelAnnotations", T.ArrayType(T.StructType([
        T.StructField("description", T.StringType()), T.StructField("score", T.DoubleType())]))),
    T.StructField("imagePropertiesAnnotation", T.StructType([
        T.StructField("dominantColors", T.StructType([
            T.StructField("colors", T.ArrayType(T.StructType([
                T.StructField("color", T.StructType([T.StructField("red", T.DoubleType()),
                                                     T.StructField("green", T.DoubleType()),
                                                     T.StructField("blue", T.DoubleType())])),
                T.StructField("score", T.DoubleType())])))]))])),
    T.StructField("cropHintsAnnotation", T.StructType([
        T.StructField("cropHints", T.ArrayType(T.StructType([
            T.StructField("boundingPoly", T.StructType([
                T.StructField("vertices", T.ArrayType(T.StructType([
                    T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])))]))])))])),
])


def read_nested_json(spark: SparkSession, path: str, schema: T.StructType = METADATA_SCHEMA,
                     one_document_per_file: bool = False, key_col: str = "stem") -> DataFrame:
    """Nested JSON documents with an explicit schema; with one document
    per file the file stem becomes ``key_col``."""
    df = spark.read.schema(schema).option("multiLine", one_document_per_file).json(path)
    if one_document_per_file:
        df = df.withColumn(key_col, F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^./]+$", 1))
    return df


def file_listing(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Files matching ``glob`` with size in KB, stem and parent key
    (text before the last '-').  The ``content`` column is never selected,
    so no file body is read."""
    return describe_files(spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path))


def describe_files(files: DataFrame) -> DataFrame:
    """Name, stem, parent key and size in KB of rows with ``path, length``."""
    from quarry.functions.scalar import key_from_filename
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select("path", name.alias("file_name"), stem.alias("stem"),
                        key_from_filename(stem).alias("key"),
                        F.round(F.col("length") / 1024.0, 1).alias("size_kb"), "length")


def read_images(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Decoded images (BGR, row-major); unreadable files are dropped."""
    df = spark.read.format("image").option("dropInvalid", True).option("pathGlobFilter", glob).load(path)
    stem = F.regexp_extract(F.col("image.origin"), r"([^/]+)\.[^./]+$", 1)
    return df.select(F.col("image.origin").alias("path"), stem.alias("stem"), F.col("image.height").alias("height"),
                     F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"),
                     F.col("image.mode").alias("mode"), F.col("image.data").alias("data"))
