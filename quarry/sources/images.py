"""Images as bytes in a table.

The table is written and read by Spark (``path, length, content``, the layout
of the ``binaryFile`` source), so it may lie on any Hadoop file system.
Listings read no content; pixels are decoded in Arrow batches, in the layout
of the ``image`` source (BGR, row-major, 3 channels)."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.files import describe_files

#: OpenCV's type code of three unsigned bytes a pixel, as Spark's image source gives it.
MODE_BGR = 16
#: Bytes of pixels after which decoded images are sent on.
BATCH_BYTES = 8 << 20


def write_image_table(images: DataFrame, path: str) -> None:
    """Rows of ``path, content`` as an image table; rows without content stay listed, with length 0."""
    length = F.coalesce(F.octet_length("content"), F.lit(0)).cast("long")
    images.select("path", length.alias("length"), "content").write.parquet(path)


def table_listing(spark: SparkSession, path: str) -> DataFrame:
    """The image table's files with name, stem, parent key and size."""
    return describe_files(spark.read.parquet(path).select("path", "length"))


def read_image_table(spark: SparkSession, path: str, pixels: bool = True) -> DataFrame:
    """``path, stem, height, width, channels, mode, data`` of the table's
    images; rows whose content is null or not an image are dropped.  Without
    ``pixels`` only the headers are parsed and ``data`` is null."""
    rows = spark.read.parquet(path).select("path", "content")
    out = decode_images(rows, pixels)
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return out.select("path", stem.alias("stem"), "height", "width", "channels", "mode", "data")


def decode_images(rows: DataFrame, pixels: bool = True) -> DataFrame:
    """``path, height, width, channels, mode, data`` from ``path, content``."""
    names = ["path", "height", "width", "channels", "mode", "data"]

    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

    def sent(found):
        cols = list(zip(*found)) or [()] * 4
        values = [*cols[:3], [3] * len(found), [MODE_BGR] * len(found), cols[3]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    def run(batches):
        for b in batches:
            found, held = [], 0
            for path, content in zip(b.column(0), b.column(1)):
                img = decode(content.as_py(), pixels)
                if img is not None:
                    found.append((path.as_py(), *img))
                    held += len(img[2] or b"")
                    if held > BATCH_BYTES:
                        yield sent(found)
                        found, held = [], 0
            yield sent(found)
    return rows.select("path", "content").mapInArrow(
        run, "path string, height int, width int, channels int, mode int, data binary")


def decode(content: bytes | None, pixels: bool = True) -> tuple[int, int, bytes | None] | None:
    """Height, width and BGR bytes; None when the content is no image.
    Uncompressed bitmaps are read here, other formats by Pillow where it is
    installed (``read_images`` decodes files of them without it)."""
    if not content:
        return None
    if content[:2] == b"BM":
        return _decode_bitmap(content, pixels)
    if not content.startswith((b"\x89PNG", b"\xff\xd8\xff", b"GIF8")):
        return None
    try:
        from PIL import Image, UnidentifiedImageError
    except ImportError as e:
        raise RuntimeError("PNG, JPEG and GIF bytes in a table need Pillow; sources.files.read_images reads such files") from e
    import io
    try:
        rgb = np.asarray(Image.open(io.BytesIO(content)).convert("RGB"))
    except (UnidentifiedImageError, OSError):
        return None
    return rgb.shape[0], rgb.shape[1], rgb[:, :, ::-1].tobytes() if pixels else None


def _decode_bitmap(content: bytes, pixels: bool) -> tuple[int, int, bytes | None] | None:
    if len(content) < 54:
        return None
    start, = struct.unpack_from("<I", content, 10)
    width, rows, planes, bits, packing = struct.unpack_from("<iiHHI", content, 18)
    height, depth = abs(rows), bits // 8
    stride = -(-width * depth // 4) * 4
    if width <= 0 or height == 0 or planes != 1 or bits not in (24, 32) or packing or len(content) < start + stride * height:
        return None
    if not pixels:
        return height, width, None
    a = np.frombuffer(content, np.uint8, stride * height, start).reshape(height, stride)
    a = a[:, :width * depth].reshape(height, width, depth)[:, :, :3]
    return height, width, (a[::-1] if rows > 0 else a).tobytes()
