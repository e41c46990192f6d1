"""Image header probe and cover geometry."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.headers import bmp_size, gif_size, png_size, webp_size

# Smallest width and height, and the widest aspect of a cover.
MIN_WIDTH = 100
MIN_HEIGHT = 150
MAX_RATIO = 1.2

# What an image must be for it to be opened at all.
MAX_PIXELS = 178_956_970
JPEG_BITS = 8
JPEG_LAYERS = (1, 3, 4)
BMP_HEADERS = (12, 40, 52, 56, 64, 108, 124)
BMP_BITS = (1, 4, 8, 16, 24, 32)

def sniff_format(content: Column) -> Column:
    """Image format by leading bytes, whatever the file is called."""
    lead = F.hex(F.substring(content, 1, 12))
    return (
        F.when(lead.startswith("89504E470D0A1A0A"), "png")
        .when(lead.startswith("FFD8FF"), "jpeg")
        .when(lead.startswith("474946383761") | lead.startswith("474946383961"), "gif")
        .when(lead.rlike("^52494646.{8}57454250$"), "webp")
        .when(lead.startswith("424D"), "bmp")
    )


def _take(data: memoryview, at: int, size: int) -> memoryview:
    if at + size > len(data):
        raise EOFError("the image ends before its header does")
    return data[at : at + size]


def _png(data: memoryview):
    header = _take(data, 8, 25)
    if header[4:8] != b"IHDR" or zlib.crc32(header[4:21]) != struct.unpack(">I", header[21:25])[0]:
        return None
    at = 33
    while True:  # the header part ends where pixel data begins
        size, name = struct.unpack(">I4s", _take(data, at, 8))
        if name == b"IDAT":
            return struct.unpack(">II", header[8:16])
        if not bytes(name).isalpha():
            return None
        at += size + 12


def _jpeg(data: memoryview):
    at, size = 2, None
    while True:
        if _take(data, at, 1) != b"\xff":
            at += 1
            continue
        marker = _take(data, at + 1, 1)[0]
        if marker == 0xFF:
            at += 1
        elif marker == 0xDA:  # scan start: the header is complete
            return size
        elif marker in (0x00, 0x01) or 0xD0 <= marker <= 0xD8:  # no payload
            at += 2
        elif marker == 0xD9:
            return None
        else:
            length = struct.unpack(">H", _take(data, at + 2, 2))[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                bits, height, width, layers = struct.unpack(">BHHB", _take(data, at + 4, 6))
                if bits != JPEG_BITS or layers not in JPEG_LAYERS:
                    return None
                size = (width, height)
            at += 2 + length


def _gif(data: memoryview):
    width, height, flags = struct.unpack("<HHB", _take(data, 6, 5))
    at = 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)
    while True:
        block = _take(data, at, 1)[0]
        if block == 0x2C:  # the first frame may reach beyond the screen
            left, top, wide, high = struct.unpack("<HHHH", _take(data, at + 1, 8))
            return max(width, left + wide), max(height, top + high)
        if block == 0x3B:
            return None
        if block != 0x21:
            at += 1
            continue
        at += 2
        while length := _take(data, at, 1)[0]:
            at += 1 + length
        at += 1


def _bmp(data: memoryview):
    header = struct.unpack("<I", _take(data, 14, 4))[0]
    if header not in BMP_HEADERS:
        return None
    width, height, _, bits = struct.unpack("<HHHH" if header == 12 else "<iiHH", _take(data, 18, 8 if header == 12 else 12))
    return (width, abs(height)) if bits in BMP_BITS else None


def _webp(data: memoryview):
    size, _, kind, length = struct.unpack("<I4s4sI", _take(data, 4, 16))
    _take(data, 8, size)  # the file must be whole
    _take(data, 20, length)
    if kind == b"VP8X":
        raw = _take(data, 24, 6)
        return int.from_bytes(raw[:3], "little") + 1, int.from_bytes(raw[3:], "little") + 1
    if kind == b"VP8L":
        bits = int.from_bytes(_take(data, 21, 4), "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 ":
        width, height = struct.unpack("<HH", _take(data, 26, 4))
        return width & 0x3FFF, height & 0x3FFF
    return None


def read_size(data: bytes | memoryview) -> tuple[int, int] | None:
    """Width and height by the header, or None when the image cannot be opened."""
    data = memoryview(data).cast("B")
    if data[:3] == b"\xff\xd8\xff":
        reader = _jpeg
    elif data[:8] == b"\x89PNG\r\n\x1a\n":
        reader = _png
    elif data[:6] in (b"GIF87a", b"GIF89a"):
        reader = _gif
    elif data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        reader = _webp
    elif data[:2] == b"BM":
        reader = _bmp
    else:
        return None
    try:
        size = reader(data)
    except EOFError:
        return None
    return size if size and size[0] * size[1] <= MAX_PIXELS and max(size) < 2**31 else None


def _read_sizes(content: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Buffers are looked into in place; image bytes are not copied.
            sizes = [
                (None if image.as_buffer() is None else read_size(image.as_buffer())) or (None, None)
                for image in batch.column(content)
            ]
            for at, name in enumerate(("_width", "_height")):
                batch = batch.append_column(name, pa.array([size[at] for size in sizes], pa.int32()))
            yield batch.drop_columns([content])

    return run


def with_image_size(images: DataFrame, content: str = "content") -> DataFrame:
    """Replace ``content`` by ``format``, ``width``, ``height``; null width and height mean unreadable.

    Sizes are read by expressions where the header is in a fixed place or a walk of few steps. Only the bytes of JPEG images,
    and of those whose walk is longer, are streamed through Python, and none come back.
    """
    kept = [field for field in images.schema.fields if field.name != content]
    names = [field.name for field in kept]
    body, kind = F.col(content), F.col("format")
    (png, png_done), (gif, gif_done) = png_size(body), gif_size(body)
    native = F.when(kind == "png", png).when(kind == "gif", gif).when(kind == "bmp", bmp_size(body, BMP_HEADERS, BMP_BITS)).when(kind == "webp", webp_size(body))
    settled = F.when(kind == "png", png_done).when(kind == "gif", gif_done).otherwise(kind != "jpeg")
    known = images.withColumn("format", sniff_format(body)).select(*names, "format", native.alias("_size"), F.when(~settled, body).alias(content))
    limit = (F.col("_size.width") * F.col("_size.height") <= MAX_PIXELS) & (F.greatest("_size.width", "_size.height") < 1 << 31)
    asked = known.select(*names, "format", *[F.when(limit, F.col(f"_size.{x}")).cast("int").alias(x) for x in ("width", "height")], content)
    added = [T.StructField("format", T.StringType()), *[T.StructField(x, T.IntegerType()) for x in ("width", "height", "_width", "_height")]]
    read = asked.mapInArrow(_read_sizes(content), T.StructType([*kept, *added]))
    return read.select(*names, "format", *[F.coalesce(x, F.col(f"_{x}")).alias(x) for x in ("width", "height")])


def aspect_ratio(width: Column, height: Column) -> Column:
    return width.cast("double") / F.nullif(height, F.lit(0))


def is_too_small(width: Column, height: Column) -> Column:
    return (width < MIN_WIDTH) | (height < MIN_HEIGHT)


def is_too_wide(width: Column, height: Column) -> Column:
    return aspect_ratio(width, height) > F.lit(MAX_RATIO)


def is_valid_geometry(width: Column, height: Column) -> Column:
    """False for unreadable, too small or too wide images."""
    return F.coalesce(~is_too_small(width, height) & ~is_too_wide(width, height), F.lit(False))
