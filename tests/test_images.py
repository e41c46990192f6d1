import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from folio.functions.images import aspect_ratio, is_valid_geometry, read_size, with_image_size


def chunk(name, data):
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def png(width, height, before=b""):
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
    return b"\x89PNG\r\n\x1a\n" + head + before + chunk(b"IDAT", b"pixels") + chunk(b"IEND", b"")


def jpeg(width, height, before=b"", sof=0xC0, bits=8, layers=3):
    frame = b"\xff" + bytes([sof]) + struct.pack(">HBHHB", 17, bits, height, width, layers) + bytes(9)
    return b"\xff\xd8" + before + frame + b"\xff\xda" + struct.pack(">H", 12) + bytes(10) + b"pixels"


def segment(size, marker=0xE1):
    return b"\xff" + bytes([marker]) + struct.pack(">H", size + 2) + b"\xff\xc0" * (size // 2)


def gif(width, height, table=False, extension=False, frame=None):
    out = b"GIF89a" + struct.pack("<HHBBB", width, height, 0x81 if table else 0, 0, 0) + bytes(12 if table else 0)
    out += b"\x21\xf9\x04\x00\x00\x00\x00\x00" if extension else b""
    return out + b"\x2c" + struct.pack("<HHHHB", 0, 0, *(frame or (width, height)), 0)


def bmp(width, height, header=40, bits=24):
    return b"BM" + bytes(12) + struct.pack("<IiiHH", header, width, height, 1, bits) + bytes(24)


def webp(kind, payload):
    body = b"WEBP" + kind + struct.pack("<I", len(payload)) + payload
    return b"RIFF" + struct.pack("<I", len(body)) + body


GOOD = {
    "png": (png(180, 260), 180, 260),
    "png with text first": (png(180, 260, chunk(b"tEXt", b"k" * 50_000)), 180, 260),
    "jpeg": (jpeg(300, 451), 300, 451),
    "progressive jpeg": (jpeg(300, 451, sof=0xC2), 300, 451),
    "jpeg with huffman table first": (jpeg(300, 451, segment(20, 0xC4)), 300, 451),
    "jpeg with long head": (jpeg(300, 451, segment(40_000) + segment(60_000)), 300, 451),
    "padded jpeg": (jpeg(300, 451, b"\xff\xff" + segment(4)[1:]), 300, 451),
    "gif": (gif(120, 200), 120, 200),
    "gif with table and extension": (gif(120, 200, True, True), 120, 200),
    "gif with larger frame": (gif(10, 20, frame=(120, 200)), 120, 200),
    "bmp": (bmp(110, 170), 110, 170),
    "bmp top down": (bmp(110, -170), 110, 170),
    "webp extended": (webp(b"VP8X", bytes(4) + (199).to_bytes(3, "little") + (299).to_bytes(3, "little")), 200, 300),
    "webp lossless": (webp(b"VP8L", b"\x2f" + (199 | 299 << 14).to_bytes(4, "little")), 200, 300),
    "webp lossy": (webp(b"VP8 ", bytes(6) + struct.pack("<HH", 200, 300)), 200, 300),
    "bmp of the first kind": (b"BM" + bytes(12) + struct.pack("<IHHHH", 12, 110, 170, 1, 24), 110, 170),
    "gray jpeg": (jpeg(300, 451, layers=1), 300, 451),
    "largest png": (png(178_956_970 // 2, 2), 178_956_970 // 2, 2),
    "cut off after the header": (jpeg(300, 451)[:-6], 300, 451),
}
BAD = {
    "junk": b"this is no image",
    "empty": b"",
    "signature only": png(180, 260)[:10],
    "header cut": jpeg(300, 451)[:20],
    "wrong checksum": png(180, 260).replace(b"\x08\x02\x00\x00\x00", b"\x08\x06\x00\x00\x00", 1),
    "no scan": jpeg(300, 451, segment(40_000))[:-25],
    "end before the frame": b"\xff\xd8\xff\xd9" + bytes(40),
    "gif without frame": gif(120, 200)[:13] + b"\x3b",
    "too many pixels": png(178_956_971, 1),
    "jpeg of 12 bits": jpeg(300, 451, bits=12),
    "jpeg of two layers": jpeg(300, 451, layers=2),
    "bmp of unknown header": bmp(110, 170, header=41),
    "bmp of odd depth": bmp(110, 170, bits=7),
    "webp cut off": webp(b"VP8L", b"\x2f" + bytes(40))[:-4],
    "webp of unknown kind": webp(b"ABCD", bytes(30)),
}


@pytest.mark.parametrize("name", GOOD)
def test_read_size(name):
    data, width, height = GOOD[name]
    assert read_size(data) == (width, height)


def test_probe(spark):
    rows = [(name, data) for name, (data, *_) in GOOD.items()] + list(BAD.items()) + [("null", None)]
    probed = with_image_size(spark.createDataFrame(rows, "id string, content binary"))
    got = {row.id: (row.width, row.height) for row in probed.collect()}
    want = {name: (width, height) for name, (_, width, height) in GOOD.items()}
    assert got == {**want, **{name: (None, None) for name in [*BAD, "null"]}}


def extended_gif(blocks, frame=True):
    """A GIF with an extension of that many sub-blocks before its frame."""
    data = gif(120, 200)
    extension = b"\x21\xfe" + b"".join(bytes([9]) + b"123456789" for _ in range(blocks)) + b"\x00"
    return data[:13] + extension + (data[13:] if frame else b"")


def test_native_sizes_are_those_of_the_reader(spark):
    rng = random.Random(8)
    images = [data for data, *_ in GOOD.values()] + list(BAD.values()) + [extended_gif(5), extended_gif(1000), extended_gif(3, frame=False)]
    images += [png(3, 4, b"".join(chunk(b"tEXt", b"k") for _ in range(n))) for n in (3, 600)]
    images += [png(3, 4, chunk(b"a\x01bc", b"")), png(3, 4, chunk(b"zzZZ", b""))]
    for data in list(images):
        for _ in range(25):  # cut off, or with a byte changed
            changed = bytearray(data[: rng.randint(0, min(len(data), 90))] if rng.random() < 0.5 else data[:400])
            if changed and rng.random() < 0.7:
                changed[rng.randrange(min(len(changed), 60))] = rng.randrange(256)
            images.append(bytes(changed))
    rows = with_image_size(spark.createDataFrame(list(enumerate(images)), "id int, content binary")).collect()
    got = {row.id: (row.width, row.height) for row in rows}
    want = {k: read_size(data) or (None, None) for k, data in enumerate(images)}
    assert {k: (images[k][:60], got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_only_jpeg_goes_through_python(spark, monkeypatch):
    kind = type(spark.range(0))
    data = [d for d, *_ in GOOD.values()] + list(BAD.values())
    sent = []
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, *a, **k: (sent.append(df), real(df, *a, **k))[1])
    with_image_size(spark.createDataFrame(list(enumerate(data)), "id int, content binary"))
    bodies = [bytes(row.content) for row in sent[0].where("content IS NOT NULL").collect()]
    assert bodies and all(body.startswith(b"\xff\xd8\xff") for body in bodies)


GEOMETRY = {
    (100, 150): True,
    (99, 150): False,
    (100, 149): False,
    (180, 150): True,
    (181, 150): False,
    (100, 5000): True,
    (None, 200): False,
    (200, None): False,
    (0, 0): False,
}


def test_geometry(spark):
    df = spark.createDataFrame(list(GEOMETRY), "w int, h int")
    rows = df.select("w", "h", is_valid_geometry(F.col("w"), F.col("h")).alias("ok"), aspect_ratio(F.col("w"), F.col("h")).alias("r")).collect()
    assert {(row.w, row.h): row.ok for row in rows} == GEOMETRY
    assert {row.r for row in rows if (row.w, row.h) in [(180, 150), (0, 0)]} == {1.2, None}
