"""Image sizes by expressions over the bytes, for the formats whose headers are walked in few steps.

PNG and GIF are walked block by block, ``STEPS`` blocks at most; an image that needs more is not settled here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 16
# How a walk stands: under way, at what it looked for, or at an end that makes the image unreadable.
_WALKING, _FOUND, _LOST = 0, 1, 2


def _number(data: Column, at: Column | int, size: int, little: bool = False) -> Column:
    """The whole number of ``size`` bytes at a place counted from 0."""
    begin = (at if isinstance(at, Column) else F.lit(at)).cast("int") + 1
    if little:
        text = F.concat(*[F.hex(F.substring(data, begin + k, F.lit(1))) for k in reversed(range(size))])
    else:
        text = F.hex(F.substring(data, begin, F.lit(size)))
    return F.conv(text, 16, 10).cast("long")


def _signed(value: Column) -> Column:
    return F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value)


def _size(width: Column, height: Column) -> Column:
    return F.struct(width.cast("long").alias("width"), height.cast("long").alias("height"))


def _none() -> Column:
    return F.lit(None).cast("struct<width: bigint, height: bigint>")


def _walk(first: Column | int, step: Callable[[Column], Column]) -> Column:
    """``at, inside, state`` after the steps; a step gives the next such struct of one under way."""
    begin = F.struct((first if isinstance(first, Column) else F.lit(first)).cast("long").alias("at"), F.lit(False).alias("inside"), F.lit(_WALKING).alias("state"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), begin, lambda s, _: F.when(s["state"] != _WALKING, s).otherwise(step(s)))


def _stand(at: Column, state: int, inside: bool = False) -> Column:
    return F.struct(at.cast("long").alias("at"), F.lit(inside).alias("inside"), F.lit(state).alias("state"))


def png_size(data: Column) -> tuple[Column, Column]:
    """Size, null for an unreadable image; and whether the walk came to its end. Chunks are walked up to the pixels."""
    length = F.length(data)
    head = (length >= 33) & (F.hex(F.substring(data, 13, 4)) == "49484452") & (F.crc32(F.substring(data, 13, 17)) == _number(data, 29, 4))

    def step(s: Column) -> Column:
        at = s["at"]
        name = F.hex(F.substring(data, (at + 5).cast("int"), F.lit(4)))
        return (
            F.when(at + 8 > length, _stand(at, _LOST))
            .when(name == "49444154", _stand(at, _FOUND))
            .when(~name.rlike("^(?:[46][1-9A-F]|[57][0-9A]){4}$"), _stand(at, _LOST))
            .otherwise(_stand(at + 12 + _number(data, at, 4), _WALKING))
        )

    state = F.when(head, _walk(33, step)["state"]).otherwise(_LOST)
    return F.when(state == _FOUND, _size(_number(data, 16, 4), _number(data, 20, 4))), state != _WALKING


def gif_size(data: Column) -> tuple[Column, Column]:
    """The same; blocks are walked up to the first frame, which may reach beyond the screen."""
    length = F.length(data)
    flags = _number(data, 10, 1)
    colours = F.when(flags.bitwiseAND(F.lit(0x80)) != 0, F.call_function("shiftleft", F.lit(6), flags.bitwiseAND(F.lit(7)).cast("int"))).otherwise(0)

    def step(s: Column) -> Column:
        at = s["at"]
        here = _number(data, at, 1)
        return (
            F.when(at >= length, _stand(at, _LOST))
            .when(s["inside"] & (here == 0), _stand(at + 1, _WALKING))
            .when(s["inside"], _stand(at + 1 + here, _WALKING, inside=True))
            .when(here == 0x2C, F.when(at + 9 > length, _stand(at, _LOST)).otherwise(_stand(at, _FOUND)))
            .when(here == 0x3B, _stand(at, _LOST))
            .when(here == 0x21, _stand(at + 2, _WALKING, inside=True))
            .otherwise(_stand(at + 1, _WALKING))
        )

    walked = F.when(length >= 11, _walk(13 + colours, step)).otherwise(_stand(F.lit(0), _LOST))

    def reach(screen: int, offset: int) -> Column:
        frame = walked["at"] + 1 + offset
        return F.greatest(_number(data, screen, 2, True), _number(data, frame, 2, True) + _number(data, frame + 4, 2, True))

    return F.when(walked["state"] == _FOUND, _size(reach(6, 0), reach(8, 2))), walked["state"] != _WALKING


def bmp_size(data: Column, headers: tuple[int, ...], depths: tuple[int, ...]) -> Column:
    length, header = F.length(data), _number(data, 14, 4, True)
    old = header == 12
    width = F.when(old, _number(data, 18, 2, True)).otherwise(_signed(_number(data, 18, 4, True)))
    height = F.when(old, _number(data, 20, 2, True)).otherwise(F.abs(_signed(_number(data, 22, 4, True))))
    bits = F.when(old, _number(data, 24, 2, True)).otherwise(_number(data, 28, 2, True))
    whole = (length >= 18) & (length >= F.when(old, 26).otherwise(30))
    return F.when(whole & header.isin(*headers) & bits.isin(*depths), _size(width, height))


def webp_size(data: Column) -> Column:
    length, size, part = F.length(data), _number(data, 4, 4, True), _number(data, 16, 4, True)
    kind = F.hex(F.substring(data, 13, 4))
    whole = (length >= 20) & (length >= size + 8) & (length >= part + 20)
    bits = _number(data, 21, 4, True)
    low = F.lit(0x3FFF)
    return F.when(
        whole,
        F.when((kind == "56503858") & (length >= 30), _size(_number(data, 24, 3, True) + 1, _number(data, 27, 3, True) + 1))
        .when((kind == "5650384C") & (length >= 25), _size(bits.bitwiseAND(low) + 1, F.shiftright(bits, 14).bitwiseAND(low) + 1))
        .when(
            (kind == "56503820") & (length >= 30),
            _size(_number(data, 26, 2, True).bitwiseAND(low), _number(data, 28, 2, True).bitwiseAND(low)),
        ),
    )
