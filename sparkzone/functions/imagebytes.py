"""Sizes of images from their bytes, as column expressions: nothing is decoded and no Python runs.

PNG, JPEG, BMP and GIF say their size near the start. A file counts as readable if that part is
whole and the file ends as its kind does (a PNG's last chunk, a JPEG's end mark, a BMP's last row of pixels); damage
within the pixels isn't seen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The bytes files begin and end with, in hex.
PNG_START, PNG_HEADER, PNG_END = "89504E470D0A1A0A", "49484452", "49454E44AE426082"
JPEG_START, JPEG_END, BMP_START, GIF_START = "FFD8FF", "FFD9", "424D", "47494638"
# JPEG marks that carry the size, and marks without a length.
JPEG_SIZES = "C0 C1 C2 C3 C5 C6 C7 C9 CA CB CD CE CF".split()
JPEG_BARE = "01 D0 D1 D2 D3 D4 D5 D6 D7 D8".split()
JPEG_SCAN = "DA"
# Bytes at the end in which the end mark is looked for, and JPEG segments before the one with the size, at most.
TAIL, SEGMENTS = 1024, 1024


def hex_at(content: Column, at, n: int) -> Column:
    """``n`` bytes from place ``at`` (from 1), in hex; fewer where the content ends."""
    return F.hex(F.substring(content, F.lit(at) if isinstance(at, int) else at, F.lit(n)))


def number_at(content: Column, at, n: int, little: bool = False) -> Column:
    """A whole number without sign; null where the content ends before it."""
    digits = hex_at(content, at, n)
    if little:
        digits = F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(n))])
    return F.when(F.length(digits) == 2 * n, F.conv(digits, 16, 10).cast("long"))


def _ends_with(content: Column, mark: str) -> Column:
    tail = F.hex(F.substring(content, F.greatest(F.lit(1), F.octet_length(content) - TAIL + 1), F.lit(TAIL)))
    place = F.instr(tail, mark)
    # At a whole byte.
    return (place > 0) & ((place % 2 == 1) | (F.locate(mark, tail, 2) > 0))


def _facts(width: Column, height: Column, channels: Column) -> Column:
    return F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"), channels.cast("int").alias("channels"))


def _png(c: Column) -> Column:
    kind = number_at(c, 26, 1)
    sound = (hex_at(c, 13, 4) == PNG_HEADER) & (F.crc32(F.substring(c, 13, 17)) == number_at(c, 30, 4)) & _ends_with(c, PNG_END)
    channels = F.when(kind.isin(0, 4), 1).when(kind.isin(2, 3), 3).when(kind == 6, 4)
    return F.when(sound, _facts(number_at(c, 17, 4), number_at(c, 21, 4), channels))


def _jpeg(c: Column) -> Column:
    """Segment by segment to the one that has the size."""
    start = F.struct(F.lit(3).cast("long").alias("at"), F.lit(True).alias("on"), F.lit(None).cast("long").alias("found"))

    def step(s: Column, _: Column) -> Column:
        at, none = s["at"], F.lit(None).cast("long")
        move = lambda to, found: F.struct(F.coalesce(to, at).alias("at"), (to.isNotNull() & found.isNull()).alias("on"), found.alias("found"))
        after = lambda mark: F.when(mark == "FF", at + 1).when(mark.isin(JPEG_BARE), at + 2).when(mark != JPEG_SCAN, at + 2 + number_at(c, at + 2, 2))
        # Bound once, as it is asked for often.
        mark = F.array(F.when(hex_at(c, at, 1) == "FF", hex_at(c, at + 1, 1)))
        moved = F.transform(mark, lambda m: F.when(m.isin(JPEG_SIZES), move(at, at)).otherwise(move(after(m), none)))
        return F.when(s["on"], moved[0]).otherwise(s)

    # The place of the segment; its numbers are read once.
    found = F.aggregate(F.sequence(F.lit(1), F.lit(SEGMENTS)), start, step, lambda s: s["found"])
    read = F.transform(F.array(found), lambda at: _facts(number_at(c, at + 7, 2), number_at(c, at + 5, 2), F.when(hex_at(c, at + 9, 1) == "01", 1).when(hex_at(c, at + 9, 1) == "03", 3)))
    return F.when(_ends_with(c, JPEG_END), read[0])


def _bmp(c: Column) -> Column:
    old = number_at(c, 15, 4, little=True) == 12
    little = lambda at, n: number_at(c, at, n, little=True)
    signed = lambda x: F.when(x >= 1 << 31, (1 << 32) - x).otherwise(x)
    width, height = F.when(old, little(19, 2)).otherwise(little(19, 4)), F.when(old, little(21, 2)).otherwise(signed(little(23, 4)))
    bits = F.when(old, little(25, 2)).otherwise(little(29, 2))
    row = F.floor((bits * width + 31) / 32) * 4
    plain = old | (little(31, 4) == 0)
    whole = ~plain | (little(11, 4) + row * height <= F.octet_length(c))
    return F.when(whole, _facts(width, height, F.when(bits > 0, 3)))


def _gif(c: Column) -> Column:
    return _facts(number_at(c, 7, 2, little=True), number_at(c, 9, 2, little=True), F.lit(3))


def image_facts(content: Column) -> Column:
    """width, height and channels of an image; null if it isn't readable."""
    begins = lambda mark: hex_at(content, 1, len(mark) // 2) == mark
    facts = F.when(begins(PNG_START), _png(content)).when(begins(JPEG_START), _jpeg(content)).when(begins(BMP_START), _bmp(content)).when(begins(GIF_START), _gif(content))
    return facts
