"""Format and size of an image by its header: PNG, GIF, JPEG, WebP in its three forms, AVIF.

Only headers are read, by fixed offsets or a walk of segments and boxes that never goes past its bytes; no picture is decoded. Defined cases:
null, empty and unknown bytes have no format; a header that is cut off or contradicts itself has a format and no size. AVIF's size
is that of its primary item as it is stored, before a rotation; where the file names no primary item, that of its largest picture.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

Size = tuple[int, int] | None


def _png(data: bytes) -> Size:
    return struct.unpack_from(">II", data, 16) if len(data) >= 24 else None


def _gif(data: bytes) -> Size:
    return struct.unpack_from("<HH", data, 6) if len(data) >= 10 else None


def _jpeg(data: bytes) -> Size:
    """The first frame header; markers may be filled up with 0xFF, and some stand without a length."""
    at = 2
    while at + 1 < len(data) and data[at] == 0xFF:
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
        elif kind == 0x01 or 0xD0 <= kind <= 0xD7:
            at += 2
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            if at + 9 > len(data):
                return None
            height, width = struct.unpack_from(">HH", data, at + 5)
            return width, height
        else:
            length = int.from_bytes(data[at + 2 : at + 4], "big")
            if length < 2:
                return None
            at += 2 + length
    return None


def _webp(data: bytes) -> Size:
    """Extended, lossy and lossless files, by their first chunk."""
    kind = data[12:16]
    if kind == b"VP8X" and len(data) >= 30:
        return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
    if kind == b"VP8 " and len(data) >= 30 and not data[20] & 1 and data[23:26] == b"\x9d\x01\x2a":
        width, height = struct.unpack_from("<HH", data, 26)
        return width & 0x3FFF, height & 0x3FFF
    if kind == b"VP8L" and len(data) >= 25 and data[20] == 0x2F:
        bits = int.from_bytes(data[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    return None


def _boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, first byte, end) of the boxes side by side in a span; one that does not fit in it ends the walk."""
    while at + 8 <= end:
        size, head = int.from_bytes(data[at : at + 4], "big"), 8
        if size == 1 and at + 16 <= end:
            size, head = int.from_bytes(data[at + 8 : at + 16], "big"), 16
        stop = end if size == 0 else at + size
        if stop > end or stop < at + head:
            return
        yield data[at + 4 : at + 8], at + head, stop
        at = stop


def _inside(data: bytes, span: tuple[int, int] | None, skip: int = 0) -> dict[bytes, tuple[int, int]]:
    """The first box of each kind in a span, behind ``skip`` bytes of its own."""
    found: dict[bytes, tuple[int, int]] = {}
    for kind, at, end in _boxes(data, span[0] + skip, span[1]) if span else ():
        found.setdefault(kind, (at, end))
    return found


def _associated(data: bytes, span: tuple[int, int], item: int) -> list[int]:
    """Places in the list of properties that belong to an item."""
    at, end = span
    version, wide = data[at], data[at + 3] & 1
    n_items, at = int.from_bytes(data[at + 4 : at + 8], "big"), at + 8
    id_bytes, width = (4 if version else 2), 2 if wide else 1
    for _ in range(n_items):
        if at + id_bytes + 1 > end:
            break
        own, n = int.from_bytes(data[at : at + id_bytes], "big"), data[at + id_bytes]
        at += id_bytes + 1
        if own == item:
            places = [int.from_bytes(data[k : k + width], "big") for k in range(at, min(at + n * width, end - width + 1), width)]
            return [p & (0x7FFF if wide else 0x7F) for p in places]
        at += n * width
    return []


def _avif(data: bytes) -> Size:
    meta = _inside(data, (0, len(data))).get(b"meta")
    parts = _inside(data, meta, 4)
    properties = _inside(data, parts.get(b"iprp"))
    kept = list(_boxes(data, *properties[b"ipco"])) if b"ipco" in properties else []
    sizes = {k: struct.unpack_from(">II", data, at + 4) for k, (kind, at, end) in enumerate(kept, 1) if kind == b"ispe" and end - at >= 12}
    primary, owned = parts.get(b"pitm"), properties.get(b"ipma")
    if primary and owned and primary[1] - primary[0] >= 6 and owned[1] - owned[0] >= 8:
        item = int.from_bytes(data[primary[0] + 4 : primary[0] + (8 if data[primary[0]] else 6)], "big")
        for place in _associated(data, owned, item):
            if place in sizes:
                return sizes[place]
    return max(sizes.values(), key=lambda s: s[0] * s[1], default=None)


def _format(data: bytes) -> tuple[str | None, Size]:
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return "png", _png(data)
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return "gif", _gif(data)
    if data[:2] == b"\xff\xd8":
        return "jpeg", _jpeg(data)
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        return "webp", _webp(data)
    if data[4:8] == b"ftyp":
        end = min(int.from_bytes(data[:4], "big"), len(data))
        brands = {data[8:12], *(data[k : k + 4] for k in range(16, end - 3, 4))}
        if brands & {b"avif", b"avis"}:
            return "avif", _avif(data)
    return None, None


def image_size(data: bytes | None) -> dict:
    kind, size = _format(data or b"")
    fits = size is not None and all(0 < n < 1 << 31 for n in size)
    return {"format": kind, "width": size[0] if fits else None, "height": size[1] if fits else None}
