"""What the first bytes of a picture say."""

from __future__ import annotations

import struct


def image_type(data: bytes) -> str:
    """Media type by the first bytes."""
    # How files of these kinds begin.
    heads = ((b"\x89PNG", "image/png"), (b"\xff\xd8\xff", "image/jpeg"), (b"GIF8", "image/gif"), (b"BM", "image/bmp"), (b"II*\x00", "image/tiff"), (b"MM\x00*", "image/tiff"))
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        return "image/webp"
    return next((kind for head, kind in heads if data.startswith(head)), "application/octet-stream")


def image_size(data: bytes | None) -> list[int] | None:
    """Width and height of a PNG, GIF, BMP or JPEG by its head; none where they can't be told."""
    kind, whole = image_type(bytes(data or b"")), bytes(data or b"")
    try:
        if kind == "image/png":
            size = struct.unpack(">II", whole[16:24])
        elif kind == "image/gif":
            size = struct.unpack("<HH", whole[6:10])
        elif kind == "image/bmp":
            size = tuple(map(abs, struct.unpack("<ii", whole[18:26])))
        elif kind == "image/jpeg":
            at = 2
            while not (whole[at] == 0xFF and 0xC0 <= whole[at + 1] <= 0xCF and whole[at + 1] not in (0xC4, 0xC8, 0xCC)):
                at += 2 + struct.unpack(">H", whole[at + 2 : at + 4])[0] if whole[at] == 0xFF and whole[at + 1] != 0xFF else 1
            size = struct.unpack(">HH", whole[at + 5 : at + 9])[::-1]
        else:
            return None
    except (struct.error, IndexError):
        return None
    return list(size) if min(size) > 0 else None
