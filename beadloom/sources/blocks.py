"""Blocks of a BAM file: a series of small compressed members, each with its own length in its head, after the published format.

A place in the uncompressed data is a virtual offset, the file offset of its block << 16 | the place in the block. As any
block can be unpacked alone, a file can be read from any place where a block begins, and such a place can be found from
anywhere.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

# The empty block that ends a file, and the longest block.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
LONGEST = 1 << 16
_HEAD = struct.Struct("<BBBBIBBH")


def pack(data: bytes, level: int = 6) -> bytes:
    """A block of up to 60 KB."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = z.compress(data) + z.flush()
    return struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(data), len(data))


def head(data: bytes, at: int) -> tuple[int, int] | None:
    """(bytes of the head, bytes of the whole block) of a block at a place, or None if there is none."""
    if at + 18 > len(data):
        return None
    a, b, method, flags, _, _, _, extra = _HEAD.unpack_from(data, at)
    if (a, b, method, flags) != (31, 139, 8, 4):
        return None
    i, stop = at + 12, min(at + 12 + extra, len(data))
    while i + 4 <= stop:
        key, size = data[i : i + 2], int.from_bytes(data[i + 2 : i + 4], "little")
        if key == b"BC" and size == 2 and i + 6 <= len(data):
            whole = int.from_bytes(data[i + 4 : i + 6], "little") + 1
            return (12 + extra, whole) if whole >= 12 + extra + 8 else None
        i += 4 + size
    return None


def unpack(data: bytes, at: int, size: tuple[int, int]) -> bytes:
    """The content of a block; an error if it isn't what its checksum says."""
    skip, whole = size
    out = zlib.decompress(data[at + skip : at + whole - 8], -15)
    crc, length = struct.unpack_from("<II", data, at + whole - 8)
    if len(out) != length or zlib.crc32(out) != crc:
        raise ValueError("damaged block")
    return out


def find(f, start: int, stop: int) -> int | None:
    """The first place from `start` on and before `stop` where a block begins, surely: its content has the checksum that its
    end names, and another block, or the end of the file, follows."""
    f.seek(start)
    data = f.read(min(stop - start, LONGEST) + 2 * LONGEST + 64)
    whole = len(data) < min(stop - start, LONGEST) + 2 * LONGEST + 64
    at = data.find(b"\x1f\x8b\x08\x04")
    while 0 <= at < stop - start:
        size = head(data, at)
        if size and at + size[1] <= len(data):
            behind = at + size[1]
            if head(data, behind) or (whole and behind == len(data)):
                try:
                    unpack(data, at, size)
                    return start + at
                except (ValueError, zlib.error):
                    pass
        at = data.find(b"\x1f\x8b\x08\x04", at + 1)
    return None if stop - start <= LONGEST or whole else find(f, start + LONGEST, stop)


def read(f, start: int, buffer: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(file offset, content) of the blocks from a place on, to the file's end."""
    f.seek(start)
    data, at = f.read(buffer), 0
    while True:
        size = head(data, at)
        if size is None or at + size[1] > len(data):
            more = f.read(buffer)
            if not more:
                if at < len(data):
                    raise ValueError("block is cut short")
                return
            data, start, at = data[at:] + more, start + at, 0
            continue
        yield start + at, unpack(data, at, size)
        at += size[1]
