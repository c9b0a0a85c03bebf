"""Zstandard frames seen from outside: where they begin, and their pieces one block at a time.

A frame is a header and blocks; a block's header names its length, so frames can be found without decompressing, and a
decompressor can be fed one block at a time. A block holds 128 KiB at most, so that bounds what one step gives, whatever
the file claims.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

# Fixed values of the format (RFC 8878).
MAGIC = 0xFD2FB528
SKIPPABLE = 0x184D2A50  # to ...5F
BLOCK_MOST = 128 * 1024
GZIP = b"\x1f\x8b"


class FrameError(OSError):
    """Not what the format allows."""


def is_frame(head: bytes) -> bool:
    magic = int.from_bytes(head[:4], "little")
    return len(head) >= 4 and (magic == MAGIC or magic & ~0xF == SKIPPABLE)


def _exact(read: Callable[[int], bytes], n: int) -> bytes:
    parts = []
    while n and (part := read(n)):
        parts.append(part)
        n -= len(part)
    if n:
        raise EOFError("file ends inside a frame")
    return b"".join(parts)


def _header(read: Callable[[int], bytes]) -> tuple[bytes, bool]:
    """What follows the magic number up to the first block, and whether a checksum ends the frame."""
    flags = _exact(read, 1)
    code = flags[0]
    if code & 8:
        raise FrameError("reserved bit in a frame header")
    single = code >> 5 & 1
    size = (0 if single else 1) + (0, 1, 2, 4)[code & 3] + (single, 2, 4, 8)[code >> 6]
    return flags + _exact(read, size), bool(code >> 2 & 1)


def _block(read: Callable[[int], bytes]) -> tuple[bytes, int, bool]:
    """A block's header, the length of what follows it, and whether it is the last."""
    head = _exact(read, 3)
    value = int.from_bytes(head, "little")
    kind, size = value >> 1 & 3, value >> 3
    if kind == 3 or size > BLOCK_MOST:
        raise FrameError("block of an unknown kind or length")
    return head, 1 if kind == 1 else size, bool(value & 1)


def pieces(read: Callable[[int], bytes], at: int = 0) -> Iterator[tuple[int, bool, bytes]]:
    """(place of the frame, whether the piece begins it, bytes) of all frames from the place `at` on, where `read` is.

    Skippable frames give nothing. Raises where the file breaks off or is no sequence of frames.
    """
    while head := read(4):
        if len(head) < 4:
            head += _exact(read, 4 - len(head))
        frame, magic = at, int.from_bytes(head, "little")
        if magic & ~0xF == SKIPPABLE:
            size = int.from_bytes(_exact(read, 4), "little")
            at += 8 + size
            while size:
                part = _exact(read, min(size, BLOCK_MOST))
                size -= len(part)
            continue
        if magic != MAGIC:
            raise FrameError("no frame where one should begin")
        rest, has_sum = _header(read)
        yield frame, True, head + rest
        at += 4 + len(rest)
        last = False
        while not last:
            head, size, last = _block(read)
            body = _exact(read, size + 4 * (last and has_sum))
            yield frame, False, head + body
            at += len(head) + len(body)


def starts(file) -> list[int]:
    """Places of all frames of a seekable file, skippable ones left out. Only headers are read."""
    out, at, end = [], 0, file.size()
    read = file.read
    while at < end:
        file.seek(at)
        head = _exact(read, 4)
        magic = int.from_bytes(head, "little")
        if magic & ~0xF == SKIPPABLE:
            at += 8 + int.from_bytes(_exact(read, 4), "little")
            continue
        if magic != MAGIC:
            raise FrameError("no frame where one should begin")
        rest, has_sum = _header(read)
        out.append(at)
        at += 4 + len(rest)
        last = False
        while not last:
            file.seek(at)
            _, size, last = _block(read)
            at += 3 + size
        at += 4 * has_sum
    if at > end:
        raise EOFError("file ends inside a frame")
    return out


def runs(places: list[int], size: int, least: int) -> list[tuple[int, int]]:
    """Neighbouring frames put together to runs of `least` bytes or more: (begin, end)."""
    out = []
    for place in places[1:]:
        begin = out[-1][1] if out else 0
        if place - begin >= least:
            out.append((begin, place))
    return [*out, (out[-1][1] if out else 0, size)]
