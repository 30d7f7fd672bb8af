"""Patched frame-of-reference coding of arrays of unsigned 32-bit integers.

Values are cut into blocks. A block stores its minimum, and its differences from it
packed at a width that a percentile of them needs; larger differences keep their low bits in
place and have their high bits in an exception list. Block starts are indexed, so that
any range is read without decoding what is before it.

Layout, little-endian: magic, number of values, number of blocks, exceptions and payload bytes
(uint32 each); per block: minimum (uint32), width (uint8), payload start (uint32), exceptions
before it (uint32); per exception: place in the block (uint8), high bits (uint32); payload.
"""

from __future__ import annotations

import numpy as np

MAGIC = 0x524F4650
BLOCK = 256
PERCENTILE = 0.95
_HEADER = 5


def _width(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; frexp is exact for 32-bit integers."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(grid: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value, highest bit first, as a row of bytes for each block."""
    as_bytes = grid.astype(">u4").view(np.uint8).reshape(len(grid), BLOCK, 4)
    if width % 8 == 0:
        return as_bytes[:, :, 4 - width // 8 :].reshape(len(grid), -1)
    return np.packbits(np.unpackbits(as_bytes, axis=2)[:, :, 32 - width :].reshape(len(grid), -1), axis=1)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    if width % 8 == 0:
        as_bytes = np.zeros((len(packed), BLOCK, 4), np.uint8)
        as_bytes[:, :, 4 - width // 8 :] = packed.reshape(len(packed), BLOCK, width // 8)
    else:
        bits = np.zeros((len(packed), BLOCK, 32), np.uint8)
        bits[:, :, 32 - width :] = np.unpackbits(packed, axis=1).reshape(len(packed), BLOCK, width)
        as_bytes = np.packbits(bits, axis=2)
    return as_bytes.view(">u4").reshape(len(packed), BLOCK)


def encode(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, np.uint32)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.array([MAGIC, 0, 0, 0, 0], "<u4").tobytes()
    grid = np.full(blocks * BLOCK, values[-1], np.uint32)
    grid[:n] = values
    grid = grid.reshape(blocks, BLOCK)
    least = grid.min(axis=1)
    grid = grid - least[:, None]
    at = int(PERCENTILE * (BLOCK - 1))
    widths = _width(np.partition(grid, at, axis=1)[:, at])
    high = grid >> np.minimum(widths, 31)[:, None]
    high[widths == 32] = 0
    block_of, place = np.nonzero(high)
    counts = np.bincount(block_of, minlength=blocks)
    sizes = widths.astype(np.int64) * (BLOCK // 8)
    starts = np.cumsum(sizes) - sizes
    payload = np.zeros(int(sizes.sum()), np.uint8)
    for width in np.unique(widths):
        if width:
            own = np.flatnonzero(widths == width)
            packed = _pack(grid[own], int(width))
            payload[(starts[own][:, None] + np.arange(packed.shape[1])).ravel()] = packed.ravel()
    parts = [
        np.array([MAGIC, n, blocks, len(place), len(payload)], "<u4"),
        least.astype("<u4"),
        widths,
        starts.astype("<u4"),
        (np.cumsum(counts) - counts).astype("<u4"),
        place.astype(np.uint8),
        high[block_of, place].astype("<u4"),
        payload,
    ]
    return b"".join(p.tobytes() for p in parts)


def decode(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The values from ``start`` to ``stop``; only their blocks are unpacked."""
    magic, n, blocks, exceptions, size = np.frombuffer(data, "<u4", _HEADER).tolist()
    if magic != MAGIC:
        raise ValueError("not a patched frame-of-reference array")
    at = 4 * _HEADER

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    least, widths, starts, before = take("<u4", blocks), take("u1", blocks), take("<u4", blocks), take("<u4", blocks)
    place, high, payload = take("u1", exceptions), take("<u4", exceptions), take("u1", size)
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last = start // BLOCK, -(-stop // BLOCK)
    grid = np.zeros((last - first, BLOCK), np.uint32)
    for width in np.unique(widths[first:last]):
        if width:
            own = np.flatnonzero(widths[first:last] == width)
            packed = payload[starts[first:last][own].astype(np.int64)[:, None] + np.arange(int(width) * BLOCK // 8)]
            grid[own] = _unpack(packed, int(width))
    ends = np.append(before[1:], exceptions)
    low, up = int(before[first]), int(ends[last - 1])
    block_of = np.repeat(np.arange(last - first), (ends - before)[first:last])
    grid[block_of, place[low:up]] |= high[low:up] << widths[first:last][block_of]
    grid += least[first:last][:, None]
    return grid.ravel()[start - first * BLOCK : stop - first * BLOCK]
