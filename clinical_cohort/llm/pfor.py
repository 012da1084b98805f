"""Patched frame-of-reference coding of unsigned 32-bit integers.

Blocks of ``BLOCK`` values: the block's minimum is subtracted, the rest is
packed at the width that a percentile of the rest needs, and values that need
more bits are kept in an exception list. An index of block starts at the head
of the image lets a reader decode any range without the blocks before it.

Image, little-endian: magic, block size u32, count u64; then per block the
index entry (offset u64, minimum u32, exceptions u16, width u16); then per block
the packed words u64, exception positions u16 and exception values u32.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"PFR1"
BLOCK = 1024
PERCENTILE = 98
_HEAD = struct.Struct("<4sIQ")
_ENTRY = np.dtype([("offset", "<u8"), ("least", "<u4"), ("n_except", "<u2"), ("width", "<u2")])


def _pack(rest: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values as rows of 64-bit words; 64 values fill ``width`` words."""
    lanes = rest.astype(np.uint64).reshape(len(rest), -1, 64)
    out = np.zeros((*lanes.shape[:2], width), "<u8")
    for k in range(64):
        word, shift = divmod(k * width, 64)
        out[..., word] |= lanes[..., k] << np.uint64(shift)
        if shift + width > 64:
            out[..., word + 1] |= lanes[..., k] >> np.uint64(64 - shift)
    return out.reshape(len(rest), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(len(words), -1, width)
    out = np.empty((*lanes.shape[:2], 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        v = lanes[..., word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | lanes[..., word + 1] << np.uint64(64 - shift)
        out[..., k] = v & mask
    return out.reshape(len(words), -1)


def encode(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The image of a sequence, empty ones included."""
    n = len(values)
    n_blocks = -(-n // BLOCK)
    padded = np.empty(n_blocks * BLOCK, np.uint32)
    padded[:n] = values
    padded[n:] = values[-1] if n else 0
    blocks = padded.reshape(n_blocks, BLOCK)
    index = np.zeros(n_blocks, _ENTRY)
    index["least"] = blocks.min(axis=1, initial=2**32 - 1)
    rest = blocks - index["least"][:, None]
    at = min(BLOCK - 1, int(BLOCK * percentile / 100))
    cut = np.partition(rest, at, axis=1)[:, at]
    index["width"] = np.ceil(np.log2(cut.astype(np.float64) + 1)).astype(np.uint16)
    limit = (np.uint64(1) << index["width"].astype(np.uint64))[:, None]
    outlier = rest >= limit
    index["n_except"] = outlier.sum(axis=1)
    payload: list[bytes] = [b""] * n_blocks
    for width in np.unique(index["width"]).tolist():
        which = np.flatnonzero(index["width"] == width)
        packed = _pack(np.where(outlier[which], 0, rest[which]), width) if width else np.zeros((len(which), 0), "<u8")
        for b, words in zip(which.tolist(), packed, strict=True):
            payload[b] = words.tobytes()
    for b in np.flatnonzero(index["n_except"]).tolist():
        places = np.flatnonzero(outlier[b])
        payload[b] += places.astype("<u2").tobytes() + blocks[b, places].astype("<u4").tobytes()
    sizes = np.fromiter(map(len, payload), np.uint64, n_blocks)
    index["offset"] = _HEAD.size + index.nbytes + np.concatenate([[0], np.cumsum(sizes)[:-1]]) if n_blocks else 0
    return b"".join([_HEAD.pack(MAGIC, BLOCK, n), index.tobytes(), *payload])


def decode(image: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The values from ``start`` to ``stop`` (default: all), reading only their blocks."""
    magic, block, n = _HEAD.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a patched frame-of-reference image")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.empty(0, np.uint32)
    first, last = start // block, -(-stop // block)
    index = np.frombuffer(image, _ENTRY, -(-n // block), _HEAD.size)[first:last]
    out = np.empty((last - first, block), np.uint32)
    for width in np.unique(index["width"]).tolist():
        which = np.flatnonzero(index["width"] == width)
        count = block * width // 64
        words = np.stack([np.frombuffer(image, "<u8", count, index["offset"][b]) for b in which.tolist()])
        rest = _unpack(words, width) if width else np.zeros((len(which), block), np.uint64)
        out[which] = rest.astype(np.uint32) + index["least"][which, None]
    for b in np.flatnonzero(index["n_except"]).tolist():
        at, k = int(index["offset"][b]) + block * int(index["width"][b]) // 8, int(index["n_except"][b])
        out[b, np.frombuffer(image, "<u2", k, at)] = np.frombuffer(image, "<u4", k, at + 2 * k)
    return out.reshape(-1)[start - first * block:stop - first * block]
