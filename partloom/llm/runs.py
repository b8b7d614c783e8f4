"""Runs of bytes within texts, and their CRCs, over whole arrays."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: CRC of each byte alone, for the reflected polynomial of zlib.
TABLE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
#: Bytes up to which runs of one length make a matrix; the few longer ones are hashed one by one.
LONGEST = 256


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one place more than texts); null is empty."""
    return binary_bytes(pc.fill_null(values.cast(pa.large_string()), ""))


def binary_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same for any strings of bytes without nulls."""
    filled = values.cast(pa.large_binary())
    _, offsets, data = filled.buffers()
    places = np.frombuffer(offsets, np.int64, len(filled) + 1, filled.offset * 8) if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[places[0]: places[-1]], places - places[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def runs(inside: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and length of each maximal run of marked bytes; no run crosses texts."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[places] = True
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    stop = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return np.searchsorted(places, start, side="right") - 1, start, stop - start


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Each range of bytes as a value of its own."""
    offsets = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
    index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[index]))]
    )


def crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of each range of bytes; ``before`` holds the CRCs of what stands in front of each.

    Ranges of equal length are the columns of a matrix of bytes, and one row of it moves all their CRCs on
    by a byte.
    """
    out = np.zeros(len(start), np.uint32) if before is None else before.astype(np.uint32)
    order = np.argsort(length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    for size, members in zip(sizes.tolist(), np.split(order, first[1:]) if len(first) else [], strict=True):
        if size > LONGEST:
            for i in members.tolist():
                out[i] = zlib.crc32(data[start[i]: start[i] + size], int(out[i]))
            continue
        state = ~out[members]
        for row in data[np.arange(size)[:, None] + start[members]]:
            state = TABLE[(state ^ row) & np.uint32(255)] ^ (state >> np.uint32(8))
        out[members] = ~state
    return out
