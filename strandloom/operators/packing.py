"""Columns of many rows as one compressed value, so that a shuffle moves a few bytes a row.

A value says what it holds: whole numbers keep as many bytes as their range needs, strings their lengths and bytes.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Values of fewer bytes are not compressed.
LEAST = 128
_CODEC = pa.Codec("zstd", 1)


def _narrow(x: np.ndarray) -> tuple[int, np.ndarray]:
    low = int(x.min()) if len(x) else 0
    span = int(x.max()) - low if len(x) else 0
    if span >= 2**63:
        return 0, x.astype("<i8")
    return low, (x - low).astype(next(f"<u{w}" for w in (1, 2, 4, 8) if span < 1 << (8 * w)))


def pack(columns: list) -> bytes:
    """Arrays of numbers (numpy) or strings (Arrow, without nulls) as bytes."""
    parts = []
    for c in columns:
        if isinstance(c, pa.Array):
            raw = c.cast(pa.large_binary())
            lengths = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
            low, n = _narrow(lengths)
            parts.append(struct.pack("<cBqq", b"s", n.dtype.itemsize, low, len(n)) + n.tobytes() + struct.pack("<q", int(lengths.sum())) + b"".join(raw.to_pylist()))
        elif c.dtype.kind == "f":
            parts.append(struct.pack("<cBqq", b"f", 8, 0, len(c)) + c.astype("<f8").tobytes())
        else:
            low, n = _narrow(c.astype(np.int64, copy=False))
            parts.append(struct.pack("<cBqq", n.dtype.kind.encode(), n.dtype.itemsize, low, len(n)) + n.tobytes())
    body = b"".join(parts)
    if len(body) < LEAST:
        return b"\0" + body
    return b"\1" + struct.pack("<q", len(body)) + _CODEC.compress(body, asbytes=True)


def unpack(value: bytes) -> list:
    """What pack() was given; numbers as int64 or float64, strings as large_string."""
    body = value[1:] if value[:1] == b"\0" else _CODEC.decompress(value[9:], struct.unpack_from("<q", value, 1)[0], asbytes=True)
    out, at = [], 0
    while at < len(body):
        kind, width, low, n = struct.unpack_from("<cBqq", body, at)
        at += 18
        if kind == b"f":
            x = np.frombuffer(body, "<f8", n, at)
        else:
            x = np.frombuffer(body, f"<{'i' if kind == b'i' else 'u'}{width}", n, at).astype(np.int64) + low
        at += n * width
        if kind == b"s":
            size = struct.unpack_from("<q", body, at)[0]
            offsets = np.concatenate(([0], np.cumsum(x))).astype(np.int64)
            x = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(body[at + 8 : at + 8 + size]))
            at += 8 + size
        out.append(x)
    return out


def merged(names: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """All distinct strings in order, and for each array the places of its strings among them."""
    every = pa.chunked_array([n.cast(pa.large_string()) for n in names], pa.large_string()).combine_chunks()
    found = every.unique()
    found = found.take(pc.sort_indices(found))
    at = pc.index_in(every, found).to_numpy(zero_copy_only=False).astype(np.int64)
    return found, np.split(at, np.cumsum([len(n) for n in names])[:-1])


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of an array of small ones, in order, and the place of each among them."""
    if not len(values):
        return values, values
    seen = np.zeros(int(values.max()) + 1, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]
