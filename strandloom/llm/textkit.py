"""Words and their hashes for many texts at once, in NumPy; the same values in every process."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of texts handled in one step; a longer text makes a step of its own.
STEP = 1 << 18
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, STEP)
        up, down = np.full(size, _BASE, U), np.full(size, _INVERSE, U)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words ([^\\x20\\x09-\\x0D]+) start and end."""
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = ~_SPACE[codes]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range."""
    if not len(starts):
        return np.zeros(0, U)
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, U)
    np.cumsum((codes.astype(U) + U(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


def steps(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes of some texts with a line end after each, offset of each text and of the end)."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        if held and size + len(raw) > STEP:
            yield at, *_joined(held)
            at, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield at, *_joined(held)


def _joined(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(held) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in held], out=offsets[1:])
    return np.frombuffer(b"\n".join(held) + b"\n", np.uint8), offsets


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of `width` words."""
    n = len(h) - width + 1
    out = np.zeros(max(0, n), U)
    for j in range(width if n > 0 else 0):
        out = out * U(_BASE) + h[j : j + n]
    return mixed(out)


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)
