"""Suffix-array deduplication of byte strings by deep-shallow sorting.

A byte goes if a WIDTH-byte string that covers it also starts earlier in the corpus. The suffixes that can repeat are
those at content-chosen anchors (repeats.py); an equal context has one entry, and all distinct contexts of an anchor are
ordered to the right of the anchor and, reversed, to its left: multikey quicksort to a shallow depth, all segments at
once on eight-byte characters, then blind tries for what is still tied. Neighbouring common-prefix lengths of both orders
give, for every window around an anchor, its class of equal windows.

Null text counts as empty. Texts under WIDTH bytes keep all. Rows that share or lack a doc_id are texts of their own, in
the order of their hashes; of equal rows one is the first, the others are its copies. A very long text makes a step of
its own. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from . import repeats, textkit

WIDTH, ANCHOR = 100, 32
SHALLOW = 48
U = np.uint64


def symbols(texts: list[str | None]) -> Iterator[tuple[int, repeats.Symbols]]:
    for first, codes, offsets in textkit.steps(texts):
        yield first, repeats.Symbols(codes.astype(U) + U(1), offsets[:-1], offsets[1:] - 1)


def pack(values: np.ndarray) -> bytes:
    return (values - U(1)).astype(np.uint8).tobytes()


def matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings as rows padded with zeros, and their lengths."""
    sizes = np.array([len(s) for s in strings], np.int64)
    full = -(-width // 8) * 8
    return np.frombuffer(b"".join(s.ljust(full, b"\0") for s in strings), np.uint8).reshape(len(strings), full), sizes


def multikey_quicksort(rows: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order within groups by the first `depth` bytes, and the segment of each place: places of one segment are tied."""
    words = np.ascontiguousarray(rows).view(">u8").astype(U)
    limit = depth // 8
    order = np.argsort(group, kind="stable")
    seg = np.unique(group[order], return_inverse=True)[1].astype(np.int64)
    level = np.zeros(len(order), np.int64)
    while True:
        starts = np.flatnonzero(np.diff(seg, prepend=-1))
        sizes = np.diff(np.append(starts, len(seg)))
        live = np.repeat(sizes > 1, sizes) & (level < limit)
        at = np.flatnonzero(live)
        if not len(at):
            return order, seg
        # the middle row of each segment is its pivot; smaller, equal and larger rows part at the segment's level
        pivot = order[np.repeat(starts + sizes // 2, sizes)[at]]
        own, lev = order[at], level[at]
        x, y = words[own, lev], words[pivot, lev]
        side = np.where(x < y, 0, np.where(x == y, 1, 2))
        move = np.lexsort((side, seg[at]))
        order[at], side = own[move], side[move]
        level[at] = lev[move] + (side == 1)
        key = seg * 3
        key[at] += side
        seg = np.cumsum(np.diff(key, prepend=key[0] if len(key) else 0) != 0)


class BlindTrie:
    """A trie of branching depths only: a search looks at branching bytes, and one comparison finds where it went wrong."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.width = len(strings[0])
        self.numbers = [int.from_bytes(s) for s in strings]
        self.root: list | int | None = None
        self.same: dict[int, list[int]] = {}
        for i in range(len(strings)):
            self._insert(i)

    def _common(self, i: int, j: int) -> int:
        return self.width - (((self.numbers[i] ^ self.numbers[j]).bit_length() + 7) >> 3)

    def _insert(self, i: int) -> None:
        if self.root is None:
            self.root = i
            return
        s, node = self.strings[i], self.root
        while not isinstance(node, int):
            depth, children = node
            node = children.get(s[depth])
            if node is None:
                node = next(iter(children.values()))
        shared = self._common(i, node)
        if shared == self.width:
            self.same.setdefault(node, []).append(i)
            return
        parent, step, below = None, -1, self.root
        while not isinstance(below, int) and below[0] < shared:
            parent, step = below, s[below[0]]
            below = parent[1].get(step)
            if below is None:
                parent[1][step] = i
                return
        if not isinstance(below, int) and below[0] == shared:
            below[1][s[shared]] = i
            return
        made = [shared, {self.strings[node][shared]: below, s[shared]: i}]
        if parent is None:
            self.root = made
        else:
            parent[1][step] = made

    def order(self) -> list[int]:
        out: list[int] = []
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                out.append(node)
                out += self.same.get(node, ())
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def deep_shallow(rows: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Order of the rows within their groups."""
    order, seg = multikey_quicksort(rows, group, shallow)
    starts = np.flatnonzero(np.diff(seg, prepend=-1))
    ends = np.append(starts[1:], len(seg))
    for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        own = order[a:b]
        tied = [rows[i, shallow:].tobytes() for i in own]
        if b - a == 2:
            if tied[1] < tied[0]:
                order[a], order[a + 1] = own[1], own[0]
        else:
            order[a:b] = own[BlindTrie(tied).order()]
    return order


def common_prefixes(rows: np.ndarray, sizes: np.ndarray, group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the order, how many bytes it shares with the place before; -1 where a group begins."""
    out = np.full(len(order), -1, np.int64)
    if len(order) > 1:
        a, b = order[:-1], order[1:]
        differ = rows[a] != rows[b]
        shared = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[1:] = np.where(group[a] == group[b], np.minimum(shared, np.minimum(sizes[a], sizes[b])), -1)
    return out


def look(group: np.ndarray, left: list[bytes], right: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For each l, the class of the window that starts l bytes before the anchor; -1 where the text has no such window."""
    n = len(group)
    lrows, lsize = matrix(left, WIDTH - ANCHOR)
    rrows, rsize = matrix(right, WIDTH)
    lorder, rorder = deep_shallow(lrows, group, 16), deep_shallow(rrows, group)
    lshared, rshared = common_prefixes(lrows, lsize, group, lorder), common_prefixes(rrows, rsize, group, rorder)
    of_left, of_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for before in range(WIDTH - ANCHOR + 1):
        after = WIDTH - before
        of_left[lorder] = np.cumsum(lshared < before)
        of_right[rorder] = np.cumsum(rshared < after)
        yield before, np.where((lsize >= before) & (rsize >= after), of_left * (n + 1) + of_right, -1)


SEARCH = repeats.Search("suffix", symbols, ANCHOR, WIDTH, pack, repeats.by_classes(look, WIDTH, False))


def removed(docs: DataFrame) -> DataFrame:
    """doc, sub and the removed stretches of bytes."""
    return repeats.covered(repeats.texts_of(docs), SEARCH)


def cut(text: str | None, stretches: list | None, again: bool = False) -> tuple[bytes, int, list[tuple[int, int]]]:
    """The bytes that stay, how many there were, and the removed runs; of a row seen before all that a window covers goes."""
    raw = (text or "").encode()
    runs = [(0, len(raw))] if again and len(raw) >= WIDTH else repeats.merged(stretches, len(raw))
    kept, at = [], 0
    for a, b in runs:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    return b"".join(kept), len(raw), runs


def digest(text: str | None, stretches: list | None, again: bool = False) -> tuple:
    kept, n, runs = cut(text, stretches, again)
    return n, n - len(kept), len(runs), hashlib.sha256(kept).hexdigest()


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id and the text that stays; bytes of a character cut in two are dropped with it."""
    return repeats.applied(docs, removed(docs), lambda t, s, again: (cut(t, s, again)[0].decode(errors="ignore"),), "text string")


def digests(docs: DataFrame) -> DataFrame:
    return repeats.applied(docs, removed(docs), digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
