"""Substring deduplication over words by relative Lempel-Ziv parsing.

A word goes if a window of WIDTH words that covers it also starts earlier in the corpus. Reference blocks are the
surroundings of content-chosen phrases of ANCHOR words (repeats.py); every phrase that occurs in more than one of them is
indexed. Each block is parsed against all earlier blocks of its phrase: the greedy factor from a start is the longest run
of words that some one of them holds too, and it is grown word by word. The parse begins at the block's left end; at each
factor boundary it goes on with the next start from which a factor reaches further, so that windows across a boundary
are checked too. Factors of WIDTH words or more are duplicate spans. A block that occurred before as a whole is one
factor, known by its fingerprint.

Null text has no words. Texts under WIDTH words keep all. Rows that share or lack a doc_id are texts of their own, in the
order of their hashes; of equal rows one is the first, the others are its copies. A very long text makes a step of its
own. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from . import repeats, textkit

WIDTH, ANCHOR = 20, 6
BEFORE = WIDTH - ANCHOR
U = np.uint64


def symbols(texts: list[str | None]) -> Iterator[tuple[int, repeats.Symbols]]:
    for first, codes, offsets in textkit.steps(texts):
        a, b = textkit.words(codes)
        edges = np.searchsorted(a, offsets)
        yield first, repeats.Symbols(textkit.hashes(codes, a, b), edges[:-1], edges[1:])


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def blocks(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each block by number, the phrase from column BEFORE on, and how many stand before and from the phrase on."""
    n = len(left)
    before, after = np.array([len(x) // 8 for x in left]), np.array([len(x) // 8 for x in right])
    words = np.zeros((n, BEFORE + WIDTH), U)
    for i in range(n):
        words[i, BEFORE - before[i] : BEFORE] = np.frombuffer(left[i], U)[::-1]
        words[i, BEFORE : BEFORE + after[i]] = np.frombuffer(right[i], U)
    return np.unique(words, return_inverse=True)[1].reshape(words.shape).astype(np.int64), before, after


def parse(group, rank, text, a, b, left, right) -> tuple[np.ndarray, np.ndarray]:
    """Words covered by factors of WIDTH words or more, before the phrase and from it on; -1 where there is none."""
    words, before, after = blocks(left, right)
    span = int(words.max(initial=0)) + 1
    start, reach = np.full(len(group), -1), np.full(len(group), -1)
    for l in range(BEFORE, -1, -1):
        live = np.flatnonzero((a <= l) & (l <= b) & (before >= l) & (after >= WIDTH - l))
        cls = group[live].astype(np.int64)
        for j in range(BEFORE - l, BEFORE + WIDTH):
            on = after[live] > j - BEFORE
            live, cls = live[on], cls[on]
            _, cls, count = np.unique(cls * span + words[live, j], return_inverse=True, return_counts=True)
            shared = count[cls] > 1  # a block that no other follows so far neither has a factor here nor serves as reference
            live, cls = live[shared], cls[shared]
            if not len(live):
                break
            if (length := l + j - BEFORE + 1) < WIDTH:
                continue
            first = np.full(len(count), np.iinfo(np.int64).max)
            np.minimum.at(first, cls, rank[live])
            hit = live[first[cls] < rank[live]]  # the factor is held by an earlier block up to this word
            if not len(hit):
                break
            start[hit] = np.maximum(start[hit], l)
            reach[hit] = np.maximum(reach[hit], length - l)
    return start, reach


SEARCH = repeats.Search("substring", symbols, ANCHOR, WIDTH, pack, parse)


def removed(docs: DataFrame) -> DataFrame:
    """doc, sub and the removed stretches of words."""
    return repeats.covered(repeats.texts_of(docs), SEARCH)


def cut(text: str | None, stretches: list | None, again: bool = False) -> tuple[list[bytes], int]:
    """The words that stay, and how many there were; of a row seen before all that a window covers goes."""
    words = (text or "").encode().split()
    if again and len(words) >= WIDTH:
        return [], len(words)
    kept, at = [], 0
    for a, b in repeats.merged(stretches, len(words)):
        kept += words[at:a]
        at = b
    return kept + words[at:], len(words)


def digest(text: str | None, stretches: list | None, again: bool = False) -> tuple:
    kept, n = cut(text, stretches, again)
    return n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id and the words that stay, joined by one space."""
    return repeats.applied(docs, removed(docs), lambda t, s, again: (b" ".join(cut(t, s, again)[0]).decode(),), "text string")


def digests(docs: DataFrame) -> DataFrame:
    return repeats.applied(docs, removed(docs), digest, "n_words long, n_removed long, kept_sha256 string")
