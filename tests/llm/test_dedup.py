"""The three deduplications against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from strandloom.llm import near_dedup, repeats, substring_dedup, suffix_dedup
from strandloom.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def covered(rows: list, width: int) -> list[np.ndarray]:
    """For each row (in the order that counts) the symbols covered by a window that starts earlier."""
    first: dict = {}
    out = []
    for i, symbols in enumerate(rows):
        mark = np.zeros(len(symbols), bool)
        for j in range(len(symbols) - width + 1):
            if first.setdefault(tuple(symbols[j : j + width]), (i, j)) < (i, j):
                mark[j : j + width] = True
        out.append(mark)
    return out


def in_order(spark, rows: list[tuple]) -> list[tuple]:
    """Rows by doc_id (null last) and the hash of the text."""
    texts = sorted({r[1] for r in rows if r[1] is not None})
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    of = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) as h").collect()}
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, of[r[1]]))


def runs(mark: np.ndarray) -> int:
    return int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())


def some_ids(docs, corpus, spark):
    """The corpus with rows that share or lack an id: three texts without one, an id with two texts, equal rows."""
    passage = next(r[1] for r in corpus if r[0] is None)
    more = [(None, passage + " and more of it"), (None, " ".join(f"only{i}" for i in range(60))), (None, passage), (4, " ".join(f"else{i}" for i in range(60))), (4, passage)]
    more = [(*r, "en", "s", 1) for r in more]
    return docs.unionByName(spark.createDataFrame(more, docs.schema)), [*corpus, *more]


def check_suffix(spark, docs, rows):
    raw = [(r[1] or "").encode() for r in in_order(spark, rows)]
    want = []
    for r, b, m in zip(in_order(spark, rows), raw, covered(raw, 100), strict=True):
        b = np.frombuffer(b, np.uint8)
        want.append((r[0], len(b), int(m.sum()), runs(m), hashlib.sha256(b[~m].tobytes()).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.digests(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def check_substring(spark, docs, rows):
    ordered = in_order(spark, rows)
    words = [WORD.findall((r[1] or "").encode()) for r in ordered]
    want = []
    for r, w, m in zip(ordered, words, covered(words, 20), strict=True):
        kept = b" ".join(x for x, gone in zip(w, m, strict=True) if not gone)
        want.append((r[0], len(w), int(m.sum()), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in substring_dedup.digests(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


CHECKS = {suffix_dedup: check_suffix, substring_dedup: check_substring}


@pytest.mark.parametrize("module", CHECKS)
def test_dedup_equals_brute_force(spark, docs, corpus, module):
    CHECKS[module](spark, docs, corpus)


@pytest.mark.parametrize("module", CHECKS)
def test_rows_that_share_or_lack_an_id_are_texts_of_their_own(spark, docs, corpus, module):
    CHECKS[module](spark, *some_ids(docs, corpus, spark))


@pytest.mark.parametrize("limit", [1, 3])
@pytest.mark.parametrize("module", CHECKS)
def test_keys_with_many_contexts_are_dealt_anew(spark, docs, corpus, module, limit, monkeypatch):
    monkeypatch.setattr(repeats, "LIMIT", limit)
    CHECKS[module](spark, *some_ids(docs, corpus, spark))


@pytest.mark.parametrize("module", CHECKS)
def test_crowded_buckets_are_dealt_by_context(spark, docs, corpus, module, monkeypatch):
    monkeypatch.setattr(repeats, "crowded_buckets", lambda *_: list(range(0, 1 << 16, 2)))
    CHECKS[module](spark, *some_ids(docs, corpus, spark))


@pytest.mark.parametrize("module", CHECKS)
def test_dedup_of_very_long_texts(spark, module):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(60_000)]  # some 350 KB: more than one step holds
    texts = [" ".join(words), " ".join(words[1000:1200]), "x " * 150_000, " ".join(words[59_000:] + words[:300])]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    CHECKS[module](spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), rows)


@pytest.mark.parametrize("module", CHECKS)
def test_dedup_of_nothing_and_of_clashing_columns(docs, empty, extra, module):
    assert module.digests(empty).collect() == []
    assert sorted(map(str, module.digests(extra).collect())) == sorted(map(str, module.digests(docs).collect()))
    assert module.deduplicated(docs).count() == docs.count()


def test_factors_are_the_longest_and_cross_their_boundaries():
    words = lambda *x: np.array(x, np.uint64).tobytes()
    phrase = tuple(range(100, 106))
    # the third block is half of the first and half of the second: a factor to the left, one to the right
    left = [words(*range(14)), words(*range(20, 34)), words(*range(14))]
    right = [words(*phrase, *range(200, 214)), words(*phrase, *range(300, 314)), words(*phrase, 200, 201, *range(302, 314))]
    none = np.zeros(3, int)
    start, reach = substring_dedup.parse(none, np.arange(3), np.arange(3), none, none + 14, left, right)
    assert start.tolist() == [-1, -1, 14] and reach.tolist() == [-1, -1, 8]


def test_deep_shallow_order_is_the_sorted_order():
    rng = random.Random(1)
    strings = [bytes(rng.choices(b"ab", k=100)) for _ in range(50)] + [b"a" * 100] * 3 + [b"a" * 60 + bytes(rng.choices(b"ab", k=40)) for _ in range(60)]
    rows, _ = suffix_dedup.matrix(strings, 100)
    group = np.array([i % 3 for i in range(len(strings))])
    order = suffix_dedup.deep_shallow(rows, group)
    got = [(group[i], strings[i]) for i in order]
    assert got == sorted(zip(group.tolist(), strings, strict=True))


def test_blind_trie_orders_prefixes_and_equals():
    rng = random.Random(2)
    strings = [bytes(rng.choices(b"\0ab", k=12)) for _ in range(300)]
    assert [strings[i] for i in suffix_dedup.BlindTrie(strings).order()] == sorted(strings)


@pytest.mark.parametrize("symbol", [1, 7])
def test_equal_windows_share_an_anchor(symbol):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 3, 900).astype(np.uint64) * np.uint64(symbol) + np.uint64(1)
    s = repeats.Symbols(values, np.array([0, 400]), np.array([400, 900]))
    own, pos, *_ = s.anchors(6, 20)
    anchors = {(int(o), int(p)) for o, p in zip(own, pos, strict=True)}
    seen: dict = {}
    for o, (a, b) in enumerate([(0, 400), (400, 900)]):
        for j in range(b - a - 19):
            window = tuple(values[a + j : a + j + 20].tolist())
            mine = frozenset(l for l in range(15) if (o, j + l) in anchors)
            assert mine
            seen.setdefault(window, []).append(mine)
    for same in seen.values():
        for x, y in itertools.pairwise(same):
            assert x & y


def shingles(text: str | None, width: int) -> frozenset:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    w = WORD.findall(low)
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_components(rows: list[tuple], width: int) -> tuple[list[int | None], list[int | None]]:
    """The smallest id of each row's group, and of each group with words; rows are linked by their texts, whatever their ids."""
    sets = [shingles(r[1], width) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            parent[root(b)] = root(a)
    least: dict = {}
    for i, r in enumerate(rows):
        least.setdefault(root(i), []).append(r[0])
    smallest = {k: min((x for x in ids if x is not None), default=None) for k, ids in least.items()}
    return [smallest[root(i)] if sets[i] else r[0] for i, r in enumerate(rows)], [smallest[i] for i in range(len(rows)) if root(i) == i and sets[i]]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, docs, corpus, width):
    docs, rows = some_ids(docs, corpus, spark)
    want, groups = brute_components(rows, width)
    got = near_dedup.near_duplicates(docs, width=width).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2] is None, x[2] or 0)
    expected = [(r[0], len(shingles(r[1], width)), c) for r, c in zip(rows, want, strict=True)]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(expected, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.component_id is not None)
    assert any(r.kept for r in got if r.component_id is None and r.n_shingles)
    kept = near_dedup.first_of_group(docs, width=width).collect()
    # one row of each group with words, all without
    with_words = [r for r in kept if shingles(r.text, width)]
    assert sorted(r.doc_id for r in with_words if r.doc_id is not None) == sorted(g for g in groups if g is not None)
    assert len(kept) - len(with_words) == sum(not shingles(r[1], width) for r in rows)
    assert [r.text.split()[0] for r in with_words if r.doc_id is None] == ["only0"]


def test_ids_never_join_groups(spark):
    rng = random.Random(7)
    a, b, c = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(40)) for x in "abc")
    rows = [(1, a), (2, b), (None, a), (None, b), (3, a), (3, c), (4, c), (None, "no copy of it is here"), (None, "no copy of it is here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_dedup.near_duplicates(docs, width=2).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (0, 0, True), (0, 1, False), (0, 2, False), (1, 1, True), (2, 2, True), (3, 1, False), (3, 3, True), (4, 3, False)]
    kept = near_dedup.first_of_group(docs, width=2).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (2, b), (3, c), (0, "no copy of it is here")])


def test_near_duplicates_in_blocks(docs, monkeypatch):
    want = sorted(map(str, near_dedup.near_duplicates(docs, width=2).collect()))
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "LEADERS", 2)
    assert sorted(map(str, near_dedup.near_duplicates(docs, width=2).collect())) == want


def test_near_duplicates_of_nothing_and_of_clashing_columns(docs, empty, extra):
    assert near_dedup.near_duplicates(empty).collect() == []
    assert near_dedup.first_of_group(extra).columns == extra.columns
    assert sorted(map(str, near_dedup.near_duplicates(extra).collect())) == sorted(map(str, near_dedup.near_duplicates(docs).collect()))
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(docs, percent=50)


def test_short_texts_in_another_order_are_no_near_copies(spark):
    rows = [(1, "a b c"), (2, "c b a"), (3, "A b  c"), (4, "b a"), (5, "a b")]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=5).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_joined_stretches_of_two_texts_under_one_id():
    doc, sub, lo, hi = (np.array(x) for x in ([7, 7, 7, 7, 9, 9, 9], [1, 1, 2, 1, 1, 1, 1], [17, 12, 150, 200, 3, 5, 9], [120, 180, 160, 210, 9, 8, 12]))
    assert [x.tolist() for x in repeats.joined(doc, sub, lo, hi)] == [[7, 7, 7, 9], [1, 1, 2, 1], [12, 200, 150, 3], [180, 210, 160, 12]]
    assert [x.tolist() for x in repeats.joined(doc[:0], sub[:0], lo[:0], hi[:0])] == [[], [], [], []]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100} and got[201] == 200
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_sets_about_the_size_of_a_sketch_lose_no_link(spark):
    """Sets within a larger one, around K shingles, where one side is cut to its sketch and the other is not."""
    rng = random.Random(11)
    rows, n = [], 0
    for size in range(52, 84, 3):
        for _ in range(12):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size + 1)]
            short = max(2, -(-8 * size // 10))
            rows += [(n, " ".join(words)), (n + 1, " ".join(words[: short + 1]))]
            n += 2
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()}
    assert all(got[i] == i - i % 2 for i in got)
