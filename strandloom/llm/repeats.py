"""Repeated windows of W symbols (bytes or words) across a corpus, found exactly from content-chosen anchors.

Every window of W symbols contains an anchor: the position whose K-symbol hash is smallest among the window's. Equal
windows choose equal anchors, so a window can only repeat where its anchor's K symbols repeat. All windows around an
anchor lie in its context, the W - K symbols before it and the W from it on. Then

1. anchors are put together by the hash of their K symbols, those of crowded hash buckets by their whole context. One
   anchor stands for all of an equal context; within an Arrow batch this is done before the shuffle, so that a text with
   very many copies sends one row a batch;
2. all distinct contexts of K symbols that have more than one go to a closer look, which an operator supplies (suffix
   order, or greedy factors). A key with more than LIMIT of them is dealt anew by longer stretches around the anchor:
   the windows that start in one of FAN parts of its range share a longer stretch, whose hash is the new key. A range
   of one window is a group of equal windows, of which only the first (or two texts) counts;
3. the covered stretches go back to the texts.

Rows are texts: `doc` is the doc_id (null ids after all others) and `sub` a hash of the text, so that rows that share or
lack an id never share offsets; "earlier" is by (doc, sub, start). Equal rows have one key; applied() keeps one of them as
the first and takes the others for copies. The rule `elsewhere` marks windows that occur in another text, wherever.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textkit
from .common import arrow_map, id_key, stored

U = np.uint64
TOP = np.iinfo(np.uint64).max
#: Contexts of a key that one task holds (some 20 MB), and the parts a crowded key is cut into.
LIMIT, FAN = 100_000, 9
#: Hash buckets that are counted to find crowded keys; one is crowded beyond CROWDED times the mean, so at most 2 ** BUCKET_BITS / CROWDED are.
BUCKET_BITS, CROWDED = 16, 8


def sliding(a: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick over each run of `width` values."""
    n = len(a) - width + 1
    if n < 1:
        return np.zeros(0, a.dtype)
    full = -(-len(a) // width) * width
    b = np.full(full, fill, a.dtype)
    b[: len(a)] = a
    b = b.reshape(-1, width)
    ahead = pick.accumulate(b, axis=1).ravel()
    back = pick.accumulate(b[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[width - 1 : width - 1 + n])


class Symbols:
    """Some texts as one array of symbols with the range of each text."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.values, self.starts, self.ends = values, starts, ends
        self.up, self.down = textkit._powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * self.up[:-1], out=self.sums[1:])

    def hash(self, a: np.ndarray, b: np.ndarray, tag: np.ndarray | int) -> np.ndarray:
        return textkit.mixed((self.sums[b] - self.sums[a]) * self.down[a] + np.asarray(tag).astype(U))

    def anchors(self, k: int, width: int) -> tuple[np.ndarray, ...]:
        """(text, position, start and end of the context, hash of K symbols, hash of the context) of each anchor."""
        n = len(self.values) - k + 1
        none = np.zeros(0, np.int64)
        if n < 1:
            return none, none, none, none, none.view(U), none.view(U)
        h = textkit.mixed((self.sums[k:] - self.sums[:-k]) * self.down[:n] + U(k))
        cross = np.zeros(len(self.values) + 1, np.int32)
        np.add.at(cross, np.maximum(self.starts, self.ends - k + 1), 1)
        np.add.at(cross, np.append(self.starts[1:], len(self.values)), -1)
        cross = np.cumsum(cross)[:n] > 0
        h[cross] = TOP
        w = width - k + 1
        least = sliding(np.concatenate([h, np.full(max(0, w - n), TOP, U)]), w, np.minimum, TOP)
        edge = np.zeros(w - 1, U)
        chosen = (sliding(np.concatenate([edge, least, edge]), w, np.maximum, 0)[:n] == h) & ~cross
        at = np.flatnonzero(chosen)
        own = np.searchsorted(self.starts, at, side="right") - 1
        a, b = np.maximum(self.starts[own], at - (width - k)), np.minimum(self.ends[own], at + width)
        whole = b - a >= width
        at, own, a, b = at[whole], own[whole], a[whole], b[whole]
        context = self.hash(a, b, (at - a) * 4096 + (b - at))
        base = self.starts[own]
        return own, at - base, a - base, b - base, h[at], context


@dataclass(frozen=True)
class Search:
    """What repeats: symbols(texts) yields (first text, Symbols); pack() makes bytes of symbols; judge() is the closer look."""

    name: str
    symbols: Callable[[list], Iterator[tuple[int, Symbols]]]
    k: int
    width: int
    pack: Callable[[np.ndarray], bytes]
    #: (group, rank, text, least and most starts before the anchor, left, right) to (symbols covered before the anchor, after its start), -1 for none.
    judge: Callable[..., tuple[np.ndarray, np.ndarray]]
    elsewhere: bool = False


def _frame(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns differs from the row before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _salted(h: np.ndarray, salt: np.ndarray) -> np.ndarray:
    return np.where(salt == 0, h, textkit.mixed(h + salt.view(U)))


def joined(doc: np.ndarray, sub: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of one text, overlapping ones as one."""
    order = np.lexsort((hi, lo, sub, doc))
    doc, sub, lo, hi = doc[order], sub[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    if not len(doc):
        return doc, sub, lo, hi
    other = _changes(doc, sub)
    shift = np.cumsum(other) * (hi.max() + 1)
    reach = np.maximum.accumulate(hi + shift) - shift  # the largest end of the text so far
    new = other.copy()
    new[1:] |= lo[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], sub[at], lo[at], np.maximum.reduceat(hi, at)


def texts_of(docs: DataFrame) -> DataFrame:
    """doc, sub, salt and text of each row; the salt is 0, as texts of any two rows are held against each other."""
    return docs.select(id_key().alias("doc"), F.xxhash64("text").alias("sub"), F.lit(0).cast("long").alias("salt"), "text")


def _anchors_of(batch: pa.RecordBatch, s: Search) -> list[np.ndarray] | None:
    """h, context, doc, sub, position and context range of all anchors; equal rows of a batch are one."""
    doc, sub, salt = (batch.column(i).to_numpy() for i in range(3))
    _, rows = np.unique(np.column_stack([doc, sub]), axis=0, return_index=True)
    rows.sort()
    doc, sub, salt = doc[rows], sub[rows], salt[rows]
    parts = []
    for first, x in s.symbols(batch.column(3).take(pa.array(rows)).to_pylist()):
        own, pos, a, b, h, c = x.anchors(s.k, s.width)
        own = own + first
        parts.append((textkit.signed(_salted(h, salt[own])), textkit.signed(c), doc[own], sub[own], pos, a, b))
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else None


def crowded_buckets(texts: DataFrame, s: Search) -> list[int]:
    """Buckets of anchor hashes that hold far more than the mean; at most 2 ** BUCKET_BITS / CROWDED numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            found = _anchors_of(batch, s)
            if found:
                counts += np.bincount(found[0] & ((1 << BUCKET_BITS) - 1), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield _frame(bucket=at, n=counts[at])

    sums = stored(texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")), f"{s.name}-buckets")
    mean = (sums.agg(F.sum("n")).first()[0] or 0) / (1 << BUCKET_BITS)
    return [r.bucket for r in sums.filter(F.col("n") > max(64.0, CROWDED * mean)).select("bucket").collect()]


def found_anchors(texts: DataFrame, s: Search) -> DataFrame:
    """Anchors (h, context, doc, sub, spot) of all texts. spot packs position, 1 bit for settled, symbols before and after; the last are 0 for a settled stretch (start in spot, end in c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _anchors_of(batch, s)
            if not found or not len(found[0]):
                continue
            h, c, doc, sub, pos, a, b = found
            order = np.lexsort((pos, sub, doc, c, h))
            h, c, doc, sub, pos, a, b = (x[order] for x in (h, c, doc, sub, pos, a, b))
            head = _changes(h, c)
            heads = np.flatnonzero(head)
            group = np.cumsum(head) - 1
            if s.elsewhere:
                last = np.append(heads[1:], len(h)) - 1
                many = (doc[heads] != doc[last]) | (sub[heads] != sub[last])
                done = many[group]
                on = ~done
                on[heads] = on[last] = True
            else:
                first = heads[group]
                done = (doc != doc[first]) | (sub != sub[first]) | (pos != pos[first])
                on = ~done
            spot = (pos << 16) | (done.astype(np.int64) << 15) | ((pos - a) << 8) | (b - pos)
            yield _frame(h=h[on], c=c[on], doc=doc[on], sub=sub[on], spot=spot[on])
            doc, sub, lo, hi = joined(doc[done], sub[done], a[done], b[done])
            # settled stretches need no key: they are dealt by text
            yield _frame(h=textkit.signed(textkit.mixed(doc.view(U) ^ textkit.mixed(sub.view(U)))), c=hi, doc=doc, sub=sub, spot=lo << 16)

    return texts.mapInArrow(run, "h long, c long, doc long, sub long, spot long")


def _by_key(batches: Iterator[pa.RecordBatch], settle: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """settle() of tables that hold whole runs of equal first columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(0).to_numpy()
        cut = int(np.searchsorted(h, h[-1]))
        if held and held[-1].column(0)[-1].as_py() != h[0] or cut:
            # everything before the last key is complete
            if cut:
                held.append(batch.slice(0, cut))
            yield settle(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield settle(pa.Table.from_batches(held))


def resolved(anchors: DataFrame, crowded: list[int], s: Search) -> DataFrame:
    """Stretches (doc, sub, lo, hi) of settled contexts; with `need`, anchors (doc, sub, pos, h) for the closer look."""
    deal = F.when(F.col("h").bitwiseAND((1 << BUCKET_BITS) - 1).isin(crowded), F.xxhash64("h", "c")).otherwise(F.col("h")) if crowded else F.col("h")
    rows = anchors.repartition(deal).sortWithinPartitions("h", "c", "doc", "sub", "spot")
    full = np.zeros(1 << BUCKET_BITS, bool)
    full[crowded] = True

    def settle(t: pa.Table) -> pa.RecordBatch:
        h, c, doc, sub, spot = (t.column(i).to_numpy() for i in range(5))
        pos, before, after, done = spot >> 16, (spot >> 8) & 127, spot & 255, (spot >> 15) & 1 == 1
        plain = after == 0
        new_h = _changes(h)
        new_c = _changes(h, c)
        heads = np.flatnonzero(new_c)
        of = np.cumsum(new_c) - 1
        group = np.cumsum(new_h) - 1
        several = (np.bincount(group, weights=new_c & ~plain)[group] > 1) | full[h & ((1 << BUCKET_BITS) - 1)]
        first = heads[of]
        if s.elsewhere:
            last = np.append(heads[1:], len(h)) - 1
            dup = ((doc[heads] != doc[last]) | (sub[heads] != sub[last]))[of] & ~plain
            end = np.zeros(len(h), bool)
            end[heads] = end[last] = True
            cover, need = dup & ~done, ~plain & (end | ~dup) & several
        else:
            dup = (doc != doc[first]) | (sub != sub[first]) | (pos != pos[first])
            cover, need = dup & ~plain, ~plain & ~dup & several
        cover |= plain
        lo, hi = np.where(plain, pos, pos - before), np.where(plain, c, pos + after)
        at = np.concatenate([np.flatnonzero(cover), np.flatnonzero(need)])
        kind = np.arange(len(at)) >= cover.sum()
        return _frame(doc=doc[at], sub=sub[at], lo=lo[at].astype(np.int32), hi=hi[at].astype(np.int32), pos=pos[at].astype(np.int32), h=h[at], need=kind)

    return rows.mapInArrow(lambda batches: _by_key(batches, settle), "doc long, sub long, lo int, hi int, pos int, h long, need boolean")


_WANTED = "key long, doc long, sub long, pos int, a int, b int"


def _with_texts(need: DataFrame, texts: DataFrame, s: Search, schema: str, make: Callable) -> DataFrame:
    """make(out, i, symbols, text start, text end, salt, key, pos, a, b) for each wanted anchor, where its text is."""
    wanted = need.groupBy("doc", "sub").agg(F.collect_set(F.struct("key", "pos", "a", "b")).alias("w"))  # a text's own anchors
    once = texts.select(F.col("doc").alias("t_doc"), F.col("sub").alias("t_sub"), "salt", "text")
    rows = once.join(wanted, (F.col("t_doc") == F.col("doc")) & (F.col("t_sub") == F.col("sub"))).select("doc", "sub", "salt", "w", "text")
    names = [x.split()[0] for x in schema.split(", ")]
    arrow = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [arrow[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, subs, salts = (batch.column(i).to_pylist() for i in range(3))
            wants = batch.column(3)
            offsets, inner = wants.offsets.to_numpy(), wants.values
            keys, places, a, b = (inner.field(i).to_numpy() for i in range(4))
            out: list[list] = [[] for _ in names]
            for first, x in s.symbols(batch.column(4).to_pylist()):
                for j in range(len(x.starts)):
                    i = first + j
                    for q in range(int(offsets[i]), int(offsets[i + 1])):
                        make(out, (docs[i], subs[i]), x, int(x.starts[j]), int(x.ends[j]), salts[i], int(keys[q]), int(places[q]), int(a[q]), int(b[q]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return rows.mapInArrow(run, schema)


def pieces(need: DataFrame, texts: DataFrame, s: Search) -> DataFrame:
    """The wanted anchors with their range of windows cut in parts, each under the hash of what its windows share."""

    def make(out, text, x, start, end, salt, key, pos, a, b):
        at, size = start + pos, -(-(b - a + 1) // FAN)
        for lo in range(a, b + 1, size):
            hi = min(b, lo + size - 1)
            i, j = at - lo, at + s.width - hi
            if i >= start and j <= end:  # else no window of this part lies in the text
                h = x.hash(np.array([i]), np.array([j]), (lo + 1) * 4096 + hi)
                made = int(textkit.signed(_salted(h, np.array([salt])))[0])
                for column, v in zip(out, (made, *text, pos, lo, hi), strict=True):
                    column.append(v)

    return _with_texts(need, texts, s, _WANTED, make)


def contexts(need: DataFrame, texts: DataFrame, s: Search) -> DataFrame:
    """The wanted anchors with the symbols before them, reversed, and from them on."""

    def make(out, text, x, start, end, salt, key, pos, a, b):
        at = start + pos
        lo, hi = max(start, at - b), min(end, at + s.width - a)
        for column, v in zip(out, (key, *text, pos, a, b, s.pack(x.values[lo:at][::-1]), s.pack(x.values[at:hi])), strict=True):
            column.append(v)

    return _with_texts(need, texts, s, f"{_WANTED}, left binary, right binary", make)


def equal_windows(leaves: DataFrame, s: Search) -> DataFrame:
    """Stretches of keys that stand for one window each: all but the first, or all if two texts hold it."""
    place = F.struct("doc", "sub", "pos")
    if s.elsewhere:
        sums = leaves.groupBy("key").agg(F.min(F.struct("doc", "sub")).alias("x"), F.max(F.struct("doc", "sub")).alias("y")).filter("x <> y").select("key")
        hit = leaves.join(sums, "key", "left_semi")
    else:
        sums = leaves.groupBy("key").agg(F.min(place).alias("x"))
        hit = leaves.join(sums, "key").filter(place > F.col("x"))
    return hit.select("doc", "sub", (F.col("pos") - F.col("a")).alias("lo"), (F.col("pos") - F.col("a") + s.width).alias("hi"))


def closer(found: DataFrame, texts: DataFrame, s: Search) -> DataFrame:
    """Stretches (doc, sub, lo, hi) from the anchors whose keys have more than one context."""
    need = found.filter("need").select(F.col("h").alias("key"), "doc", "sub", "pos", F.lit(0).alias("a"), F.lit(s.width - s.k).alias("b"))
    ready, leaves = None, None
    add = lambda x, y: y if x is None else x.unionByName(y)
    while True:
        hot = stored(need.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LIMIT).select("key"), f"{s.name}-hot")
        if hot.isEmpty():
            ready = add(ready, need)
            break
        ready = add(ready, need.join(hot, "key", "left_anti"))
        # at most twice: the range of a key is under FAN * FAN windows
        cut = stored(pieces(need.join(hot, "key", "left_semi"), texts, s), f"{s.name}-pieces")
        again = cut.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
        cut = stored(cut.join(again, "key", "left_semi"), f"{s.name}-shared")
        leaves = add(leaves, cut.filter("a = b"))
        need = cut.filter("a < b")
    given = contexts(ready, texts, s).repartition("key").sortWithinPartitions("key", "doc", "sub", "pos")

    def settle(t: pa.Table) -> pa.RecordBatch:
        key, doc, sub, pos, a, b = (t.column(i).to_numpy() for i in range(6))
        group = np.cumsum(_changes(key)) - 1
        rank, text = np.cumsum(_changes(key, doc, sub, pos)), np.cumsum(_changes(key, doc, sub))
        before, after = s.judge(group, rank, text, a, b, t.column(6).to_pylist(), t.column(7).to_pylist())
        out = after >= 0
        return _frame(doc=doc[out], sub=sub[out], lo=(pos[out] - before[out]).astype(np.int32), hi=(pos[out] + after[out]).astype(np.int32))

    out = given.mapInArrow(lambda batches: _by_key(batches, settle), "doc long, sub long, lo int, hi int")
    return out if leaves is None else out.unionByName(equal_windows(leaves, s))


def by_classes(look: Callable, width: int, elsewhere: bool) -> Callable:
    """A judge from look(group, left, right), which yields (l, class of the window that starts l before the anchor, or -1)."""

    def judge(group, rank, text, a, b, left, right):
        least, most = np.full(len(group), width + 1), np.full(len(group), -1)
        for l, cls in look(group, left, right):
            valid = np.flatnonzero((cls >= 0) & (a <= l) & (l <= b))
            if not len(valid):
                continue
            _, where, back = np.unique(cls[valid], return_index=True, return_inverse=True)
            if elsewhere:
                lo, hi = np.full(len(where), len(group)), np.full(len(where), -1)
                np.minimum.at(lo, back, text[valid])
                np.maximum.at(hi, back, text[valid])
                hit = valid[(lo < hi)[back]]
            else:
                hit = valid[rank[valid] > rank[valid[where[back]]]]
            least[hit] = np.minimum(least[hit], l)
            most[hit] = np.maximum(most[hit], l)
        return most, np.where(most >= 0, width - least, -1)

    return judge


def covered(texts: DataFrame, s: Search) -> DataFrame:
    """doc, sub and the covered stretches, an array of (lo, hi) that may overlap, of texts that have any."""
    found = stored(resolved(found_anchors(texts, s), crowded_buckets(texts, s), s), f"{s.name}-anchors")
    rows = found.filter("not need").select("doc", "sub", "lo", "hi").unionByName(closer(found, texts, s))
    return rows.groupBy("doc", "sub").agg(F.collect_set(F.struct("lo", "hi")).alias("stretches"))  # a text's own stretches


def merged(stretches: list | None, n: int) -> list[tuple[int, int]]:
    """Maximal runs within 0..n."""
    out: list[list[int]] = []
    for a, b in sorted((x["lo"], x["hi"]) for x in stretches or []):
        a, b = max(0, a), min(n, b)
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def applied(docs: DataFrame, stretches: DataFrame, fn: Callable[[str | None, list | None, bool], tuple], schema: str) -> DataFrame:
    """doc_id and what fn makes of each text, its covered stretches, and whether an equal row came before."""
    keyed = docs.select("doc_id", id_key().alias("doc"), F.xxhash64("text").alias("sub"), "text")
    many = keyed.groupBy("doc", "sub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc", "sub")
    marks = stretches.select(F.col("doc").alias("s_doc"), F.col("sub").alias("s_sub"), "stretches")
    rows = keyed.withColumn("again", F.lit(False))
    if not many.isEmpty():
        # only equal rows are numbered; which of them is the first is all one
        turn = F.row_number().over(W.partitionBy("doc", "sub").orderBy("doc_id")) > 1
        rows = rows.join(many, ["doc", "sub"], "left_anti").unionByName(keyed.join(many, ["doc", "sub"], "left_semi").withColumn("again", turn))
    rows = rows.join(marks, (F.col("doc") == F.col("s_doc")) & (F.col("sub") == F.col("s_sub")), "left").select("doc_id", "text", "stretches", "again")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(ids, texts, found, again):
        made = [fn(t, f, x) for t, f, x in zip(texts, found, again, strict=True)]
        return {"doc_id": ids} | {n: [m[i] for m in made] for i, n in enumerate(names)}

    return arrow_map(rows, run, f"doc_id long, {schema}")
