"""MinHash near-duplicate detection with bottom-k sketches from one hash function.

Texts with one lower-cased word sequence form a class, a node of its own whatever the ids of its rows. Its sketch is the K
smallest shingle hashes. Of two documents with similarity 0.8 the sketches share at least AGREE of K values, but for a chance of
5e-6 where one set lies within the other and below 1e-8 where the sets are of one size or the similarity is 0.85. So of
its values each document enters only its K - AGREE + 1 rarest in the inverted lists: two linked documents still meet in
a list, while shingles common to the corpus head no list. A set of under K shingles is its own sketch and takes the
exact bound: a fifth of it and one, and as many more as the sketch of a linked larger set may lack. Within a list,
overlap of sketches (the upper halves of their values) estimates similarity from the K smallest values of the union;
pairs that come within LOOSE grow coarse groups, of which only a spanning forest leaves the task. Exact Jaccard on full
sets then confirms links inside each coarse group, again as a spanning forest: a pair is only skipped once links already
join it, so components are those of all links.

Lists and groups beyond BLOCK members are dealt in blocks, each with the same LEADERS of the group; what links do not
join to the group's largest part by then is held against every block. A large group of near copies so costs what its
size is, and only members that belong to no such part cost a pass over the group for each BLOCK of them.

Null or empty texts have no shingles and no links. Rows that share or lack a doc_id are linked by their own texts only; an
id never joins two groups. A group's component_id is the smallest id in it, null if no row has one; of such a group the
rows of the smallest text hash are kept. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textkit
from .common import LAST_ID, arrow_map, id_key, map_batches, stored
from .components import components

K, AGREE, LOOSE, BLOCK, LEADERS = 64, 36, 0.52, 4096, 64
U = np.uint64


def shingle_sets(texts: list[str | None], width: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text: the 16-byte digest of its lower-cased words, and its sorted distinct shingle hashes."""
    for _, codes, offsets in textkit.steps(texts):
        codes = textkit.LOWER[codes]
        starts, ends = textkit.words(codes)
        h = textkit.hashes(codes, starts, ends)
        runs = textkit.shingle_hashes(h, width)
        first = np.searchsorted(starts, offsets)
        for i in range(len(offsets) - 1):
            a, b = int(first[i]), int(first[i + 1])
            n = b - a
            if n == 0:
                yield b"", np.zeros(0, U)
                continue
            digest = hashlib.md5(b" ".join(codes[offsets[i] : offsets[i + 1]].tobytes().split())).digest()
            if n < width:
                yield digest, textkit.mixed(textkit.shingle_hashes(h[a:b], n) + U(n))
            else:
                yield digest, np.unique(runs[a : b - width + 1])


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, sub (hash of the text), cls, n (set size) and sketch of each row."""

    def run(ids, subs, texts):
        out: dict = {"doc_id": ids, "sub": subs, "cls": [], "n": [], "sketch": []}
        for digest, values in shingle_sets(texts, width):
            out["cls"].append(digest)
            out["n"].append(len(values))
            out["sketch"].append(textkit.signed(values[:K]))
        return out

    return arrow_map(docs.select("doc_id", F.xxhash64("text").alias("sub"), "text"), run, "doc_id long, sub long, cls binary, n long, sketch array<long>")


def postings(reps: DataFrame) -> DataFrame:
    """value and node: the rarest values of each sketch that some other sketch holds too."""
    each = reps.select("node", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    common = each.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = each.join(common, "value").groupBy("node").agg(F.max("m").alias("m"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("found"))
    # of the values a document must index, those held by it alone come first and need no list
    quota = F.expr(f"if(m >= {K}, {K - AGREE + 1}, m div 5 + 1 + greatest(0, m * 5 div 4 - {K})) - (m - size(found))").cast("int")
    chosen = shared.withColumn("quota", quota).filter("quota > 0").select("node", F.explode(F.slice("found", 1, F.col("quota"))).alias("v"))
    return chosen.select("node", F.col("v.value").alias("value"))


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, flat values, offsets) of each run of equal keys, across batches. Columns: keys, node, values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        if held and any(held[-1].column(i)[-1] != batch.column(i)[0] for i in range(n_keys)):
            yield _one(held, n_keys)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield _one(held, n_keys)
                held = []
    if held:
        yield _one(held, n_keys)


def _one(held: list[pa.RecordBatch], at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nodes = np.concatenate([b.column(at).to_numpy() for b in held])
    flat = np.concatenate([b.column(at + 1).flatten().to_numpy() for b in held])
    sizes = np.concatenate([b.column(at + 1).value_lengths().to_numpy() for b in held])
    offsets = np.zeros(len(nodes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return nodes, flat, offsets


def forest(nodes: np.ndarray, flat: np.ndarray, offsets: np.ndarray, near: Callable) -> list[tuple[int, int]]:
    """Edges that join what links join: each member in turn is held against all members that no link has reached yet."""
    n = len(nodes)
    found: list[tuple[int, int]] = []
    left = np.arange(n)
    queue: list[int] = []
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        hub = queue.pop()
        if not len(left):
            break
        hit = near(hub, left)
        if hit.any():
            reached = left[hit]
            found += [(int(nodes[hub]), int(nodes[i])) for i in reached]
            queue += reached.tolist()
            left = left[~hit]
    return found


def by_sketch(nodes: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Edges between sketches whose union's K smallest values lie in both for at least LOOSE."""
    size = np.diff(offsets)
    table = np.full((len(nodes), K), np.iinfo(np.uint32).max, np.uint32)
    table[np.repeat(np.arange(len(nodes)), size), np.arange(len(flat)) - np.repeat(offsets[:-1], size)] = flat.view(np.uint32)

    def near(hub: int, left: np.ndarray) -> np.ndarray:
        own = table[hub, : size[hub]]
        rows = table[left]
        at = np.searchsorted(own, rows)
        valid = np.arange(K) < size[left][:, None]
        both = (own[np.minimum(at, len(own) - 1)] == rows) & valid
        # a value's rank in the union: its rank in the row, and those of the hub below it that the row lacks
        rank = np.arange(K) + at - (np.cumsum(both, axis=1) - both)
        union = size[left] + len(own) - both.sum(1)
        width = np.minimum(K, union)
        return (both & (rank < width[:, None])).sum(1) >= LOOSE * width

    return forest(nodes, flat, offsets, near)


def by_set(percent: int) -> Callable:
    def run(nodes: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        size = np.diff(offsets)
        _, codes = np.unique(flat, return_inverse=True)
        mark = np.zeros(int(codes.max(initial=0)) + 1, bool)
        state = {"of": None, "flat": None, "starts": None}

        def near(hub: int, left: np.ndarray) -> np.ndarray:
            if state["of"] is None or len(left) * 2 < len(state["of"]):
                state["of"] = left
                state["flat"] = np.concatenate([codes[offsets[i] : offsets[i + 1]] for i in left])
                state["starts"] = np.concatenate([[0], np.cumsum(size[left])[:-1]]).astype(np.int64)
            mark[codes[offsets[hub] : offsets[hub + 1]]] = True
            both = np.add.reduceat(mark[state["flat"]].astype(np.int64), state["starts"])
            mark[codes[offsets[hub] : offsets[hub + 1]]] = False
            if len(left) != len(state["of"]):
                both = both[np.searchsorted(state["of"], left)]
            return 100 * both >= percent * (size[left] + size[hub] - both)

        return forest(nodes, flat, offsets, near)

    return run


def found_edges(given: DataFrame, key: str, values: str, links: Callable) -> DataFrame:
    """Distinct edges (a, b) that links() finds among the rows of each (key, tile)."""
    given = given.select(key, "tile", "node", values).repartition(key, "tile").sortWithinPartitions(key, "tile", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            table = np.array(held, np.int64).reshape(-1, 2)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(table.min(1) if len(table) else table[:, 0]), pa.array(table.max(1) if len(table) else table[:, 0])], names=["a", "b"])

        for nodes, flat, offsets in grouped(batches, 2):
            if len(nodes) > 1:
                held += links(nodes, flat, offsets)
                if len(held) > 50_000:
                    yield out()
        yield out()

    return map_batches(given, run, "a long, b long").distinct()


def edges_of(rows: DataFrame, membership: DataFrame, key: str, values: str, links: Callable) -> DataFrame:
    """Edges that join what links() joins within the groups by key. rows: key, node, values; membership: the same without values."""
    sizes = membership.groupBy(key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    small = rows.join(sizes.filter(F.col("size") <= BLOCK).select(key), key).withColumn("tile", F.lit(0))
    first = found_edges(small, key, values, links)
    big = stored(sizes.filter(F.col("size") > BLOCK).select(key, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "big")
    if big.isEmpty():
        return first
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rows.join(big, key).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    held = membership.join(big, key)
    chosen = held.groupBy(key, F.pmod(F.xxhash64("node", F.lit(1)), F.lit(LEADERS)).alias("seat")).agg(F.min("node").alias("node"), F.first("blocks").alias("blocks"))
    leaders = rows.join(chosen.select(key, "node", "blocks"), [key, "node"]).select(key, "node", values, each("blocks").alias("tile"))
    joined = stored(found_edges(members.select(key, "node", values, F.col("own").alias("tile")).unionByName(leaders), key, values, links), "led")
    parts = components(joined)
    named = held.join(parts, "node", "left").select(key, "node", "blocks", F.coalesce("component", "node").alias("part"))
    largest = named.groupBy(key, "part").agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.max_by("part", F.struct("n", "part")).alias("largest"))
    rest = stored(named.join(largest, key).filter("part <> largest").select(key, "node", "blocks"), "rest")
    turns = rest.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("turns"))
    tile = F.col("turn") * F.col("blocks") + F.col("block")
    all_rows = members.join(turns, key).select(key, "node", values, "blocks", F.col("own").alias("block"), each("turns").alias("turn"))
    rest_rows = rows.join(rest, [key, "node"]).join(turns, key).select(key, "node", values, "blocks", F.pmod(F.xxhash64("node", F.lit(2)), F.col("turns")).cast("int").alias("turn"), each("blocks").alias("block"))
    late = found_edges(all_rows.unionByName(rest_rows).withColumn("tile", tile), key, values, links)
    return first.unionByName(joined).unionByName(late).distinct()


def groups(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, sub, n_shingles, component_id and low of each row; low is the hash of the text that stands for the group."""
    if percent < 80:
        raise ValueError("AGREE and LOOSE hold for similarities of 0.8 or more")
    held = stored(sketches(docs, width), "sketches")
    full = held.filter("n > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sub", "n", "sketch")).alias("r")
    # numbered once, as it is written
    reps = stored(full.groupBy("cls").agg(first).select("cls", F.monotonically_increasing_id().alias("node"), "r.*"), "classes")
    tops = reps.select("node", F.transform("sketch", lambda v: F.shiftright(v, 32).cast("int")).alias("sketch"))
    index = stored(postings(reps), "postings")
    coarse = components(edges_of(index.join(tops, "node"), index, "value", "sketch", by_sketch))

    def sets(nodes, groups, texts):
        own = [i for i, n in enumerate(nodes) if not i or nodes[i - 1] != n]  # equal rows stand next to each other
        values = [textkit.signed(v) for _, v in shingle_sets([texts[i] for i in own], width)]
        return {"node": [nodes[i] for i in own], "group_id": [groups[i] for i in own], "values": values}

    coarse = coarse.withColumnRenamed("component", "group_id")
    wanted = coarse.join(reps.select("node", F.coalesce("doc_id", F.lit(LAST_ID)).alias("w_id"), F.col("sub").alias("w_sub")), "node")
    chosen = docs.select(id_key().alias("id"), F.xxhash64("text").alias("sub"), "text").join(wanted, (F.col("id") == F.col("w_id")) & (F.col("sub") == F.col("w_sub")))
    whole = arrow_map(chosen.select("node", "group_id", "text"), sets, "node long, group_id long, values array<long>")
    found = components(edges_of(whole, coarse, "group_id", "values", by_set(percent)))
    named = reps.select("cls", F.col("node").alias("n1"), F.struct("no_id", "doc_id", "sub").alias("best")).join(found, F.col("n1") == F.col("node"), "left").select("cls", "best", F.coalesce("component", "n1").alias("component"))
    best = named.groupBy("component").agg(F.min("best").alias("best"))
    labels = named.select("cls", "component").join(best, "component").select("cls", F.col("best.doc_id").alias("component_id"), F.col("best.sub").alias("low"))
    rows = full.select("doc_id", "sub", "cls", F.col("n").alias("n_shingles")).join(labels, "cls").drop("cls")
    return rows.unionByName(held.filter("n = 0").select("doc_id", "sub", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("sub").alias("low")))


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row: components of links of at least `percent` similarity."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull() & (F.col("sub") == F.col("low")))
    return groups(docs, width, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def first_of_group(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs for each group, with its own columns: of the smallest id its smallest text hash, of equal rows any. Rows without words all stay."""
    rows = stored(groups(docs, width, percent).select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("g_id"), F.col("sub").alias("g_sub"), (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("sub") == F.col("low"))).alias("first"), (F.col("n_shingles") > 0).alias("words")), "grouped")
    gone = rows.filter("not first").select("g_id", "g_sub").distinct()
    again = rows.filter("first and words").groupBy("g_id", "g_sub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g_id", "g_sub")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), id_key().alias("id"), F.xxhash64("text").alias("sub"))
    own = (F.col("id") == F.col("g_id")) & (F.col("sub") == F.col("g_sub"))
    kept = keyed.join(gone, own, "left_anti")
    if not again.isEmpty():
        turn = F.row_number().over(W.partitionBy("id", "sub").orderBy(F.to_json("row")))
        one = kept.join(again, own, "left_semi").withColumn("turn", turn).filter("turn = 1").drop("turn")
        kept = kept.join(again, own, "left_anti").unionByName(one)
    return kept.select("row.*")
