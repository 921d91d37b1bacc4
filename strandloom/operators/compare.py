"""All-versus-all comparison of samples.

Two kernels give the same rows; each genome goes to the one that moves less (`_plan`).

Tiles cut scaffolds into blocks of cells and samples into blocks, and multiply indicator matrices: one task holds two blocks
of samples by one block of cells, so a position that all samples cover is no hot key, and only partial sums are shuffled. A
row is sent to as many tiles as there are blocks of samples.

Strips are for genomes in which a position is covered by few of many samples. The samples of each position are listed in
order, samples are cut into strips of about equal work, and a strip gets of each list what begins with its own first sample.
All positions of a pair meet in the strip of its first sample, so sums are whole there and nothing else is shuffled.

With `open_samples`, only tiles and strips that hold one of them are formed: new samples meet all others, old ones do not
meet again. `joined_pairs` joins positions with themselves instead; it gives the same rows and stands for tests.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import masks
from ..schemas import CHANNELS
from .matrix import MIN_COV
from .packing import coded, merged, pack, unpack

METHODS = ("popani", "conani")
CALCULATIONS = ("ani", "gene", "ibs")
#: Joint positions (two samples at one position) that a strip is to hold, that one pass over it is to sum, and that one step of a pass forms.
STRIP, PASS, STEP = 16_000_000, 2_000_000, 2_000_000
#: So many rows are packed at a time, meet in a bucket of positions, and are given as results at a time.
LISTED, BUCKET, GIVEN = 500_000, 200_000, 200_000
#: Positions that agree but for so many bits go to one bucket.
NEAR = 6
#: One position in so many is counted to tell which kernel a genome goes to, and into how many strips it is cut.
COUNTED = 16
#: A row sent to a tile costs as much as so many joint positions; strips are left to genomes with fewer than CROWD samples at any counted position.
TILE_COST, CROWD = 8, 100_000
#: A genome of up to HELD rows, which one task can hold, is cut into no more than COPIES strips: long lists go to all of them, and the passes bound what a strip sums at a time.
HELD, COPIES = 16_000_000, 16


def alleles(positions: DataFrame, method: str = "popani", min_cov: int = MIN_COV) -> DataFrame:
    """What the method compares at each covered position: the mask, the consensus bit, or the four counts."""
    rows = positions.filter(masks.coverage() >= min_cov)
    if method == "popani":
        return rows.select("sample_id", "genome", "chrom", "pos", masks.mask().alias("allele"))
    if method == "conani":
        return rows.select("sample_id", "genome", "chrom", "pos", masks.consensus().alias("allele"))
    if method.startswith("cosani_"):
        return rows.select("sample_id", "genome", "chrom", "pos", *CHANNELS)
    raise ValueError(f"unknown method {method}")


def joint(rows: DataFrame, *keep: str) -> DataFrame:
    """Positions that two samples cover, the smaller name first; columns of the two end in 1 and 2."""
    rest = [c for c in rows.columns if c not in ("sample_id", "genome", "chrom", "pos", *keep)]
    side = lambda i: rows.select("genome", "chrom", "pos", *(keep if i == 1 else ()), F.col("sample_id").alias(f"sample_{i}"), *[F.col(c).alias(f"{c}{i}") for c in rest])
    return side(1).join(side(2), ["genome", "chrom", "pos"]).filter("sample_1 < sample_2")


def _shared(method: str):
    if method.startswith("cosani_"):
        least = float(method.split("_", 1)[1])
        dot = sum((F.col(f"{c}1") * F.col(f"{c}2")).cast("double") for c in CHANNELS)
        size = lambda i: sum((F.col(f"{c}{i}") * F.col(f"{c}{i}")).cast("double") for c in CHANNELS)
        return dot >= F.lit(least) * F.sqrt(size(1) * size(2))
    return F.col("allele1").bitwiseAND(F.col("allele2")) != 0


def joined_pairs(positions: DataFrame, method: str = "popani", min_cov: int = MIN_COV) -> DataFrame:
    """pairs() by a join on positions: n samples at a position make n (n - 1) / 2 rows."""
    both = joint(alleles(positions, method, min_cov))
    out = both.groupBy("genome", "sample_1", "sample_2").agg(F.count(F.lit(1)).alias("total_positions"), F.count_if(_shared(method)).alias("share_allele_pos"))
    return out.withColumn("genome_ani", masks.ani(F.col("share_allele_pos"), F.col("total_positions")))


def _subsets() -> tuple[np.ndarray, np.ndarray]:
    """For each mask, which of the 15 base sets it holds; and the sign of each set in the count of shared positions."""
    holds = np.array([[(m & s) == s for s in range(1, 16)] for m in range(16)], np.float32)
    return holds, np.array([1 if bin(s).count("1") % 2 else -1 for s in range(1, 16)], np.float32)


def _sharing(method: str):
    """(first samples by cells, second samples by cells) to the number of cells that each pair shares. Values are masks, or counts in a last axis."""
    if method.startswith("cosani_"):
        least = float(method.split("_", 1)[1])

        def share(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            out = np.zeros((len(x), len(y)))
            step = max(1, 4_000_000 // max(1, len(x) * len(y)))
            for c in range(0, x.shape[1], step):
                u, v = x[:, None, c : c + step], y[None, :, c : c + step]
                dot, size_u, size_v = (sum(p[..., k] * q[..., k] for k in range(4)) for p, q in ((u, v), (u, u), (v, v)))
                out += ((dot >= least * np.sqrt(size_u * size_v)) & (size_u > 0) & (size_v > 0)).sum(2)
            return out
    else:
        holds, signs = _subsets()

        def share(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return sum(sign * (holds[x, k] @ holds[y, k].T) for k, sign in enumerate(signs))

    return share


def _dealt(rows: DataFrame, unit: str, samples_per_block: int, cells_per_block: int | None, open_samples: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Rows by genome, unit, block of cells and tile (tile_1 <= tile_2) of blocks of samples; and the samples' numbers, open ones first."""
    catalog = rows.select("genome", "sample_id").distinct()
    late = F.lit(0)
    if open_samples is not None:
        marked = open_samples.select("genome", "sample_id").distinct().withColumn("late", F.lit(0))
        catalog, late = catalog.join(marked, ["genome", "sample_id"], "left"), F.coalesce("late", F.lit(1))
    idx = catalog.select("genome", "sample_id", late.alias("late")).withColumn("i", F.row_number().over(W.partitionBy("genome").orderBy("late", "sample_id")) - 1)
    sizes = idx.groupBy("genome").agg((F.floor(F.max("i") / samples_per_block) + 1).cast("int").alias("blocks"), F.count_if(F.col("late") == 0).alias("n_open"))
    dealt = rows.join(idx.drop("late"), ["genome", "sample_id"]).join(F.broadcast(sizes), "genome").withColumn("own", F.floor(F.col("i") / samples_per_block).cast("int"))  # a row a genome
    tile = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("tile_1"), F.greatest("own", o).alias("tile_2")))).alias("tile")
    values = [c for c in rows.columns if c not in ("genome", "sample_id", "chrom", "pos", "gene")]
    block = F.floor(F.col("pos") / cells_per_block) if cells_per_block else F.lit(0).cast("long")
    dealt = dealt.select("genome", F.col(unit).alias("unit"), block.alias("cell_block"), tile, "n_open", "pos", "i", *values).filter(F.col("tile.tile_1") * samples_per_block < F.col("n_open"))
    return dealt.select("genome", "unit", "cell_block", "tile.tile_1", "tile.tile_2", "pos", "i", *values), idx


def _tables(pdf: pd.DataFrame, key: tuple, samples_per_block: int) -> tuple[np.ndarray, ...]:
    """Numbers of the samples of both blocks, and their values by cell (0 where not covered)."""
    cells, at = np.unique(pdf["pos"].to_numpy(), return_inverse=True)
    i = pdf["i"].to_numpy()
    values = pdf["allele"].to_numpy(np.int64)[:, None] if "allele" in pdf else pdf[list(CHANNELS)].to_numpy(np.float64)
    out = []
    for block in key[3:5]:
        on = i // samples_per_block == block
        names, row = np.unique(i[on], return_inverse=True)
        table = np.zeros((len(names), len(cells), values.shape[1]), values.dtype)
        table[row, at[on]] = values[on]
        out += [names, table[..., 0] if "allele" in pdf else table]
    return (cells, *out)


def _named(sums: DataFrame, idx: DataFrame, *columns: str) -> DataFrame:
    """Sample names for numbers, the smaller name first; only pairs with an open sample, which is then the first."""
    first, second = (idx.filter(which).select("genome", F.col("i").alias(f"i{k}"), F.col("sample_id").alias(f"s{k}")) for k, which in ((1, "late = 0"), (2, "true")))
    out = sums.join(first, ["genome", "i1"]).join(second, ["genome", "i2"])
    return out.select("genome", F.least("s1", "s2").alias("sample_1"), F.greatest("s1", "s2").alias("sample_2"), *columns)


def _plan(rows: DataFrame, unit: str, samples_per_block: int, open_samples: DataFrame | None, kernel: str | None) -> tuple[DataFrame, DataFrame]:
    """Genomes with their kernel and the first sample of each strip, a row a genome; and the rows with `late`, 1 where the sample is not open.

    Only the choice of kernel and where strips are cut rest on the counted positions; the work is done on all of them, and samples and genomes
    that the counted positions lack have their place among the strips by name."""
    late = F.lit(0)
    if open_samples is not None:
        marked = open_samples.select("genome", "sample_id").distinct().withColumn("is_open", F.lit(1))
        rows, late = rows.join(marked, ["genome", "sample_id"], "left").drop("late"), F.when(F.col("is_open").isNull(), 1).otherwise(0)
    rows = rows.withColumn("late", late).drop("is_open")
    counted = rows.filter(F.pmod(F.xxhash64("genome", "chrom", "pos"), F.lit(COUNTED)) == 0)
    lists = counted.groupBy("genome", "chrom", "pos", *({unit} - {"chrom"})).agg(F.collect_list(F.struct("late", "sample_id")).alias("l"))
    weights = lists.select("genome", F.explode("l").alias("s")).groupBy("genome", "s.sample_id", "s.late").agg((F.count(F.lit(1)) * COUNTED).alias("w"))
    met = lists.select("genome", F.size("l").cast("double").alias("n")).groupBy("genome").agg((F.sum(F.expr("n * (n - 1) / 2")) * COUNTED).alias("joint"), F.max("n").alias("most"))
    sizes = weights.groupBy("genome").agg(F.sum("w").alias("all_w"), F.count(F.lit(1)).alias("samples")).join(met, "genome", "left")
    dealt = F.col("all_w") * F.ceil(F.col("samples") / samples_per_block)
    listed = (F.coalesce("most", F.lit(0.0)) < CROWD) & (F.coalesce("joint", F.lit(0.0)) <= TILE_COST * dealt) if kernel is None else F.lit(kernel == "strips")
    sizes = sizes.select("genome", "all_w", listed.alias("listed"), F.least(F.ceil(F.coalesce("joint", F.lit(0.0)) / STRIP) + 1, F.col("samples"), F.when(F.col("all_w") <= HELD, COPIES)).alias("strips"))
    order = W.partitionBy("genome").orderBy("late", "sample_id")
    place = weights.withColumn("before", F.sum("w").over(order) - F.col("w")).join(F.broadcast(sizes), "genome")  # a row a genome
    place = place.withColumn("strip", F.floor(F.col("before") * F.col("strips") / F.col("all_w")))
    firsts = place.groupBy("genome", "listed", "all_w", "strip").agg(F.min(F.struct("late", "sample_id")).alias("first"))
    return firsts.groupBy("genome", "listed", "all_w").agg(F.sort_array(F.collect_list("first")).alias("firsts")), rows  # a row a genome


def _strips(rows: DataFrame, plan: list, unit: str, placed: bool) -> DataFrame:
    """genome, strip and packed lists: of some positions, the samples and their values from the strip's first on. `placed` keeps units and places.

    Rows travel packed by blocks of neighbouring positions, lists packed by strip: a few bytes a row."""
    values = [c for c in rows.columns if c not in ("genome", "sample_id", "chrom", "pos", "gene", "late")]
    units = [unit] if unit != "chrom" else []
    firsts = {r.genome: [(f.late, f.sample_id) for f in r.firsts] for r in plan}
    buckets = int(sum(r.all_w for r in plan if r.listed) // BUCKET) + 1
    strings = ["genome", *units, "chrom", "sample_id"]

    def packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= LISTED:
                yield _packed_rows(pa.Table.from_batches(held), strings, values)
                held, n = [], 0
        if n:
            yield _packed_rows(pa.Table.from_batches(held), strings, values)

    def cut(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [unpack(v) for batch in batches for v in batch.column("packed").to_pylist()]
        out = _cut(found, firsts, len(values), placed) if found else []
        yield pa.record_batch([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int32(), pa.binary()))], ["genome", "strip", "packed"])

    whole, kept = {"tinyint", "smallint", "int", "bigint"}, dict(rows.dtypes)
    kinds = [F.col(c).cast("tinyint").alias(c) if c == "allele" else F.col(c) if kept[c] in whole else F.col(c).cast("double").alias(c) for c in values]
    bucket = F.pmod(F.xxhash64("genome", "chrom", F.shiftright(F.col("pos").cast("bigint"), NEAR)), F.lit(buckets)).cast("int").alias("bucket")
    sent = rows.select(bucket, *strings, F.col("pos").cast("bigint").alias("pos"), F.col("late").cast("tinyint").alias("late"), *kinds).mapInArrow(packed_rows, "bucket int, packed binary")
    lists = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(cut, "genome string, strip int, packed binary")
    return lists.repartition(max(1, sum(len(r.firsts) for r in plan if r.listed)), "genome", "strip")


def _packed_rows(table: pa.Table, strings: list[str], values: list[str]) -> pa.RecordBatch:
    """The rows of each bucket in one value."""
    bucket = table.column("bucket").to_numpy()
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    names = [_coded(table.column(c)) for c in strings]
    codes = [c[order] for c, _ in names]
    numbers = [table.column(c).to_numpy()[order] for c in ("pos", "late", *values)]
    out = []
    for lo, hi in zip(at, np.append(at[1:], len(bucket)), strict=True):
        columns = [x[lo:hi] for x in numbers]
        for (_, known), c in zip(names, codes, strict=True):
            own, back = coded(c[lo:hi])
            columns += [known.take(pa.array(own)), back]
        out.append(pack(columns))
    return pa.record_batch([pa.array(bucket[at], pa.int32()), pa.array(out, pa.binary())], ["bucket", "packed"])


def _cut(found: list[list], firsts: dict[str, list[tuple]], n_values: int, placed: bool) -> list[tuple[str, int, bytes]]:
    """(genome, strip, packed lists): the list of samples of each position, once for each strip that one of its samples is in, from the strip's first on.

    The lists are packed as their sizes, how many samples of each are the strip's own open ones, the samples and their values; with units and positions if they are asked for."""
    numbers = [np.concatenate(x) for x in zip(*[f[: 2 + n_values] for f in found], strict=True)]
    pos, late, values = numbers[0], numbers[1], numbers[2:]
    known, codes = [], []
    for k in range(2 + n_values, len(found[0]), 2):
        every, own = merged([f[k] for f in found])
        known.append(every)
        codes.append(np.concatenate([at[f[k + 1]] for at, f in zip(own, found, strict=True)]))
    sample, places = codes[-1], [pos, *codes[-2::-1]]
    order = np.lexsort((sample, late, *places))
    sample, late, values, places = sample[order], late[order], [v[order] for v in values], [p[order] for p in places]
    new = np.concatenate(([True], np.any([p[1:] != p[:-1] for p in places], axis=0)))
    row = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], len(row))
    genome = places[-1]
    # a sample's strip is looked up once
    keys, back = np.unique((genome * 2 + late) * len(known[-1]) + sample, return_inverse=True)
    names, genomes, strip = known[-1].to_pylist(), known[0].to_pylist(), np.empty(len(keys), np.int64)
    for k, key in enumerate(keys.tolist()):
        head, name = divmod(key, len(names))
        strip[k] = bisect_right(firsts.get(genomes[head // 2], []), (head % 2, names[name]))
    of = strip[back]
    begins = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (of[1:] != of[:-1]))))
    held = np.concatenate(([0], np.cumsum(late == 0)))
    m, size = held[np.append(begins[1:], len(of))] - held[begins], end[row[begins]] - begins
    begins, m, size = (x[(m > 0) & (size > 1)] for x in (begins, m, size))
    order = np.lexsort((begins, of[begins], genome[begins]))
    begins, m, size = begins[order], m[order], size[order]
    goes = (genome[begins], of[begins])
    at = np.flatnonzero(np.concatenate(([True], (goes[0][1:] != goes[0][:-1]) | (goes[1][1:] != goes[1][:-1])))[: len(begins)])
    out = []
    for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(begins)], strict=True):
        b, n = begins[lo:hi], size[lo:hi]
        take = np.arange(n.sum()) + np.repeat(b - (np.cumsum(n) - n), n)
        own, samples = coded(sample[take])
        columns = [n, m[lo:hi], known[-1].take(pa.array(own)), samples, *[v[take] for v in values]]
        if placed:
            unit, units = coded(places[-2][b])
            columns += [known[1].take(pa.array(unit)), units, places[0][b]]
        out.append((genomes[goes[0][lo]], int(goes[1][lo]), pack(columns)))
    return out


class _Listed:
    """The lists of a strip: sizes, own, sample and values by place in the flat lists; names in order; unit, units and pos by list if they were kept."""

    def __init__(self, batches: Iterator[pa.RecordBatch], n_values: int, placed: bool):
        found = [unpack(v) for batch in batches for v in batch.column("packed").to_pylist()]
        joined = lambda k: np.concatenate([f[k] for f in found])
        coded_at = lambda at, k: np.concatenate([a[f[k]] for a, f in zip(at, found, strict=True)])
        self.sizes, self.own = joined(0), joined(1)
        self.names, at = merged([f[2] for f in found])
        self.sample = coded_at(at, 3)
        self.values = [joined(4 + k) for k in range(n_values)]
        if placed:
            self.units, at = merged([f[4 + n_values] for f in found])
            self.unit, self.pos = coded_at(at, 5 + n_values), joined(6 + n_values)

    def passes(self, method: str) -> Iterator[Iterator[tuple]]:
        """For some first samples at a time, of which all joint positions are in one pass: steps of (first, second, list, whether they share); first and second are places in the flat lists."""
        m, ends = self.own, np.cumsum(self.sizes)
        row = np.repeat(np.arange(len(m)), m)
        first = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(ends - self.sizes, m)
        others = ends[row] - first - 1
        formed = np.cumsum(np.bincount(self.sample[first], others, len(self.names)))
        turn = np.concatenate(([0], formed[:-1] // PASS)).astype(np.int64)[self.sample[first]]
        order = np.argsort(turn, kind="stable")
        turn = turn[order]
        at = np.flatnonzero(np.concatenate(([True], turn[1:] != turn[:-1])))
        shares = self._shares(method)
        for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(turn)], strict=True):
            now = order[lo:hi]
            yield self._steps(first[now], others[now], row[now], shares)

    def _shares(self, method: str):
        if method.startswith("cosani_"):
            least = float(method.split("_", 1)[1])
            x = [c.astype(np.float64) for c in self.values]
            size = sum(c * c for c in x)
            return lambda u, v: (sum(c[u] * c[v] for c in x) >= least * np.sqrt(size[u] * size[v])) & (size[u] > 0) & (size[v] > 0)
        x = self.values[0]
        if len(x) and 0 <= x.min() and x.max() < 128:
            x = x.astype(np.int8)
        return lambda u, v: (x[u] & x[v]) != 0

    @staticmethod
    def _steps(first: np.ndarray, others: np.ndarray, row: np.ndarray, shares) -> Iterator[tuple]:
        total = np.cumsum(others)
        lo = 0
        while lo < len(first):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + STEP, "right")))
            n = others[lo:hi]
            a = np.repeat(first[lo:hi], n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + a + 1
            yield a, b, np.repeat(row[lo:hi], n), shares(a, b)
            lo = hi


def _coded(column) -> tuple[np.ndarray, pa.Array]:
    made = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
    return made.indices.to_numpy(zero_copy_only=False).astype(np.int64), made.dictionary


def _fits(*sizes: int) -> None:
    product = 1
    for n in sizes:
        product *= max(1, n)
    if product >= 2**62:
        raise OverflowError("a strip holds more pairs of samples and units than a number can tell apart")


def _folded(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sums (key, total, shared) of parts, once a key."""
    key, total, share = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key, total, share = key[order], total[order], share[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[at], np.add.reduceat(total, at), np.add.reduceat(share, at)


def _batches(schema: pa.Schema, genome: str, names: pa.Array, pairs: np.ndarray, rest: dict) -> Iterator[pa.RecordBatch]:
    """Rows of pairs (numbers of two of the names, which are in order), some at a time."""
    a, b = np.divmod(pairs, max(1, len(names)))
    for lo in range(0, len(pairs), GIVEN):
        now = slice(lo, lo + GIVEN)
        columns = {"genome": pa.array([genome]).take(pa.array(np.zeros(len(a[now]), np.int64))), "sample_1": names.take(pa.array(np.minimum(a[now], b[now]))), "sample_2": names.take(pa.array(np.maximum(a[now], b[now])))}
        yield pa.table(columns | {k: v(now) for k, v in rest.items()}).cast(schema).combine_chunks().to_batches()[0]


def _summed_strips(rows: DataFrame, plan: list, method: str, unit: str, above: int) -> DataFrame:
    """The result of packed() by strips."""
    by_unit = unit != "chrom"
    n_values = 4 if method.startswith("cosani_") else 1

    def multiply(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = _Listed(batches, n_values, by_unit)
        sample, u = lists.sample, len(lists.names)
        _fits(2, len(lists.units) if by_unit else 1, u, u)
        for steps in lists.passes(method):
            parts, held = [], 0
            for a, b, row, shared in steps:
                k = sample[a] * u + sample[b]
                if by_unit:
                    k += lists.unit[row] * (u * u)
                k = np.sort(k * 2 + shared)
                same, odd = k >> 1, k & 1
                at = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
                parts.append((same[at], np.diff(np.append(at, len(k))), np.add.reduceat(odd, at)))
                held += len(at)
                if held > 2 * STEP:
                    parts = [_folded(parts)]
                    held = len(parts[0][0])
            k, total, share = _folded(parts) if len(parts) > 1 else parts[0]
            # a pair is in one pass, so that its sums are whole
            k, total, share = (x[total > above] for x in (k, total, share))
            where, k = np.divmod(k, u * u)
            rest = {"unit": lambda now, where=where: lists.units.take(pa.array(where[now]))} if by_unit else {}
            rest |= {"total_positions": lambda now, total=total: total[now], "share_allele_pos": lambda now, share=share: share[now]}
            yield from _batches(schema, key[0].as_py(), lists.names, k, rest)

    extra = [("unit", pa.string())] if by_unit else []
    schema = pa.schema([("genome", pa.string()), ("sample_1", pa.string()), ("sample_2", pa.string()), *extra, ("total_positions", pa.int64()), ("share_allele_pos", pa.int64())])
    listed = _strips(rows, plan, unit, by_unit)
    return listed.groupBy("genome", "strip").applyInArrow(multiply, f"genome string, sample_1 string, sample_2 string, {'unit string, ' if by_unit else ''}total_positions bigint, share_allele_pos bigint")


def _run_strips(rows: DataFrame, plan: list) -> DataFrame:
    """The result of shared_runs() by strips: all positions of a pair are in one, so its runs are whole."""

    def runs(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = _Listed(batches, 1, True)
        sample, u = lists.sample, len(lists.names)
        # neighbours get numbers that follow each other, and others do not
        order = np.lexsort((lists.pos, lists.unit))
        unit, pos = lists.unit[order], lists.pos[order]
        cell = np.empty(len(order), np.int64)
        cell[order] = np.cumsum(np.concatenate(([0], np.where((np.diff(unit) == 0) & (np.diff(pos) == 1), 1, 2))))
        cells = int(cell.max()) + 2
        _fits(2, u, u, cells)
        for steps in lists.passes("popani"):
            k = np.sort(np.concatenate([((sample[a] * u + sample[b]) * cells + cell[row]) * 2 + hit for a, b, row, hit in steps]))
            met, hit = k >> 1, (k & 1).astype(bool)
            pair = met // cells
            at = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            # places count up within a run and begin anew after it
            begins = ~hit | np.concatenate(([True], met[1:] != met[:-1] + 1)) | np.concatenate(([True], ~hit[:-1]))
            place = np.arange(len(k))
            length = np.where(hit, place - np.maximum.accumulate(np.where(begins, place, 0)) + 1, 0)
            longest = np.maximum.reduceat(length, at)
            yield from _batches(schema, key[0].as_py(), lists.names, pair[at], {"max_consecutive_length": lambda now, longest=longest: longest[now]})

    schema = pa.schema([("genome", pa.string()), ("sample_1", pa.string()), ("sample_2", pa.string()), ("max_consecutive_length", pa.int64())])
    return _strips(rows, plan, "chrom", True).groupBy("genome", "strip").applyInArrow(runs, "genome string, sample_1 string, sample_2 string, max_consecutive_length bigint")


def _by_kernel(rows: DataFrame, plan: list) -> tuple[DataFrame | None, DataFrame]:
    """The rows of the genomes that go to tiles, if there are any, and of those that go to strips."""
    tiled = [r.genome for r in plan if not r.listed]
    return rows.filter(F.col("genome").isin(tiled)) if tiled else None, rows.filter(~F.col("genome").isin(tiled)) if tiled else rows


def _placed(rows: DataFrame) -> DataFrame:
    """Rows that can meet others: those without a sample or a place meet none."""
    return rows.dropna(subset=["genome", "sample_id", "chrom", "pos"])


def packed(rows: DataFrame, method: str = "popani", *, unit: str = "chrom", samples_per_block: int = 256, cells_per_block: int | None = 4096, open_samples: DataFrame | None = None, kernel: str | None = None, above: int = 0) -> DataFrame:
    """genome, unit, sample_1, sample_2, total_positions, share_allele_pos, summed over each unit, of rows from alleles().

    Only sums of more than `above` positions are given. The kernel is chosen by genome if it is not named: `tiles` or `strips`."""
    rows = _placed(rows)
    if kernel == "tiles":
        return _tiled(rows, method, unit, samples_per_block, cells_per_block, open_samples, above)
    plan, marked = _plan(rows, unit, samples_per_block, open_samples, kernel)
    plan = plan.collect()  # a row a genome, with a name a strip
    crowded, sparse = _by_kernel(marked, plan)
    strips = _summed_strips(sparse, plan, method, unit, above)
    return strips if crowded is None else _tiled(crowded.drop("late"), method, unit, samples_per_block, cells_per_block, open_samples, above).unionByName(strips)


def _tiled(rows: DataFrame, method: str, unit: str, samples_per_block: int, cells_per_block: int | None, open_samples: DataFrame | None, above: int) -> DataFrame:
    """The result of packed() by tiles."""
    dealt, idx = _dealt(rows, unit, samples_per_block, cells_per_block, open_samples)
    share = _sharing(method)

    def multiply(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, names_a, x, names_b, y = _tables(pdf, key, samples_per_block)
        covered = [(t if t.ndim == 2 else t.sum(2)) > 0 for t in (x, y)]
        total = covered[0].astype(np.float32) @ covered[1].astype(np.float32).T
        if key[3] == key[4]:
            total = np.triu(total, 1)
        i, j = np.nonzero(total > 0)
        shared = np.rint(share(x, y)).astype(np.int64)
        return pd.DataFrame({"genome": key[0], "unit": key[1], "i1": names_a[i], "i2": names_b[j], "total": total[i, j].astype(np.int64), "share": shared[i, j]})

    partial = dealt.groupBy("genome", "unit", "cell_block", "tile_1", "tile_2").applyInPandas(multiply, "genome string, unit string, i1 int, i2 int, total bigint, share bigint")
    keys = ["genome", "i1", "i2"] if unit == "chrom" else ["genome", "unit", "i1", "i2"]
    sums = partial.groupBy(*keys).agg(F.sum("total").alias("total_positions"), F.sum("share").alias("share_allele_pos"))
    return _named(sums.filter(F.col("total_positions") > above), idx, *([] if unit == "chrom" else ["unit"]), "total_positions", "share_allele_pos")


def pairs(positions: DataFrame, method: str = "popani", min_cov: int = MIN_COV, above: int = 0) -> DataFrame:
    """genome, sample_1, sample_2, total_positions, share_allele_pos, genome_ani of pairs that share more than `above` covered positions."""
    out = packed(alleles(positions, method, min_cov), method, above=above)
    return out.withColumn("genome_ani", masks.ani(F.col("share_allele_pos"), F.col("total_positions")))


def gene_pairs(positions: DataFrame, min_cov: int = MIN_COV) -> DataFrame:
    """popANI of each gene; genes without overlap have no row. A gene is a block of its own."""
    rows = positions.filter(masks.coverage() >= min_cov).select("sample_id", "genome", "chrom", "pos", "gene", masks.mask().alias("allele"))
    out = packed(rows.filter("gene is not null"), "popani", unit="gene", cells_per_block=None)
    out = out.select("genome", F.col("unit").alias("gene"), "sample_1", "sample_2", "total_positions", "share_allele_pos")
    return out.withColumn("gene_pop_ani", masks.ani(F.col("share_allele_pos"), F.col("total_positions")))


def in_genes(rows: DataFrame, genes: DataFrame, bin_size: int = 100) -> DataFrame:
    """rows (genome, axis_pos) joined with the genes (genome, gene, gene_start, gene_end) that hold them: an equi join on bins."""
    g = genes.withColumn("bin", F.explode(F.sequence(F.expr(f"gene_start div {bin_size}"), F.expr(f"gene_end div {bin_size}"))))
    return rows.withColumn("bin", F.expr(f"axis_pos div {bin_size}")).join(g, ["genome", "bin"]).filter(F.col("axis_pos").between(F.col("gene_start"), F.col("gene_end"))).drop("bin")


def longest_runs(positions: DataFrame, min_cov: int = MIN_COV, *, samples_per_block: int = 256, cells_per_block: int = 4096, kernel: str | None = None) -> DataFrame:
    """shared_runs() of positions, by popANI."""
    return shared_runs(alleles(positions, "popani", min_cov), samples_per_block, cells_per_block, kernel)


def shared_runs(rows: DataFrame, samples_per_block: int = 256, cells_per_block: int = 4096, kernel: str | None = None) -> DataFrame:
    """Of rows from alleles() or matrix_alleles(): the longest stretch of neighbouring cells of one scaffold that both samples cover and share; 0 if there is none."""
    rows = _placed(rows)
    if kernel == "tiles":
        return _run_tiles(rows, samples_per_block, cells_per_block)
    plan, marked = _plan(rows, "chrom", samples_per_block, None, kernel)
    plan = plan.collect()  # a row a genome, with a name a strip
    crowded, sparse = _by_kernel(marked, plan)
    strips = _run_strips(sparse, plan)
    return strips if crowded is None else _run_tiles(crowded.drop("late"), samples_per_block, cells_per_block).unionByName(strips)


def _run_tiles(rows: DataFrame, samples_per_block: int, cells_per_block: int) -> DataFrame:
    """The result of shared_runs() by tiles.

    Each block gives the runs at its start and end and its longest; blocks are then joined in order.
    """
    dealt, idx = _dealt(rows, "chrom", samples_per_block, cells_per_block, None)

    def runs(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cells, names_a, x, names_b, y = _tables(pdf, key, samples_per_block)
        first = key[2] * cells_per_block
        shape = (len(names_a), len(names_b))
        now, best, head = (np.zeros(shape, np.int64) for _ in range(3))
        whole, met, before = np.full(shape, True), np.full(shape, False), first - 1
        for c, cell in enumerate(cells.tolist()):
            if cell != before + 1:
                now[:], whole[:] = 0, False
            hit = (x[:, None, c] & y[None, :, c]) != 0
            met |= (x[:, None, c] > 0) & (y[None, :, c] > 0)
            now = (now + 1) * hit
            whole &= hit
            head += whole
            best = np.maximum(best, now)
            before = cell
        if before != first + cells_per_block - 1:
            now[:] = 0
        i, j = np.nonzero(np.triu(met, 1) if key[3] == key[4] else met)
        return pd.DataFrame({"genome": key[0], "unit": key[1], "block": key[2], "i1": names_a[i], "i2": names_b[j], "head": head[i, j], "tail": now[i, j], "best": best[i, j]})

    each = dealt.groupBy("genome", "unit", "cell_block", "tile_1", "tile_2").applyInPandas(runs, "genome string, unit string, block bigint, i1 int, i2 int, head bigint, tail bigint, best bigint")
    parts = each.groupBy("genome", "i1", "i2", "unit").agg(F.sort_array(F.collect_list(F.struct("block", "head", "tail", "best"))).alias("p"))  # a scaffold's blocks
    joined = f"""aggregate(p, struct(-2L as block, 0L as run, 0L as best), (s, x) -> struct(x.block as block,
        if(x.head = {cells_per_block}, if(x.block = s.block + 1, s.run, 0L) + x.head, x.tail) as run,
        greatest(s.best, x.best, if(x.block = s.block + 1, s.run, 0L) + x.head) as best)).best"""
    sums = parts.withColumn("n", F.expr(joined)).groupBy("genome", "i1", "i2").agg(F.max("n").alias("max_consecutive_length"))
    return _named(sums, idx, "max_consecutive_length")


def open_samples(catalog: DataFrame, completed: DataFrame) -> DataFrame:
    """Samples (genome, sample_id) with a pair to come: those in no completed pair, and those that lack one among the others."""
    ends = completed.select("genome", F.explode(F.array("sample_1", "sample_2")).alias("sample_id")).groupBy("genome", "sample_id").agg(F.count(F.lit(1)).alias("k"))
    known = catalog.select("genome", "sample_id").distinct().join(ends, ["genome", "sample_id"], "left")
    old = known.filter("k is not null").groupBy("genome").agg(F.count(F.lit(1)).alias("n"))
    return known.join(old, "genome", "left").filter("k is null or k < n - 1").select("genome", "sample_id")


def missing_pairs(rows: DataFrame, completed: DataFrame, method: str = "popani", **options) -> DataFrame:
    """Pairs of rows from alleles() that are not among the completed (genome, sample_1, sample_2): open samples by all samples."""
    done = completed.select("genome", F.least("sample_1", "sample_2").alias("sample_1"), F.greatest("sample_1", "sample_2").alias("sample_2")).distinct()
    todo = open_samples(rows.select("genome", "sample_id"), done)
    out = packed(rows, method, open_samples=todo, **options).join(done, ["genome", "sample_1", "sample_2"], "left_anti")
    return out.withColumn("genome_ani", masks.ani(F.col("share_allele_pos"), F.col("total_positions")))


def new_pairs(rows: DataFrame, compared: DataFrame, method: str = "popani", **options) -> DataFrame:
    """missing_pairs() where the completed pairs are all those among the compared samples (genome, sample_id): a row a sample is read instead of a row a pair."""
    todo = rows.select("genome", "sample_id").distinct().join(compared, ["genome", "sample_id"], "left_anti")
    return packed(rows, method, open_samples=todo, **options).withColumn("genome_ani", masks.ani(F.col("share_allele_pos"), F.col("total_positions")))


def incremental(positions: DataFrame, completed: DataFrame, method: str = "popani", min_cov: int = MIN_COV) -> DataFrame:
    """missing_pairs() of positions; new_pairs() if completed names samples instead of pairs."""
    missing = new_pairs if "sample_id" in completed.columns else missing_pairs
    return missing(alleles(positions, method, min_cov), completed, method)


def packed_pairs(matrix: DataFrame, samples_per_block: int = 256, cells_per_block: int = 4096) -> DataFrame:
    """The rows of pairs(method='popani') from a matrix."""
    out = packed(matrix_alleles(matrix), samples_per_block=samples_per_block, cells_per_block=cells_per_block)
    return out.withColumn("genome_ani", masks.ani(F.col("share_allele_pos"), F.col("total_positions")))


def matrix_alleles(matrix: DataFrame, method: str = "popani") -> DataFrame:
    """alleles() from the cells of a matrix of masks (genome, sample_id, axis_pos, mask) or of counts (A, T, C, G for the mask).

    The axis leaves a cell free between scaffolds, so no run crosses them. Masks hold no counts: only popANI can be had from them.
    """
    place = (F.lit("").alias("chrom"), F.col("axis_pos").alias("pos"))
    if "mask" in matrix.columns:
        if method != "popani":
            raise ValueError(f"a matrix of masks holds no counts for {method}")
        return matrix.select("genome", "sample_id", *place, F.col("mask").alias("allele"))
    return alleles(matrix.select("genome", "sample_id", *place, *CHANNELS), method, 0).select("genome", "sample_id", "chrom", "pos", *(CHANNELS if method.startswith("cosani_") else ["allele"]))


def calculations(calculate: str) -> tuple[str, ...]:
    """What a list like `ani+gene` names; `all` is everything."""
    wanted = CALCULATIONS if calculate == "all" else tuple(x.strip() for x in calculate.split("+"))
    unknown = sorted(set(wanted) - set(CALCULATIONS))
    if unknown:
        raise ValueError(f"unknown calculation {', '.join(unknown)}; there are {', '.join(CALCULATIONS)}")
    return wanted


def matrix_results(matrix: DataFrame, calculate: str = "ani", method: str = "popani", genes: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables that `calculate` names, from a stored matrix: pairs, pairs by gene (needs the genes on the axis), longest runs."""
    wanted, out = calculations(calculate), {}
    rows = matrix_alleles(matrix, method)
    share = masks.ani(F.col("share_allele_pos"), F.col("total_positions"))
    if "ani" in wanted:
        out["ani"] = packed(rows, method).withColumn("genome_ani", share)
    if "gene" in wanted:
        if genes is None:
            raise ValueError("pairs by gene need the genes' places on the axis")
        held = in_genes(rows.withColumnRenamed("pos", "axis_pos"), genes.select("genome", "gene", "gene_start", "gene_end")).withColumnRenamed("axis_pos", "pos")
        sums = packed(held.drop("gene_start", "gene_end"), method, unit="gene", cells_per_block=None)
        out["gene"] = sums.select("genome", F.col("unit").alias("gene"), "sample_1", "sample_2", "total_positions", "share_allele_pos").withColumn("gene_pop_ani", share)
    if "ibs" in wanted:
        if method.startswith("cosani_"):
            raise ValueError("runs need alleles: popani or conani")
        out["ibs"] = shared_runs(rows)
    return out


def expected_pairs(catalog: DataFrame) -> DataFrame:
    n = catalog.select("genome", "sample_id").distinct().groupBy("genome").agg(F.count(F.lit(1)).alias("n"))
    return n.select("genome", "n", F.expr("n * (n - 1) div 2").alias("expected"))


__all__ = ["alleles", "expected_pairs", "gene_pairs", "in_genes", "incremental", "joined_pairs", "calculations", "joint", "longest_runs", "matrix_alleles", "matrix_results", "missing_pairs", "new_pairs", "open_samples", "packed", "packed_pairs", "pairs", "shared_runs"]
