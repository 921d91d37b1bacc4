"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

Each source's documents are put in hash order and cut into blocks. Of a source with the share w of all weights, block k
is released at floor(k / w) and due at ceil((k + 1) / w). Every slot goes to the released block with the earliest
deadline, ties to the first source by name. On one sequence this meets all deadlines, so after any number of slots each
source is less than one block from its weight's share (but for EPSILON slots, which cover the rounding of fractions).

Shares hold until a source runs out. From the next slot on the others are scheduled anew, with their proportions to each
other; every document is placed once: none is dropped or repeated. Sources of weight 0, and those that the weights do not
name, get no slot before all others have run out; then they share alike.

One task goes through all slots, a slot for each block and a step over the sources for each slot; it keeps one integer a
slot, and the counts of the sources for each CHUNK slots, from which blocks and positions are worked out in parallel.

A null source counts as the empty name. Documents with equal ids take hash order, then the order of their texts; equal
rows are interchangeable. Hashes are ranked without their rows, so that texts are neither sorted nor read but for those of equal ids. Other columns are passed through, whatever their names, except
for those named in ADDED, which are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ADDED = ("block", "slot", "position")
#: Hash buckets of a source: a source with most of the rows is ranked by as many tasks.
BUCKET_HEX = 3
#: Slots whose blocks are worked out together.
CHUNK = 1000
EPSILON = 1e-6


def shares(docs: DataFrame, weights: Mapping[str, float] | None, power: float) -> DataFrame:
    """mix_source, n documents and q, its weight. Without weights a source's weight is its count to the given power."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        return counts.withColumn("q", F.pow(F.col("n").cast("double"), F.lit(float(power))))
    if any(not 0 <= float(v) < float("inf") for v in weights.values()):
        raise ValueError("weights must be finite and not negative")
    table = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))]) if weights else F.lit(None).cast("map<string,double>")
    return counts.withColumn("q", F.coalesce(table[F.col("mix_source")], F.lit(0.0)))


def schedule(shared: DataFrame, block: int | None = None) -> DataFrame:
    """mix_source, k (its block), at (slot) and start (position of the block) of all blocks; without block, one period of sum(q) slots."""
    one = shared.agg(F.sort_array(F.collect_list(F.struct("mix_source", "n", "q"))).alias("s")).filter("size(s) > 0")
    size = block or 1
    blocks = f"(x.n + {size - 1}) div {size}" if block else f"{2**62}L"
    slots = "aggregate(bs, 0L, (a, b) -> a + b)" if block else "cast(aggregate(ws, 0D, (a, w) -> a + w) as bigint)"
    one = one.selectExpr("s", "transform(s, x -> x.n) as ns", "transform(s, x -> cast(x.q as double)) as qs", f"transform(s, x -> {blocks}) as bs")
    # sources without weight are late: they wait for the others, and share alike
    one = one.selectExpr("*", "transform(qs, q -> if(q > 0, q, 1D)) as ws", "transform(qs, q -> not q > 0) as late")
    one = one.selectExpr("*", f"{slots} as slots", "exists(late, x -> not x) as weighed", "aggregate(qs, 0D, (a, q) -> a + q) as total")
    waiting = f"""filter(transform(ws, (w, i) -> struct(
                    cast(ceil((r.done[i] + 1 - r.base[i]) * r.whole / w - {EPSILON}) as bigint) as due, i as i,
                    cast(floor((r.done[i] - r.base[i]) * r.whole / w + {EPSILON}) as bigint) as released)), x -> r.done[x.i] < bs[x.i] and late[x.i] = r.late)"""
    picked = f"transform(array({waiting}), v -> coalesce(array_min(filter(v, x -> x.released <= t - r.since)), array_min(v)))"
    # when a source runs out, the counts from which the others' blocks are timed begin here
    rest = "exists(sequence(0, size(ws) - 1), j -> not late[j] and m[j] < bs[j])"
    anew = f"transform(array(not {rest}), z -> struct(m as done, m as base, t + 1 as since, aggregate(sequence(0, size(ws) - 1), 0D, (a, j) -> a + if(m[j] < bs[j] and late[j] = z, ws[j], 0D)) as whole, z as late, concat(r.picks, array(g.i)) as picks))[0]"
    step = f"""transform({picked}, g -> transform(array(transform(r.done, (d, j) -> if(j = g.i, d + 1, d))), m ->
                 if(m[g.i] < bs[g.i], struct(m as done, r.base as base, r.since as since, r.whole as whole, r.late as late, concat(r.picks, array(g.i)) as picks), {anew}))[0])[0]"""
    none = "cast(array() as array<int>)"
    chunk = f"aggregate(sequence(c * {CHUNK}, least((c + 1) * {CHUNK}, slots) - 1), o.now, (r, t) -> {step})"
    start = f"""struct(struct(transform(ws, w -> 0L) as done, transform(ws, w -> 0L) as base, 0L as since, if(weighed, total, cast(size(ws) as double)) as whole, not weighed as late, {none} as picks) as now,
                cast(array() as array<struct<first:bigint,done:array<bigint>,picks:array<int>>>) as chunks)"""
    outer = f"""aggregate(sequence(0L, (slots - 1) div {CHUNK}), {start}, (o, c) -> transform(array({chunk}), e -> struct(
                struct(e.done as done, e.base as base, e.since as since, e.whole as whole, e.late as late, {none} as picks) as now,
                concat(o.chunks, array(struct(c * {CHUNK} as first, o.now.done as done, e.picks as picks))) as chunks))[0]).chunks"""
    chunks = one.selectExpr("s", "ns", f"explode({outer}) as c").repartition("c.first")
    placed = f"aggregate(zip_with(c.done, ns, (d, n) -> least(d * {size}, n)), 0L, (a, x) -> a + x)"
    each = chunks.selectExpr("s", "c.first as first", "c.done as done", f"{placed} as placed", "posexplode(c.picks) as (pos, i)")
    each = each.selectExpr("first", "placed", "first + pos as at", "i", "s[i].mix_source as mix_source", "s[i].n as n", "done[i] as done")
    each = each.withColumn("k", F.col("done") + F.row_number().over(W.partitionBy("first", "i").orderBy("at")) - 1)
    before = F.sum(F.least(F.lit(size), F.col("n") - F.col("k") * size)).over(W.partitionBy("first").orderBy("at").rowsBetween(W.unboundedPreceding, -1))
    return each.select("mix_source", "k", "at", (F.col("placed") + F.coalesce(before, F.lit(0))).alias("start"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, *, block: int = 16, power: float = 0.5, seed: str = "mix") -> DataFrame:
    """docs with block (of its source), slot and position (0-based, in the mixed order)."""
    docs = docs.drop(*ADDED)
    # the columns of docs travel in a struct, so that no name of theirs meets one of these
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("source", F.lit("")).alias("mix_source"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("mix_hash"),
    ).withColumn("mix_bucket", F.substring("mix_hash", 1, BUCKET_HEX))
    earlier = W.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = rows.groupBy("mix_source", "mix_bucket").agg(F.count(F.lit(1)).alias("mix_n")).select(
        F.col("mix_source").alias("o_source"), F.col("mix_bucket").alias("o_bucket"), "mix_n", F.coalesce(F.sum("mix_n").over(earlier), F.lit(0)).alias("mix_offset")
    )
    plan = schedule(shares(docs, weights, power), block)
    # the blocks of a bucket follow each other: the bucket's row holds their slots and starts
    spans = offsets.withColumn("o_block", F.explode(F.expr(f"sequence(mix_offset div {block}, (mix_offset + mix_n - 1) div {block})")))
    spots = spans.join(plan, (F.col("o_source") == F.col("mix_source")) & (F.col("o_block") == F.col("k"))).groupBy("o_source", "o_bucket").agg(
        F.first("mix_offset").alias("mix_offset"), F.sort_array(F.collect_list(F.struct("o_block", "at", "start"))).alias("mix_spots")
    )
    # hashes are ranked without their rows, and each gets its slots; the rows then pass by unsorted
    inside = W.partitionBy("mix_source", "mix_bucket").orderBy("mix_hash")
    hashes = rows.select("mix_source", "mix_bucket", "mix_hash").repartition("mix_source", "mix_bucket").groupBy("mix_source", "mix_bucket", "mix_hash").agg(F.count(F.lit(1)).alias("mix_same"))
    hashes = hashes.withColumn("mix_rank", F.sum("mix_same").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("mix_same"))
    hashes = hashes.join(spots, (F.col("mix_source") == F.col("o_source")) & (F.col("mix_bucket") == F.col("o_bucket"))).withColumn("mix_rank", F.col("mix_rank") + F.col("mix_offset"))
    first, last = f"mix_rank div {block}", f"(mix_rank + mix_same - 1) div {block}"
    hashes = hashes.selectExpr("mix_source as h_source", "mix_hash as h_hash", "mix_same", "mix_rank", f"slice(mix_spots, cast({first} - mix_spots[0].o_block + 1 as int), cast({last} - {first} + 1 as int)) as mix_spots")
    meet = lambda kept: rows.join(hashes.filter(kept).hint("shuffle_hash"), (F.col("mix_source") == F.col("h_source")) & (F.col("mix_hash") == F.col("h_hash")))
    # only rows of one hash are held against each other
    text = F.col("row.text") if "text" in docs.columns else F.lit(0)
    ties = W.partitionBy("mix_source", "mix_hash").orderBy(F.col("row.doc_id"), text)
    alone = meet("mix_same = 1").select("row", "mix_rank", "mix_spots")
    tied = meet("mix_same > 1").withColumn("mix_rank", F.col("mix_rank") + F.row_number().over(ties) - 1).select("row", "mix_rank", "mix_spots")
    placed = alone.unionAll(tied).withColumn("mix_block", F.expr(f"mix_rank div {block}"))
    placed = placed.withColumn("mix_spot", F.expr("mix_spots[cast(mix_block - mix_spots[0].o_block as int)]"))
    return placed.select("row.*", F.col("mix_block").alias("block"), F.col("mix_spot.at").alias("slot"), (F.col("mix_spot.start") + F.col("mix_rank") % block).alias("position"))


def laid_out(mixed: DataFrame) -> DataFrame:
    """Rows in mixed order: each partition holds a stretch of positions, sorted, and partitions follow each other."""
    parts = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, "position").sortWithinPartitions("position")
