"""Compact allele-mask profiles: a presence bitmap and deviation nibbles for each sample and scaffold.

deviation = mask XOR reference at covered offsets; bits little-endian, low nibble first, zstd level 6 with checksum; the
payload hash is sha256 over the uncompressed presence and deviation bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import masks
from ..schemas import BITS, SKIPPED_GENOMES

LEVEL = 6


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(bool), bitorder="little").tobytes()


def unpack_bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:n].astype(bool)


def pack_nibbles(values: np.ndarray) -> bytes:
    v = np.append(values, 0)[: 2 * ((len(values) + 1) // 2)].astype(np.uint8)
    return (v[0::2] | (v[1::2] << 4)).tobytes()


def unpack_nibbles(raw: bytes, n: int) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    return np.column_stack([b & 15, b >> 4]).ravel()[:n]


def compress(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(raw)


def expand(raw: bytes, size: int) -> bytes:
    out = zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(1, size))
    if len(out) != size:
        raise ValueError("a block has another size than its segment")
    return out


def encode_bases(sequence: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for base, bit in BITS.items():
        table[ord(base)] = table[ord(base.lower())] = bit
    return table[np.frombuffer(sequence.encode("latin-1", "replace"), np.uint8)]


def reference_segments(fasta: DataFrame, stb: DataFrame, bed_spans: DataFrame | None = None) -> DataFrame:
    """segment_id, genome, chrom, segment_ordinal, start_pos, span, reference_mask and its hash from (chrom, sequence)."""
    from pyspark.sql import Window as W

    rows = fasta.join(stb, fasta["chrom"] == stb["scaffold"]).select("genome", "chrom", "sequence")

    @F.pandas_udf("struct<reference_mask:binary,reference_hash:string,span:bigint>")
    def encode(sequences: pd.Series) -> pd.DataFrame:
        raw = [pack_nibbles(encode_bases(s)) for s in sequences]
        return pd.DataFrame({"reference_mask": [compress(r) for r in raw], "reference_hash": [hashlib.sha256(r).hexdigest() for r in raw], "span": [len(s) for s in sequences]})

    out = rows.withColumn("e", encode("sequence"))
    order = W.partitionBy("genome").orderBy("chrom")
    every = W.orderBy("genome", "chrom")  # a row a scaffold
    return out.select(F.row_number().over(every).cast("bigint").alias("segment_id"), "genome", "chrom", (F.row_number().over(order) - 1).alias("segment_ordinal"), F.lit(1).cast("bigint").alias("start_pos"), F.col("e.span").alias("span"), F.col("e.reference_mask").alias("reference_mask"), F.col("e.reference_hash").alias("reference_hash"))


def encode(positions: DataFrame, segments: DataFrame, min_cov: int = 5) -> DataFrame:
    """sample_id, segment_id, presence, deviation, covered_positions, payload_hash; blocks without a covered position are left out.

    The plan itself raises on negative counts, positions without a segment or outside of it, and positions given twice.
    """
    rows = positions.filter(~F.coalesce("genome", F.lit("")).isin(*SKIPPED_GENOMES))
    bad = (F.least("A", "C", "G", "T") < 0) | F.col("pos").isNull() | (F.col("pos") < 1)
    say = lambda text, *c: F.raise_error(F.concat(F.lit(text), F.concat_ws(" ", *[F.col(x).cast("string") for x in c])))
    pos = F.when(bad, say("negative counts or positions: ", "sample_id", "chrom", "pos").cast("bigint")).otherwise(F.col("pos"))
    rows = rows.select("sample_id", "genome", "chrom", pos.alias("pos"), *[c for c in ("A", "T", "C", "G")]).filter(masks.coverage() >= min_cov)
    joined = rows.select("sample_id", "genome", "chrom", "pos", masks.mask().alias("mask")).join(segments.select("segment_id", "genome", "chrom", "start_pos", "span"), ["genome", "chrom"], "left")
    at = F.col("pos") - F.col("start_pos")
    # in the key itself: a check in another column would be dropped with the rows that the join below cannot use
    segment = F.coalesce("segment_id", say("positions on scaffolds without a reference: ", "genome", "chrom").cast("bigint"))
    at = F.when((at < 0) | (at >= F.col("span")), say("positions outside their segment: ", "sample_id", "chrom", "pos").cast("bigint")).otherwise(at)
    # one sample's cells of one scaffold are one block: the unit that is stored
    blocks = joined.select("sample_id", segment.alias("segment_id"), at.alias("at"), "mask").groupBy("sample_id", "segment_id").agg(F.collect_list("at").alias("at"), F.collect_list("mask").alias("mask"))
    refs = segments.select("segment_id", "span", "reference_mask")

    @F.pandas_udf("struct<presence:binary,deviation:binary,covered_positions:bigint,payload_hash:string>")
    def pack(places: pd.Series, values: pd.Series, spans: pd.Series, references: pd.Series) -> pd.DataFrame:
        out = []
        for at, v, span, ref in zip(places, values, spans, references, strict=True):
            n = int(span)
            mask = np.zeros(n, np.uint8)
            mask[at] = v
            present = mask > 0
            if int(present.sum()) != len(at):
                raise ValueError("a position occurs twice in one sample and scaffold")
            base = unpack_nibbles(expand(ref, (n + 1) // 2), n)
            p, d = pack_bits(present), pack_nibbles(np.where(present, mask ^ base, 0))
            out.append((compress(p), compress(d), len(at), hashlib.sha256(p + d).hexdigest()))
        return pd.DataFrame(out, columns=["presence", "deviation", "covered_positions", "payload_hash"])

    return blocks.join(refs, "segment_id").withColumn("b", pack("at", "mask", "span", "reference_mask")).select("sample_id", "segment_id", "b.*")


def decode(blocks: DataFrame, segments: DataFrame) -> DataFrame:
    """sample_id, genome, chrom, pos, mask; checks hash, sizes, the number of positions and that no mask is empty."""
    rows = blocks.join(segments, "segment_id", "left").select("sample_id", "segment_id", "genome", "chrom", "start_pos", "span", "reference_mask", "presence", "deviation", "covered_positions", "payload_hash")

    @F.pandas_udf("struct<at:array<bigint>,mask:array<int>>")
    def unpack(presence: pd.Series, deviation: pd.Series, references: pd.Series, spans: pd.Series, counts: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        places, values = [], []
        for p, d, ref, span, count, digest in zip(presence, deviation, references, spans, counts, hashes, strict=True):
            if ref is None:
                raise ValueError("a block names a segment that is not there")
            n = int(span)
            p, d = expand(p, (n + 7) // 8), expand(d, (n + 1) // 2)
            if hashlib.sha256(p + d).hexdigest() != digest:
                raise ValueError("a block does not match its hash")
            at = np.flatnonzero(unpack_bits(p, n))
            mask = (unpack_nibbles(expand(ref, (n + 1) // 2), n) ^ unpack_nibbles(d, n))[at]
            if len(at) != count or (mask == 0).any():
                raise ValueError("a block does not hold what it claims")
            places.append(at)
            values.append(mask.astype(np.int32))
        return pd.DataFrame({"at": places, "mask": values})

    made = rows.select("sample_id", "genome", "chrom", "start_pos", unpack("presence", "deviation", "reference_mask", "span", "covered_positions", "payload_hash").alias("c"))
    cells = made.select("sample_id", "genome", "chrom", "start_pos", F.explode(F.arrays_zip("c.at", "c.mask")).alias("c"))
    return cells.select("sample_id", "genome", "chrom", (F.col("start_pos") + F.col("c.at")).alias("pos"), F.col("c.mask").alias("mask"))


def pending(samples: DataFrame, state: DataFrame) -> DataFrame:
    """Samples whose migration is not done."""
    return samples.select("sample_id").join(state.filter(F.col("status") == "done").select("sample_id"), "sample_id", "left_anti")
