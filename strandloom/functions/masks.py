"""Allele masks and consensus as column expressions; all stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..schemas import BITS, CHANNELS


def coverage(prefix: str = ""):
    return reduce(lambda a, b: a + b, [F.col(f"{prefix}{c}") for c in CHANNELS])


def mask(prefix: str = ""):
    """Bits of all bases with a count."""
    parts = [F.when(F.col(f"{prefix}{c}") > 0, F.lit(BITS[c])).otherwise(F.lit(0)) for c in CHANNELS]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def consensus(prefix: str = ""):
    """Bit of the most frequent base; ties go to the first in A, T, C, G."""
    top = F.greatest(*[F.col(f"{prefix}{c}") for c in CHANNELS])
    out = F.lit(0)
    for c in reversed(CHANNELS):
        out = F.when(F.col(f"{prefix}{c}") == top, F.lit(BITS[c])).otherwise(out)
    return F.when(top > 0, out).otherwise(F.lit(0))


def ani(share, total):
    return share.cast("double") * F.lit(100.0) / total.cast("double")
