"""Accessions, file-safe names and id lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ACCESSION


def accession(column: Column, pattern: str = ACCESSION) -> Column:
    """The canonical accession in a path or name; null where there is none. Lower-case accessions do not match."""
    return F.upper(F.nullif(F.regexp_extract(column.cast("string"), pattern, 1), F.lit("")))


def safe_name(column: Column) -> Column:
    """Runs of other characters become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(column, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def safe_characters(column: Column) -> Column:
    """Each other character becomes an underscore."""
    return F.regexp_replace(column, r"[^A-Za-z0-9._-]", "_")


def normalized(ids: Iterable[str]) -> list[str]:
    """Stripped, without blanks, first occurrences in order."""
    return [x for x in dict.fromkeys(str(i).strip() for i in ids) if x]


def required(value: str, what: str) -> str:
    if not value or not value.strip():
        raise ValueError(f"{what} must not be blank")
    return value.strip()
