"""Benchmark decontamination by template canonicalisation.

Words are runs of letters or of digits, lower-cased. Numbers, names (capitalised inside a sentence) and units (after a
number) become typed placeholders, neighbouring ones of a type one placeholder. Windows of WINDOW template words with at
least LITERALS plain words are hashed; a benchmark item shorter than a window is one window of its own length. An item
without any such window matches as it stands: windows of its words, numbers and names included, have to cover it whole
in one line, and an item of fewer than LITERALS words has to be all the words of the document. A Bloom
filter over the benchmark's windows, sized by their number, keeps other windows of the documents out of the hash join;
adaptive execution splits templates that very many documents share. For each
document and item, windows are lined up, and a line counts only where its slots are consistent: one value of the item
always stands for the same value of the document. A document is contaminated if a line covers COVER percent of the
item's template or RUN template words on end: copies and re-parameterised questions alike.

Null and empty texts match nothing; whole texts are searched, however long. Rows that share or lack a doc_id are told apart
by text_key, a hash of the text; equal rows are one. Equal benchmark rows are one item. Other columns are not looked at.
An empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit
from .common import arrow_map, stored

WINDOW, LITERALS, COVER, RUN = 8, 4, 50, 13
#: The filter has BITS_EACH bits a window, two of them set, within these powers of two: at most 128 MB on an executor.
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 20, 30
#: Marks the windows of items that match as they stand; their widths are negative.
PLAIN = 0x5851F42D4C957F2D
#: Units of measure.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz ounce ounces pound pounds ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons cup cups "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros usd eur mph kmh kph hz khz mhz w kw kwh v volt volts amp amps "
    "degree degrees celsius fahrenheit kelvin byte bytes kb mb gb tb"
).split()
U = np.uint64
NUM, NAME, UNIT = U(1), U(2), U(3)

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 letter, 2 digit, 3 end of a sentence
_KIND[97:123] = _KIND[65:91] = 1
_KIND[128:] = 1
_KIND[48:58] = 2
_KIND[[10, 33, 46, 58, 63]] = 3


def _unit_hashes() -> np.ndarray:
    raw = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    return np.unique(textkit.hashes(raw, *textkit.words(raw)))


def plain_words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and byte ranges of the words as they stand: runs of letters or of digits, lower-cased."""
    _, low, token, _ = _runs(codes)
    change = np.flatnonzero(np.diff(np.concatenate([[0], token, [0]])) != 0)
    starts, ends = change[:-1], change[1:]
    real = token[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    return textkit.hashes(low, starts, ends), starts, ends


def plain_windows(h: np.ndarray, width: int) -> np.ndarray:
    out = textkit.shingle_hashes(h, width) + U(width) + U(PLAIN)
    return np.where(out == 0, U(1), out)


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Capitals, lower-cased bytes, letters (1) or digits (2), and kinds."""
    # a capital of Latin-1, Greek or Cyrillic is two bytes; for those of Latin-1 the second is folded as well
    capital = np.zeros(len(codes), bool)
    capital[(codes >= 65) & (codes <= 90)] = True
    second = np.flatnonzero((codes[1:] >= 0x80) & (codes[1:] <= 0x9E) & (codes[:-1] == 0xC3)) + 1
    capital[second - 1] = True
    low = textkit.LOWER[codes]
    low[second] += 32
    kind = _KIND[codes]
    return capital, low, np.where(kind == 3, 0, kind), kind


def template(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template words of some bytes: their hashes (placeholders are 1 to 3), and the byte ranges they stand for."""
    capital, low, token, kind = _runs(codes)
    change = np.flatnonzero(np.diff(np.concatenate([[0], token, [0]])) != 0)
    # runs of one kind, letters or digits
    starts = change[:-1]
    ends = change[1:]
    real = token[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return np.zeros(0, U), starts, ends
    h = textkit.hashes(low, starts, ends)
    h[h < U(8)] += U(8)
    digits = token[starts] == 2
    stops = np.concatenate([[0], np.cumsum(kind == 3)])
    first = np.ones(len(starts), bool)
    first[1:] = stops[starts[1:]] > stops[ends[:-1]]
    capitals = np.concatenate([[0], np.cumsum(capital)])
    count = capitals[ends] - capitals[starts]
    name = capital[starts] & ~first & ~digits & (count == 1) & (ends - starts > 1)
    unit = np.zeros(len(starts), bool)
    unit[1:] = digits[:-1] & np.isin(h[1:], _unit_hashes())
    h[digits], h[name & ~unit], h[unit] = NUM, NAME, UNIT
    # neighbours of one type in one sentence become one slot
    joined = np.zeros(len(starts), bool)
    joined[1:] = (h[1:] == h[:-1]) & (h[1:] < U(8)) & ~first[1:]
    head = np.flatnonzero(~joined)
    last = np.concatenate([head[1:] - 1, [len(starts) - 1]])
    return h[head], starts[head], ends[last]


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows; 0 where too few plain words are in one."""
    n = len(h) - width + 1
    if n < 1:
        return np.zeros(0, U)
    plain = np.concatenate([[0], np.cumsum(h >= U(8))])
    out = textkit.shingle_hashes(h, width) + U(width)
    return np.where(plain[width:] - plain[:-width] >= min(LITERALS, width), out, U(0))


def slots_of(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, raw: bytes, at: int, width: int) -> list[str]:
    return [raw[starts[j] : ends[j]].decode(errors="replace").lower() for j in range(at, at + width) if h[j] < U(8)]


_WINDOWS = "length int, width int, at int, key long, slots array<string>"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, length and every window of each benchmark item."""

    def run(ids, texts):
        out: dict = {k: [] for k in ("item_id", "length", "width", "at", "key", "slots")}
        for i, text in zip(ids, texts, strict=True):
            raw = (text or "").encode()
            h, a, b = template(np.frombuffer(raw, np.uint8))
            width = min(WINDOW, len(h))
            w = windows(h, width) if width >= LITERALS else np.zeros(0, U)
            if not w.any():
                h, a, b = plain_words(np.frombuffer(raw, np.uint8))
                width = -min(WINDOW, len(h))
                w = plain_windows(h, -width) if len(h) else np.zeros(0, U)
            for at in np.flatnonzero(w).tolist():
                for k, v in zip(out, (i, len(h), width, at, int(textkit.signed(w[at : at + 1])[0]), slots_of(h, a, b, raw, at, width) if width > 0 else []), strict=True):
                    out[k].append(v)
        return out

    return arrow_map(benchmark.select("item_id", "text").distinct(), run, f"item_id long, {_WINDOWS}").distinct()


def bloom(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The filter's bits, and the widths other than WINDOW in use (twelve at most). The driver gets 2 ** MOST_BITS bits at most."""
    n = items.select("key").distinct().count()
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * n).bit_length()))
    probes = F.explode(F.array(F.col("key"), F.shiftrightunsigned("key", 32))).alias("x")
    bit = F.expr(f"x & {size - 1}")
    rows = items.select(probes).select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast((x & {size - 1}) & 63 as int))").alias("b")).groupBy("word").agg(F.bit_or("b").alias("b")).collect()
    bits = np.zeros(size >> 6, np.int64)
    for r in rows:
        bits[r.word] |= r.b
    return bits.view(U), sorted(r.width for r in items.select("width").filter(F.col("width") != WINDOW).distinct().collect())


def let_through(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of the keys that the filter may hold."""
    mask = U(len(bits) * 64 - 1)
    held = np.ones(len(keys), bool)
    for probe in (keys & mask, (keys >> U(32)) & mask):
        held &= (bits[(probe >> U(6)).astype(np.int64)] >> (probe & U(63))) & U(1) > 0
    return np.flatnonzero(held)


def document_windows(docs: DataFrame, bits: np.ndarray, short: list[int]) -> DataFrame:
    """doc_id, text_key and those windows of each whole text that the filter lets through."""

    def run(ids, keys, texts):
        out: dict = {k: [] for k in ("doc_id", "text_key", "at", "key", "slots")}
        for index, codes, offsets in textkit.steps(texts):
            forms = {True: template(codes)}
            if min(short, default=0) < 0:
                forms[False] = plain_words(codes)
            for signed_width in (WINDOW, *short):
                width = abs(signed_width)
                h, a, b = forms[signed_width > 0]
                own = np.searchsorted(offsets, a, side="right") - 1
                w = windows(h, width) if signed_width > 0 else plain_windows(h, width)
                if not len(w):
                    continue
                hit = let_through(bits, w)
                for at in hit[(w[hit] != 0) & (own[hit] == own[hit + width - 1])].tolist():
                    i = int(own[at])
                    slots = [codes[a[j] : b[j]].tobytes().decode(errors="replace").lower() for j in range(at, at + width) if h[j] < U(8)] if signed_width > 0 else []
                    base = int(np.searchsorted(own, i))
                    if -LITERALS < signed_width < 0 and int(np.searchsorted(own, i, side="right")) - base != width:
                        continue
                    for k, v in zip(out, (ids[index + i], keys[index + i], at - base, int(textkit.signed(w[at : at + 1])[0]), slots), strict=True):
                        out[k].append(v)
        return out

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return arrow_map(rows, run, "doc_id long, text_key long, at int, key long, slots array<string>")


def lines(pairs: list[tuple[int, int, int, list[str], list[str]]]) -> tuple[int, int, int]:
    """(template words of the item covered, longest run, windows) over consistent lines. pairs: document and item position, width, slots of both."""
    by_shift = defaultdict(list)
    for at, item_at, width, values, item_values in pairs:
        by_shift[at - item_at].append((item_at, width, values, item_values))
    best = (0, 0, 0)
    for group in by_shift.values():
        stands: dict[str, str] = {}
        covered: set[int] = set()
        kept = 0
        for item_at, width, values, item_values in sorted(group):
            both = list(zip(item_values, values, strict=True)) if len(values) == len(item_values) else None
            if both is None or any(stands.get(k, v) != v for k, v in both) or len(dict(both)) != len(set(both)):
                continue
            stands.update(both)
            covered.update(range(item_at, item_at + width))
            kept += 1
        run = longest = 0
        for j in range(max(covered, default=-1) + 1):
            run = run + 1 if j in covered else 0
            longest = max(longest, run)
        best = max(best, (len(covered), longest, kept))
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, covered (template words of the item), length, run and n_windows of each contaminated pair."""
    items = stored(item_windows(benchmark), "items")
    bits, short = bloom(items)
    pairs = document_windows(docs, bits, short).distinct().join(items.select("item_id", "length", "width", F.col("at").alias("item_at"), "key", F.col("slots").alias("item_slots")), "key")
    groups = pairs.groupBy("doc_id", "text_key", "item_id", "length", (F.col("width") < 0).alias("plain")).agg(F.collect_list(F.struct("at", "item_at", "width", "slots", "item_slots")).alias("pairs"))

    def run(ids, keys, items, lengths, plain, pairs):
        best = [lines([(p["at"], p["item_at"], abs(p["width"]), p["slots"], p["item_slots"]) for p in g]) for g in pairs]
        return {"doc_id": ids, "text_key": keys, "item_id": items, "length": lengths, "plain": plain, "covered": [x[0] for x in best], "run": [x[1] for x in best], "n_windows": [x[2] for x in best]}

    judged = arrow_map(groups, run, "doc_id long, text_key long, item_id long, length int, plain boolean, covered int, run int, n_windows int")
    enough = (100 * F.col("covered") >= COVER * F.col("length")) | (F.col("run") >= RUN)
    return judged.filter(F.when(F.col("plain"), F.col("covered") == F.col("length")).otherwise(enough)).drop("plain")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with their own columns."""
    hit = contaminated(docs, benchmark).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    rows = docs.withColumn("hit_text_key", F.xxhash64("text"))
    return rows.join(hit, rows["doc_id"].eqNullSafe(hit["hit_id"]) & (rows["hit_text_key"] == hit["hit_key"]), "left_anti").select(*docs.columns)
