"""Quality rules: distribution divergence from language references.

Every text gets exact rule counts (repetition, symbols, duplicated lines) and two histograms: its character classes,
and the common words of its language. The references are the same histograms summed over all documents of the
language; Jensen-Shannon distance (base 2, 0 to 1) measures how far a text is from its reference. Short texts, whose
histograms are noise, are not judged by it (minimum-length guards).

Null text: no words. Null or unlisted language: the character classes are held against the sum over all such documents
and common words are not judged. Repeated rows each get their own result. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored

#: Frequent function words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "en": "the of and to a in is that for it as was with be by on not he this are or his from at which but have an had they".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se avec il sont ce ou aux être".split(),
}
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Classes of bytes: other control, white space, lower, upper, digit, sentence punctuation, symbol, lead byte beyond ASCII, continuation byte.
CLASSES = 9
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 5
_CLASS[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] = 6
_CLASS[192:256] = 7
_CLASS[128:192] = 8
_STRIP = b".,;:!?\"'()*$%&|<>#"
_COUNTED = {lang: {w.encode(): i for i, w in enumerate(words)} for lang, words in COMMON_WORDS.items()}

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars array<long>, common array<long>"


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by a window of `width` words that occurs at least twice in the text. Hashes find candidates, words confirm them."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    w = np.zeros(n, np.uint64)
    for j in range(width):
        w = w * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = np.flatnonzero(twice).tolist()
    seen = Counter(tuple(words[i : i + width]) for i in starts)
    covered = np.zeros(len(words) + 1, np.int64)
    for i in starts:
        if seen[tuple(words[i : i + width])] > 1:
            covered[i] += 1
            covered[i + width] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def dup_lines(raw: bytes) -> int:
    if b"\n" not in raw:
        return 0
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def features(texts: list[str | None], langs: list[str | None]) -> dict:
    out: dict = {k.split()[0]: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common")}
    for text, lang in zip(texts, langs, strict=True):
        raw = (text or "").encode()
        words = raw.split()
        classes = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=CLASSES)
        out["n_words"].append(len(words))
        out["word_chars"].append(int(len(raw) - classes[8] - classes[1]))
        out["n_symbols"].append(len(raw) - len(raw.translate(None, b"#*$%&|<>")))
        out["n_dup_lines"].append(dup_lines(raw))
        out["n_repeat_words"].append(repeat_words(words))
        out["chars"].append(classes[:8].tolist())
        index = _COUNTED.get(lang or "")
        if index is None:
            out["common"].append([])
            continue
        hist = [0] * (len(index) + 1)
        found = 0
        for w, k in Counter(words).items():
            i = index.get(w)
            if i is None:
                i = index.get(w.strip(_STRIP).lower())
            if i is not None:
                hist[i] += k
                found += k
        hist[-1] = len(words) - found
        out["common"].append(hist)
    return out


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the features of each whole text."""
    rows = docs.select("doc_id", "text", "lang")

    def run(ids, texts, langs):
        return {"doc_id": ids, "lang": langs} | features(texts, langs)

    return arrow_map(rows, run, f"doc_id long, lang string, {FEATURES}")


def js_distance(p: str, q: str):
    """Jensen-Shannon distance of two count arrays of one length; null where either is empty or sums to nothing."""
    return F.expr(f"""
      case when size({p}) = size({q}) and aggregate({p}, 0L, (s, v) -> s + v) > 0 and aggregate({q}, 0L, (s, v) -> s + v) > 0 then
        sqrt(greatest(0D, aggregate(
          zip_with(transform({p}, x -> x / aggregate({p}, 0D, (s, v) -> s + v)),
                   transform({q}, x -> x / aggregate({q}, 0D, (s, v) -> s + v)),
                   (a, b) -> if(a > 0, a * log2(2 * a / (a + b)), 0D) + if(b > 0, b * log2(2 * b / (a + b)), 0D)),
          0D, (s, v) -> s + v) / 2))
      end""")


def references(feats: DataFrame) -> DataFrame:
    """A row for each listed language and one for all others (key ''): both histograms summed over all documents."""
    key = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise("").alias("ref_lang")
    width = max(map(len, COMMON_WORDS.values())) + 1
    sums = feats.select(key, "chars", "common").groupBy("ref_lang").agg(
        *[F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(8)],
        *[F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(width)],
    )
    return sums.select(
        "ref_lang",
        F.array(*[f"c{i}" for i in range(8)]).alias("ref_chars"),
        F.filter(F.array(*[f"w{i}" for i in range(width)]), lambda x: x.isNotNull()).alias("ref_common"),
    )


def judge(
    docs: DataFrame,
    *,
    max_char_distance: float = 0.30,
    max_word_distance: float = 0.42,
    min_chars: int = 200,
    min_common_words: int = 100,
) -> DataFrame:
    """One row a document: counts, both distances, base_failed and kept. References take all documents, whatever their verdict."""
    feats = stored(with_features(docs), "quality")
    refs = references(feats)  # at most a row for each listed language and one more
    key = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise("")
    rows = feats.withColumn("ref_lang", key).join(F.broadcast(refs), "ref_lang")
    rows = rows.withColumn("char_distance", js_distance("chars", "ref_chars")).withColumn("word_distance", js_distance("common", "ref_common"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    odd_chars = (F.col("word_chars") >= min_chars) & (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance)
    odd_words = (F.col("n_words") >= min_common_words) & (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~odd_chars & ~odd_words).alias("kept"), F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"),
    )
