"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, maps homoglyphs and digit or sign substitutions to plain letters, writes a letter that is repeated
three times or more once, joins letters that are spelled out, and turns all else into single spaces, so that every word
begins after a space. Lexicon entries are whole words and word beginnings that go on, with log-odds weights learned from
labelled rows; as a 1 may stand for i or l, an entry with l also matches with i. Only the strongest match of a word counts. Exception phrases, a matched
word with the word before or after it, cancel the match. A document's score is a logistic function of its total weight,
plain and normalised by length.

The fit takes a bounded sample of labelled rows (`max_train`, by hash order; held-out rows never); all documents are
scored on their whole text. Of rows with one label whose whole folded texts are equal, only the one with the smallest
doc_id, then the smallest text, is fitted on; near copies all stay. Null or empty text: no match, the score of that.
Without labelled rows every score is 0. Repeated documents each get a row, as do rows that share or lack a doc_id; of
repeated labels of one document the largest counts. Whole texts are matched, however long. Other columns are not looked
at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Characters that stand for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ß": "ss", "æ": "ae", "ø": "o", "œ": "oe",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
#: Signs count as letters only before a letter or digit.
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
_SIGN = re.compile(r"[@$!|]+(?=\w)")
_AGAIN = re.compile(r"([a-z])\1{2,}")
_SPELLED = re.compile(r"(?<= )(?:[a-z] ){3,}[a-z](?= )")


class _Folds(dict):
    """Code point to its folded form, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        low = c.lower()
        if low in HOMOGLYPHS:
            out = HOMOGLYPHS[low]
        elif c in SUBSTITUTES:
            out = SUBSTITUTES[c]
        else:
            kept = "".join(HOMOGLYPHS.get(x, x) for x in unicodedata.normalize("NFKC", low))
            out = "" if unicodedata.category(c) in ("Mn", "Cf") else kept if kept and kept.isalpha() else " "
        self[code] = out
        return out


_FOLDS = _Folds()


def fold(text: str | None) -> str:
    """Folded words with one space before each and one after the last."""
    text = text or ""
    if any(c in text for c in SIGNS):
        text = _SIGN.sub(lambda m: "".join(SIGNS[c] for c in m[0]), text)
    folded = _SPELLED.sub(lambda m: m[0].replace(" ", ""), f" {' '.join(text.translate(_FOLDS).split())} ")
    return _AGAIN.sub(r"\1", folded)


def terms_of(word: str) -> list[str]:
    return [f" {word} ", *[f" {word[:k]}" for k in range(4, 9) if len(word) > k]]


class Matcher:
    def __init__(self, lexicon: dict[str, float], exceptions: set[str] = frozenset()):
        self.exceptions = exceptions
        self.automaton = ahocorasick.Automaton() if lexicon else None
        for term, weight in sorted(lexicon.items(), key=lambda x: x[1]):
            for form in {term, term.replace("l", "i")}:
                self.automaton.add_word(form, (len(form), weight, term))
        if lexicon:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start of the word, weight of its strongest entry), without exceptions."""
        if self.automaton is None:
            return []
        best: dict[int, float] = {}
        for end, (n, weight, term) in self.automaton.iter(folded):
            if term[-1] != " " and folded[end + 1] == " ":
                continue  # a beginning that does not go on
            start = end - n + 2
            if weight > best.get(start, 0.0):
                best[start] = weight
        if self.exceptions and best:
            best = {a: w for a, w in best.items() if not self.exceptions & set(phrases(folded, a))}
        return sorted(best.items())


    def terms(self, folded: str) -> set[str]:
        return {t for end, (_, _, t) in self.automaton.iter(folded) if t[-1] == " " or folded[end + 1] != " "} if self.automaton else set()


def phrases(folded: str, start: int) -> list[str]:
    """The word at start with the one before and with the one after."""
    end = folded.index(" ", start)
    before = folded.rfind(" ", 0, max(0, start - 1)) + 1
    after = folded.find(" ", end + 1)
    return [folded[a:b] for a, b in ((before, end), (start, after)) if a < b and " " in folded[a:b]]


def measures(folded: str, hits: list[tuple[int, float]]) -> list[float]:
    """1, log of the total weight, and the weight by the square root of the number of words."""
    total = sum(w for _, w in hits)
    return [1.0, float(np.log1p(total)), total / max(1.0, folded.count(" ") - 1.0) ** 0.5]


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """At most max_train labelled rows (toxic, text, fold), none of them held out, chosen by hash."""
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    chosen = marked.filter(~held_out(F.col("label_id"))).orderBy(F.md5(F.col("label_id").cast("string")), "label_id").limit(max_train)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))  # max_train rows at most

    def keyed(ids, toxic, texts):
        keys = [hashlib.md5(fold(t).encode()).digest() for t in texts]
        return {"label_id": ids, "toxic": toxic, "text": texts, "key": keys, "fold": [k[0] % 3 for k in keys]}

    # whole copies would lend weight to any word of theirs; the first id, then the first text stays
    keys = arrow_map(rows.select("label_id", "toxic", "text"), keyed, "label_id long, toxic int, text string, key binary, fold int")
    return keys.groupBy("toxic", "key", "fold").agg(F.min(F.struct("label_id", "text")).alias("kept")).select("toxic", "kept.text", "fold")


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, *, max_train: int = 8000, min_docs: int | None = None, min_weight: float = 3.5) -> dict:
    """Lexicon, exception phrases and the three logistic coefficients; all come from at most max_train texts, which bounds them."""
    sample = training_rows(docs, labels, max_train).cache()
    try:
        return _fit(sample, min_docs, min_weight)
    finally:
        sample.unpersist()


def _fit(sample: DataFrame, min_docs: int | None, min_weight: float) -> dict:
    """The lexicon of all folds; the coefficients from measures of each fold under the lexicon of the others."""
    points = []
    for fold in range(3):
        lexicon, exceptions = _lexicon(sample.filter(F.col("fold") != fold), min_docs, min_weight)
        own = sample.filter(F.col("fold") == fold).select("toxic", "text")
        points += arrow_map_lexicon(own, lexicon, exceptions, measures_of, "y long, a double, b double").collect()  # max_train rows in all
    y = np.array([p.y for p in points], float)
    lexicon, exceptions = _lexicon(sample, min_docs, min_weight)
    if not len(y) or y.min() == y.max():
        return {"lexicon": {}, "exceptions": set(), "coefficients": [30.0 if len(y) and y[0] else -30.0, 0.0, 0.0]}
    return {"lexicon": lexicon, "exceptions": exceptions, "coefficients": logistic(np.array([[1.0, p.a, p.b] for p in points]), y).tolist()}


def _lexicon(sample: DataFrame, min_docs: int | None, min_weight: float) -> tuple[dict[str, float], set[str]]:
    sample = sample.select("toxic", "text")

    def count_terms(toxic, texts):
        n = [Counter(), Counter()]
        for y, text in zip(toxic, texts, strict=True):
            n[int(y > 0)].update({t for w in set(fold(text).split()) if len(w) > 2 for t in terms_of(w)})
        both = list(n[0].keys() | n[1].keys())
        return {"term": both, "clean": [n[0][t] for t in both], "toxic": [n[1][t] for t in both]}

    sizes = sample.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("t")).first()
    n_toxic, n_clean = sizes.t or 0, sizes.n - (sizes.t or 0)
    if not n_toxic or not n_clean:
        return {}, set()
    min_docs = max(3, n_toxic // 100) if min_docs is None else min_docs
    counts = arrow_map(sample, count_terms, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    rows = counts.filter(F.col("toxic") >= min_docs).withColumn("weight", weight).filter(F.col("weight") >= min_weight).collect()  # words of max_train texts
    lexicon: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r.term), r.term)):  # an entry must add to the shorter beginnings it contains
        if not any(lexicon.get(r.term[:k], -9.0) >= r.weight - 0.7 for k in range(4, len(r.term))):
            lexicon[r.term] = float(r.weight)

    # a beginning gives way to a longer one that is surer and holds nearly all of its toxic documents
    seen = {r.term: r.toxic for r in rows}
    lexicon = {t: w for t, w in lexicon.items() if not any(e != t and e.startswith(t) and lexicon[e] > w + 0.7 and seen[e] >= 0.9 * seen[t] for e in lexicon)}
    # an entry that clean documents hold must be the only sign of some toxic one
    use = arrow_map_lexicon(sample, lexicon, set(), count_uses_of, "term string, clean long, only long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("only").alias("only"))
    idle = {r.term for r in use.filter("clean > 0 and only = 0").collect()}
    lexicon = {t: w for t, w in lexicon.items() if t not in idle}
    found = arrow_map_lexicon(sample, lexicon, set(), count_phrases_of, "phrase string, clean long, toxic long")
    spared = found.groupBy("phrase").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("clean >= 3 and toxic = 0")
    return lexicon, {r.phrase for r in spared.collect()}


def arrow_map_lexicon(df: DataFrame, lexicon: dict, exceptions: set, fn, schema: str) -> DataFrame:
    """fn(matcher, *columns); the automaton is built once in each worker task."""
    made: list[Matcher] = []

    def run(*columns):
        if not made:
            made.append(Matcher(lexicon, exceptions))
        return fn(made[0], *columns)

    return arrow_map(df, run, schema)


def count_uses_of(matcher: Matcher, toxic: list, texts: list) -> dict:
    """For each entry, the clean documents that hold it and the toxic ones that hold no other."""
    clean, only = Counter(), Counter()
    for y, text in zip(toxic, texts, strict=True):
        held = matcher.terms(fold(text))
        if y <= 0:
            clean.update(held)
        elif len(held) == 1:
            only.update(held)
    both = list(clean.keys() | only.keys())
    return {"term": both, "clean": [clean[t] for t in both], "only": [only[t] for t in both]}


def count_phrases_of(matcher: Matcher, toxic: list, texts: list) -> dict:
    n = [Counter(), Counter()]
    for y, text in zip(toxic, texts, strict=True):
        folded = fold(text)
        n[int(y > 0)].update({p for a, _ in matcher.hits(folded) for p in phrases(folded, a)})
    both = list(n[0].keys() | n[1].keys())
    return {"phrase": both, "clean": [n[0][t] for t in both], "toxic": [n[1][t] for t in both]}


def measures_of(matcher: Matcher, toxic: list, texts: list) -> dict:
    m = []
    for text in texts:
        folded = fold(text)
        m.append(measures(folded, matcher.hits(folded)))
    return {"y": [int(y > 0) for y in toxic], "a": [x[1] for x in m], "b": [x[2] for x in m]}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 40) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of matched words of each whole text."""
    c = model["coefficients"]

    def run(matcher, ids, held, texts):
        scores, hits = [], []
        for text in texts:
            folded = fold(text)
            found = matcher.hits(folded)
            m = measures(folded, found)
            scores.append(float(1 / (1 + np.exp(-np.clip(sum(a * b for a, b in zip(c, m, strict=True)), -30, 30)))))
            hits.append(len(found))
        return {"doc_id": ids, "held_out": held, "score": scores, "predicted": [int(s >= 0.5) for s in scores], "n_hits": hits}

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return arrow_map_lexicon(rows, model["lexicon"], model["exceptions"], run, "doc_id long, held_out boolean, score double, predicted int, n_hits long")
