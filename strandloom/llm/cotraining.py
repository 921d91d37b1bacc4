"""Quality classifier by co-training of a text-content view and a page-metadata view.

The content view is a logistic model over what the whole text looks like (character classes, word lengths, function words
of the listed languages, repetition); the metadata view one over language, source and length fields. Both start from the
labelled rows. In each round either is fitted anew on the labelled rows and on all unlabelled documents of which the other
is confident, with the other's verdict as their label; these weigh no more than the labelled rows together. Each view is
then calibrated, and the calibrated views combined, on a fourth of the labelled rows that took no part (on all of them
where that fourth lacks a class).

Nothing is sampled: features are held once, in the shared folder, and every step of Newton's method is one pass over them
that adds up a gradient and a Hessian of fixed size. Null or empty text and null metadata are values of their own. Without
labels of both kinds all documents score 0.5 and are kept. Repeated rows, and rows that share or lack a doc_id, each get
their own result; of repeated labels the smallest counts. A very long text makes a row of features like any other. Other
columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quality_rules
from .common import arrow_map, map_batches, stored

SOURCES = 32
LANGS = sorted(quality_rules.COMMON_WORDS)
N_CONTENT, N_META = 20 + len(LANGS), len(LANGS) + SOURCES + 5
#: Languages of each function word.
_OF: dict[bytes, list[int]] = {}
for _i, _lang in enumerate(LANGS):
    for _w in quality_rules.COMMON_WORDS[_lang]:
        _OF.setdefault(_w.encode(), []).append(_i)


def content_view(texts: list[str | None]) -> np.ndarray:
    out = np.zeros((len(texts), N_CONTENT))
    for row, text in zip(out, texts, strict=True):
        raw = (text or "").encode()
        words = raw.split()
        chars = np.bincount(quality_rules._CLASS[np.frombuffer(raw, np.uint8)], minlength=quality_rules.CLASSES)
        hits, kinds = [0] * len(LANGS), [0] * len(LANGS)
        for w, k in Counter(words).items():
            for i in _OF.get(w) or _OF.get(w.strip(quality_rules._STRIP).lower(), ()):
                hits[i] += k
                kinds[i] += 1
        n, lines = len(words), raw.count(b"\n") + 1
        many = max(1, n)
        row[:8] = chars[:8] / max(1, chars[:8].sum())
        row[8 : 8 + len(LANGS)] = np.array(hits) / many
        row[-12:] = (
            max(hits) / many, max(kinds) / 30, (len(raw) - chars[8] - chars[1]) / many / 10, (len(raw) - len(raw.translate(None, b"#*$%&|<>"))) / many,
            quality_rules.dup_lines(raw) / lines, quality_rules.repeat_words(words) / many, np.log1p(n) / 8, n < 20, n < 6, n == 0, many / lines / 50, np.log1p(len(raw)) / 12,
        )
    return out


def metadata_view(langs: list, sources: list, sizes: list) -> np.ndarray:
    out = np.zeros((len(langs), N_META))
    for i, (lang, source, size) in enumerate(zip(langs, sources, sizes, strict=True)):
        out[i, LANGS.index(lang) if lang in LANGS else len(LANGS)] = 1
        out[i, len(LANGS) + 1 + zlib.crc32((source or "").encode()) % SOURCES] = 1
        n = np.log1p(max(0, size or 0)) / 10
        out[i, -4:] = n, n * n, size is None, (size or 0) < 100
    return out


_META = ("lang", "source", "n_chars")


def features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, y (1, 0, or -1 without a label), aside, content and meta of each document; held in the shared folder."""

    def run(ids, texts, langs, sources, sizes):
        return {"doc_id": ids, "content": content_view(texts).tolist(), "meta": metadata_view(langs, sources, sizes).tolist()}

    rows = arrow_map(docs.select("doc_id", "text", *_META), run, "doc_id long, content array<double>, meta array<double>")
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("q"))
    y = F.when(F.col("q").isNull(), -1).when(F.col("q") > 0, 1).otherwise(0)
    aside = F.col("q").isNotNull() & (F.pmod(F.xxhash64("id"), F.lit(4)) == 3)
    return stored(rows.join(marks, F.col("doc_id") == F.col("id"), "left").select("doc_id", y.alias("y"), aside.alias("aside"), "content", "meta"), "views")


def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """y, aside and the two views of a batch of features."""
    views = [batch.column(i).flatten().to_numpy().reshape(batch.num_rows, -1) for i in (3, 4)]
    return batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), views


def added(feats: DataFrame, fn: Callable[[np.ndarray, np.ndarray, list[np.ndarray]], np.ndarray]) -> np.ndarray:
    """The sum of fn(y, aside, views) over all batches, a vector of fixed size. One number each reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = fn(*arrays(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    rows = map_batches(feats.select("doc_id", "y", "aside", "content", "meta"), run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(rows, key=lambda r: r.i)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient, Hessian (flat) and number of rows of a logistic model with the constant last."""
    z = np.column_stack([x, np.ones(len(x))])
    p = sigmoid(z @ w)
    return np.concatenate([z.T @ (p - y), ((z * (p * (1 - p))[:, None]).T @ z).ravel(), [len(x)]])


def stepped(w: np.ndarray, sums: np.ndarray, ridge: float) -> np.ndarray:
    """One step of Newton's method with a ridge on all but the constant. Rounded, as sums come in any order."""
    d = len(w)
    penalty = np.append(np.full(d - 1, ridge), 1e-6)
    step = np.linalg.solve(sums[d : d + d * d].reshape(d, d) + np.diag(penalty + 1e-9), sums[:d] + penalty * w)
    return np.round(w - step / max(1.0, np.abs(step).max() / 2), 9)


def parts(sums: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """The slopes of models with the given numbers of weights, put one after the other."""
    ends = np.cumsum([d + d * d + 1 for d in sizes])
    return np.split(sums, ends[:-1])


def co_train(feats: DataFrame, *, rounds: int = 4, confident: float = 0.9, steps: int = 8) -> dict | None:
    """The model from features(); None without labels of both kinds."""
    labelled = stored(feats.filter("y >= 0"), "labelled")
    counts = {(r.y, r.aside): r["count"] for r in labelled.groupBy("y", "aside").count().collect()}  # four rows at most
    if any(not counts.get((y, False), 0) + counts.get((y, True), 0) for y in (0, 1)):
        return None
    learn_all = any((y, False) not in counts for y in (0, 1))  # a class is only among the rows set aside
    judge_all = any((y, True) not in counts for y in (0, 1))
    d = len(labelled.select("content").first().content)
    moments = added(feats, lambda y, aside, v: np.concatenate([[len(y)], *[f(x) for f in (lambda x: x.sum(0), lambda x: (x * x).sum(0)) for x in v]]))
    half = (len(moments) - 1) // 2
    mean = moments[1 : 1 + half] / moments[0]
    spread = np.sqrt(np.maximum(0, moments[1 + half :] / moments[0] - mean**2))
    spread[spread < 1e-9] = 1.0
    mean, spread = np.round(mean, 12), np.round(spread, 12)
    scale = [(mean[:d], spread[:d]), (mean[d:], spread[d:])]
    standard = lambda v: [(x - m) / s for x, (m, s) in zip(v, scale, strict=True)]
    sizes = [d + 1, half - d + 1]
    fits = [np.zeros(k) for k in sizes]
    learns = lambda y, aside: (y >= 0) & (learn_all | ~aside)

    def from_labels(y, aside, v):
        on = learns(y, aside)
        return np.concatenate([slopes(x[on], y[on], w) for x, w in zip(standard(v), fits, strict=True)])

    for _ in range(steps):
        fits = [stepped(w, s, 1.0) for w, s in zip(fits, parts(added(labelled, from_labels), sizes), strict=True)]
    given = [0, 0]
    for _ in range(rounds):
        givers = fits[::-1]

        def from_other(y, aside, v):
            x = standard(v)
            p = [sigmoid(logits(x[1 - i], givers[i])) for i in (0, 1)]  # noqa: B023
            on = [(y < 0) & (np.abs(q - 0.5) >= confident - 0.5) for q in p]
            return np.concatenate([slopes(x[i][on[i]], (p[i][on[i]] > 0.5).astype(float), fits[i]) for i in (0, 1)])  # noqa: B023

        for _ in range(2):
            own, other = parts(added(labelled, from_labels), sizes), parts(added(feats, from_other), sizes)
            given = [int(s[-1]) for s in other]
            fits = [stepped(w, a + b * min(1.0, a[-1] / max(1.0, b[-1])), 1.0) for w, a, b in zip(fits, own, other, strict=True)]
    # Platt scaling of each view, then a logistic combination of the calibrated views
    judges = lambda y, aside: (y >= 0) & (judge_all | aside)
    scales, top = [np.zeros(2)] * 2, np.zeros(3)
    each = lambda v: [logits(x, w)[:, None] for x, w in zip(standard(v), fits, strict=True)]

    def platt(y, aside, v):
        on = judges(y, aside)
        return np.concatenate([slopes(z[on], y[on], w) for z, w in zip(each(v), scales, strict=True)])

    def combined(y, aside, v):
        on = judges(y, aside)
        return slopes(np.column_stack([logits(z, w) for z, w in zip(each(v), scales, strict=True)])[on], y[on], top)

    for _ in range(steps):
        scales = [stepped(w, s, 0.1) for w, s in zip(scales, parts(added(labelled, platt), [2, 2]), strict=True)]
    for _ in range(steps):
        top = stepped(top, added(labelled, combined), 0.1)
    # weights for raw columns
    raw = [np.append(w[:-1] / s, w[-1] - (w[:-1] / s) @ m) for w, (m, s) in zip(fits, scale, strict=True)]
    return {"fits": raw, "scales": scales, "top": top, "given": given}


def predict(model: dict | None, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of the content view, the metadata view and both, rounded so that they do not depend on the batch."""
    if model is None:
        half = np.full(len(content), 0.5)
        return half, half, half
    each = [logits(logits(v, w)[:, None], s) for v, w, s in zip((content, meta), model["fits"], model["scales"], strict=True)]
    return tuple(np.round(sigmoid(z), 9) for z in (*each, logits(np.column_stack(each), model["top"])))


def fit(docs: DataFrame, labels: DataFrame, **options) -> dict | None:
    return co_train(features(docs, labels), **options)


_SCORES = "doc_id long, content_score double, metadata_score double, score double, kept boolean"


def scored(feats: DataFrame, model: dict | None, *, least: float = 0.5) -> DataFrame:
    """score() of documents whose features are held already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, c = predict(model, *arrays(batch)[2])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a), pa.array(b), pa.array(c), pa.array(c >= least)], names=["doc_id", "content_score", "metadata_score", "score", "kept"])

    return map_batches(feats.select("doc_id", "y", "aside", "content", "meta"), run, _SCORES)


def score(docs: DataFrame, model: dict | None, *, least: float = 0.5) -> DataFrame:
    """doc_id, content_score, metadata_score, score and kept of every document."""

    def run(ids, texts, langs, sources, sizes):
        a, b, c = predict(model, content_view(texts), metadata_view(langs, sources, sizes))
        return {"doc_id": ids, "content_score": a, "metadata_score": b, "score": c, "kept": c >= least}

    return arrow_map(docs.select("doc_id", "text", *_META), run, _SCORES)


def keep(docs: DataFrame, model: dict | None, *, least: float = 0.5) -> DataFrame:
    """The rows of docs that score() keeps, with their own columns; the verdict is made where the row is read."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            columns = [batch.column(names.index(c)).to_pylist() for c in ("text", *_META)]
            _, _, p = predict(model, content_view(columns[0]), metadata_view(*columns[1:]))
            yield batch.filter(pa.array(p >= least))

    return map_batches(docs, run, docs.schema)
