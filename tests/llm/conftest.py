from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def invented(rng: random.Random, n: int) -> str:
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w if rng.random() > 0.1 else "the" for w in words)


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """Texts with copies, near copies, shared passages, periodic stretches, repeated rows, nulls and blanks."""
    rng = random.Random(5)
    passage = invented(rng, 40)
    texts = [invented(rng, rng.randint(1, 120)) for _ in range(60)]
    base = invented(rng, 90).split(" ")
    for k in range(25):
        w = list(base)
        for _ in range(k // 4):
            w[rng.randrange(len(w))] = "x" + str(rng.randrange(99))
        texts.append(" ".join(w))
    texts += [texts[0], texts[5], texts[5].upper(), texts[7] + " " + passage, passage + "\n" + texts[9], "é" * 130 + passage, passage]
    texts += ["the " * 80, "the " * 81, "ab" * 90, "a" * 400, "", None, None, " \t\n\x0b\x0c\r ", "one", "one", "ONE", "two words", "two words", " nbsp word"]
    rows = [(i * 3 + 1, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[3], (None, "no id here " + passage, None, None, 5)]


@pytest.fixture()
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def extra(docs):
    """The same rows with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return docs.withColumns({n: F.lit(1) for n in ("id", "node", "doc", "h", "n", "slot", "kept", "component", "key", "y", "score", "cls", "value", "q")})
