"""Mixing, the classifier, toxicity, HTML and the pipeline."""

from __future__ import annotations

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from strandloom.llm import cotraining, html_text, mixing, repeats, secrets, toxicity
from strandloom.llm.textkit import LOWER, STEP, hashes, steps, words

from ..conftest import DATA
from .conftest import SCHEMA, invented
from .test_dedup import brute_components, shingles
from .test_rules import brute_contaminated, brute_spans

SF = f"{DATA}/sf0.001"


def simulate(q: dict[str, int]) -> list[str]:
    """Earliest deadline first among released blocks, slot by slot."""
    p, done, out = sum(q.values()), dict.fromkeys(q, 0), []
    for t in range(p):
        ready = [(-(-(done[s] + 1) * p // q[s]), s) for s in sorted(q) if done[s] * p // q[s] <= t]
        s = min(ready)[1]
        done[s] += 1
        out.append(s)
    return out


def test_schedule_is_pfair(spark):
    q = {"a": 13, "b": 5, "c": 1, "d": 31}
    shares = spark.createDataFrame([(s, 100, n) for s, n in q.items()], "mix_source string, n bigint, q bigint")
    got = [r.mix_source for r in mixing.schedule(shares).orderBy("at").collect()]
    assert got == simulate(q)
    done = dict.fromkeys(q, 0)
    for t, s in enumerate(got, 1):
        done[s] += 1
        assert all(abs(done[x] - t * q[x] / 50) < 1 for x in q)


def test_mix_places_every_row_once_and_within_a_block(spark):
    rows = [(i, None if i % 50 == 0 else f"s{min(i % 7, 3)}") for i in range(900)] + [(5, "s3"), (5, "s3"), (None, "s1")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), {"s0": 1, "s1": 2, "s2": 3, "s3": 6}, block=4).collect()
    assert sorted(r.position for r in got) == list(range(len(rows)))
    got.sort(key=lambda r: r.position)
    order = [r.source or "" for r in got]
    assert [r.slot for r in got] == sorted(r.slot for r in got)
    weight = {"s0": 2, "s1": 4, "s2": 6, "s3": 12, "": 0}
    whole, seen = sum(weight.values()), dict.fromkeys(weight, 0)
    for t in range(0, 100, 4):
        for s in order[t : t + 4]:
            seen[s] += 1
        assert all(abs(seen[s] / 4 - (t + 4) / 4 * weight[s] / whole) < 1 for s in weight)
    assert "" not in order[: -order.count("")]  # a source that the weights do not name comes last


def test_mix_keeps_to_weights_that_no_period_holds(spark):
    weight = {"a": 10.0, "b": 3.3, "c": 1.7, "d": 0.004}
    rows = [(i, s) for i, s in enumerate("a" * 1500 + "b" * 600 + "c" * 500 + "d" * 3)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), weight, block=1).orderBy("position").collect()
    assert [r.position for r in got] == [r.slot for r in got] == list(range(len(rows)))
    end = max(i for i, r in enumerate(got) if r.source == "a")
    for first, last, names in ((0, end, "abcd"), (end + 1, end + 120, "bcd")):
        whole, seen = sum(weight[s] for s in names), dict.fromkeys(names, 0)
        for t in range(first, last + 1):
            seen[got[t].source] += 1
            assert all(abs(seen[s] - (t + 1 - first) * weight[s] / whole) < 1 + 1e-5 for s in names)


def test_mix_without_positive_weights_shares_alike(spark):
    rows = [(i, f"s{i % 2}") for i in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), {"s0": 0.0}, block=1).orderBy("position").collect()
    assert [r.source for r in got] == ["s0", "s1"] * 20
    with pytest.raises(ValueError):
        mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), {"s0": -1.0})


def test_mix_passes_very_long_texts_and_any_column_name(spark):
    from pyspark.sql import functions as F

    names = ("mix_source", "mix_rank", "o_source", "o_block", "k", "at", "start", "row", "own_q", "q_source", "mix_n", "a.b")
    docs = spark.createDataFrame([(1, "x" * 400_000, "a"), (2, None, "a"), (2, None, "a"), (None, "", None)], "doc_id bigint, text string, source string").withColumns({n: F.lit(1) for n in names})
    got = mixing.mix(docs, block=1).collect()
    assert sorted(r.position for r in got) == [0, 1, 2, 3] and max(len(r.text or "") for r in got) == 400_000 and got[0]["a.b"] == 1


def test_mix_of_nothing_and_of_clashing_columns(spark, empty, extra):
    assert mixing.mix(empty).collect() == []
    got = mixing.mix(extra)
    assert sorted(got.columns) == sorted({*extra.columns, *mixing.ADDED}) and got.count() == extra.count()
    assert mixing.laid_out(mixing.mix(extra)).count() == extra.count()


def _nodes(plan):
    """All nodes of an executed plan."""
    yield plan
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        below = [plan.executedPlan()]
    elif name.endswith("QueryStage"):
        below = [plan.plan()]
    else:
        below = [plan.children().apply(i) for i in range(plan.children().size())]
    for p in below:
        yield from _nodes(p)


def test_mixing_sorts_no_texts(docs):
    """Rows of different ids pass by: no sort and no window holds them."""
    rows = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = rows.sparkSession.createDataFrame(rows.collect(), rows.schema)
    got = mixing.mix(rows)
    assert sorted(r.position for r in got.collect()) == list(range(rows.count()))
    held = [n for n in _nodes(got._jdf.queryExecution().executedPlan()) if n.nodeName() in ("Sort", "Window", "SortMergeJoin")]
    assert held
    for n in held:
        out = [n.output().apply(i).name() for i in range(n.output().size())]
        assert "row" not in out and "text" not in out, (n.nodeName(), out)


def test_mixing_of_equal_ids(spark):
    """Rows of one hash follow each other by id and text, over the ends of blocks too."""
    rows = [(7, f"t{i:02d}", "a") for i in range(40)] + [(None, f"n{i}", "a") for i in range(5)] + [(i, "x", "a") for i in range(100, 160)] + [(7, "t03", "a")] * 2
    random.Random(3).shuffle(rows)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), block=4).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows))) and [r.block for r in got] == [i // 4 for i in range(len(rows))]
    for d in (7, None):
        own = [(r.position, r.text) for r in got if r.doc_id == d]
        assert [t for _, t in own] == sorted(t for _, t in own) and own[-1][0] - own[0][0] == len(own) - 1
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((d, t) for d, t, _ in rows), key=str)


def views(spark, content, meta, y, aside):
    rows = [(i, int(a), bool(z), c.tolist(), m.tolist()) for i, (a, z, c, m) in enumerate(zip(y, aside, content, meta, strict=True))]
    return spark.createDataFrame(rows, "doc_id bigint, y int, aside boolean, content array<double>, meta array<double>")


def test_co_training_learns_from_few_labels(spark):
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 2, 2000)
    content = truth[:, None] * 1.5 + rng.normal(size=(2000, 3))
    meta = truth[:, None] * 1.5 + rng.normal(size=(2000, 2))
    y = np.where(np.arange(2000) < 120, truth, -1)
    aside = (y >= 0) & (np.arange(2000) % 4 == 3)
    model = cotraining.co_train(views(spark, content, meta, y, aside))
    a, b, p = cotraining.predict(model, content[1000:], meta[1000:])
    assert ((p > 0.5) == truth[1000:]).mean() > 0.93 and min(model["given"]) > 90
    assert ((p > 0.5) == truth[1000:]).mean() > max(((x > 0.5) == truth[1000:]).mean() for x in (a, b))
    # the fourth that is set aside lacks a class: all labelled rows calibrate
    assert cotraining.co_train(views(spark, content, meta, y, aside & (truth == 1))) is not None
    assert cotraining.co_train(views(spark, content, meta, np.where(y == 1, -1, y), aside)) is None


def test_a_newton_step_equals_the_sums_of_one_table():
    rng = np.random.default_rng(2)
    x, w = rng.normal(size=(50, 3)), rng.normal(size=4)
    y = (rng.random(50) > 0.5).astype(float)
    whole = cotraining.slopes(x, y, w)
    assert np.allclose(whole, cotraining.slopes(x[:20], y[:20], w) + cotraining.slopes(x[20:], y[20:], w))
    z = np.column_stack([x, np.ones(50)])
    p = 1 / (1 + np.exp(-z @ w))
    h = sum(a * (1 - a) * np.outer(r, r) for a, r in zip(p, z, strict=True)) + np.diag([1, 1, 1, 1e-6])
    step = np.linalg.solve(h, z.T @ (p - y) + np.array([1, 1, 1, 1e-6]) * w)
    assert np.allclose(cotraining.stepped(w, whole, 1.0), w - step / max(1.0, np.abs(step).max() / 2), atol=1e-6)


def test_classifier_takes_long_and_repeated_texts(spark, docs):
    more = spark.createDataFrame([(900, "word and the " * 60_000, "en", "s", None), (901, None, None, None, None), (901, None, None, None, None)], docs.schema)
    labels = spark.createDataFrame([(i * 3 + 1, i % 2) for i in range(60)] + [(1, 0), (None, 1)], "doc_id bigint, quality int")
    both = docs.unionByName(more)
    feats = cotraining.features(both, labels)
    model = cotraining.co_train(feats)
    first = sorted(map(str, cotraining.scored(feats, model).collect()))
    assert first == sorted(map(str, cotraining.score(both, model).collect())) and len(first) == both.count()


def held_out_accuracy(spark, column: str, predict) -> float:
    docs, labels = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet"), spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    train, test = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    got = predict(docs, train).join(test, "doc_id")
    return got.selectExpr(f"avg(double(p = {column})) as a").first().a


@pytest.mark.skipif(not os.path.exists(f"{DATA}/sf0.1"), reason="needs the driver's tables")
def test_classifier_on_held_out_labels(spark):
    assert held_out_accuracy(spark, "quality", lambda d, t: cotraining.score(d, cotraining.fit(d, t)).selectExpr("doc_id", "int(kept) as p")) > 0.97


@pytest.mark.skipif(not os.path.exists(f"{DATA}/sf0.1"), reason="needs the driver's tables")
def test_toxicity_on_held_out_labels(spark):
    assert held_out_accuracy(spark, "toxic", lambda d, t: toxicity.score(d, toxicity.fit(d, t)).selectExpr("doc_id", "predicted as p")) > 0.97


def test_classifier_edges(spark, docs, empty, extra):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert cotraining.fit(docs, none) is None
    assert cotraining.score(docs, None).filter("kept and score = 0.5").count() == docs.count()
    assert cotraining.score(empty, None).collect() == []
    assert cotraining.keep(extra, None).columns == extra.columns and cotraining.keep(extra, None).count() == extra.count()


def toxic_rows(n=120):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        w = invented(rng, 40).split(" ")
        if bad:
            for word in ("vilestword", "grimbler"):
                w.insert(rng.randrange(40), word)
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_folds_and_holds_out(spark):
    rows, labels = toxic_rows()
    rows += [(1000, "oh v1l3stw0rd there", "en", "s", 1), (1001, "you grіmblеr", "en", "s", 1), (1002, None, "en", "s", 1), (1003, "", "en", "s", 1), (1004, "kind words only", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame([*labels, labels[0], (5, None)], "doc_id bigint, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 1004)] == [1, 1, 0, 0, 0]
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(got[i].predicted == y for i, y in labels)


def test_toxicity_fits_on_all_but_whole_copies(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}word" for a in ("quiet", "loose", "green") for b in ("stone", "river")]
    texts = [f"{vocabulary[i % 6]} {vocabulary[i // 6 % 6]} {invented(rng, 10)} no {'xyz'[i % 3] * 2} {i}" for i in range(90)]
    texts = list({toxicity.fold(t): t for t in texts}.values())
    rows = [(i, t) for i, t in enumerate(texts)] + [(2000 + i, t.upper() + "!") for i, t in enumerate(texts)]
    rows = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    labels = [(i, i % 2) for i, _ in rows]
    got = toxicity.training_rows(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), 8000).collect()
    first = {}
    for i, t in rows:
        first.setdefault((i % 2, toxicity.fold(t)), t)
    assert sorted((r.toxic, r.text) for r in got) == sorted((y, t) for (y, _), t in first.items())
    assert {r.fold for r in got} == {0, 1, 2}


def test_toxicity_exceptions_and_edges(spark, docs, empty):
    m = toxicity.Matcher({" vile ": 2.0, " viles": 3.0}, {"not vile"})
    assert m.hits(toxicity.fold("Vile, VILEST!")) == [(1, 2.0), (6, 3.0)]
    assert m.hits(toxicity.fold("v!lest$$$ vi1eee v i l e viles")) == [(1, 3.0), (8, 2.0), (13, 2.0)]
    assert m.hits(toxicity.fold("it is not vile")) == []
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(empty, none).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no";</script><style>p{}</style></head><body>
<nav><ul><li>Home</li></ul></nav><div class="ad">Buy</div><article><header><h1>Head &amp; more</h1></header><p>One<br>two  <b>bold</b></p>
<!-- <p>gone</p> --><aside>side</aside><p>Three &lt;4&gt; <a href="x>y">link</a><p>Four<div class="comments"><p>I like it</p></div></article><footer>&copy; us</footer></body></html>"""


def test_extraction_of_marked_pages(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, None, None), (3, "http://a.example/y", ""), (1, "http://a.example/x", PAGE), (4, "bad url", "<p>lone &am</p>")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 5
    assert by[1].text == "Head & more\nOne two bold\nThree <4> link\nFour" and by[1].n_chars == len(by[1].text)
    assert (by[2].text, by[3].text, by[4].text) == ("", "", "lone &am")
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_names_inside_an_article(spark):
    inside = '<section id="search-trees"><p>Trees</p></section><div class="share-price-history"><p>Prices</p></div><div class="reader-comments"><p>no</p></div><div class="user-comment">no</div><div id="newsletterSignup">no</div>'
    rows = [(1, "http://h/1", f"<article><p>Top</p>{inside}</article>"), (2, "http://h/2", f"<main><p>Top</p>{inside}</main>"), (3, "http://g/2", f"<p>Top</p>{inside}")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.text for r in got} == {"Top\nTrees\nPrices"}


def brute_pages(rows: list[tuple]) -> list[tuple]:
    """(page_id, text, blocks of boilerplate): six-word runs of a host, word by word."""
    pages = []
    for i, url, html in rows:
        found = html_text.blocks(html)
        words = [w for t, z in found if z != html_text.CONTENT for w in t.split(" ")]
        host = url.split("/")[2].lower() if url and "://" in url else ""
        pages.append(((i, url, html), host, found, words + ["<end>"] * 5 if len(words) >= 6 else []))
    holders: dict = {}
    for key, host, _, words in pages:
        for j in range(len(words) - 5):
            holders.setdefault((host, tuple(words[j : j + 6])), set()).add(key)
    out = []
    for key, host, found, words in pages:
        gone = {k for j in range(len(words) - 5) if len(holders[host, tuple(words[j : j + 6])]) > 1 for k in range(j, j + 6)}
        kept, at, many = [], 0, 0
        marked = any(z == html_text.CONTENT for _, z in found)
        for t, z in found:
            if z == html_text.CONTENT:
                kept.append(t)
                continue
            n = len(t.split(" "))
            if 100 * sum(k in gone for k in range(at, at + n)) >= 80 * n:
                many += 1
            elif z == html_text.PLAIN and not marked:
                kept.append(t)
            at += n
        out.append((key[0], "\n".join(kept), many))
    return out


@pytest.fixture()
def hosts():
    """Pages of few hosts, most without article: menus, footers, notices, shared paragraphs, near copies, repeated rows."""
    rng = random.Random(8)
    menu, notice, foot = "Home News Sport Weather More About", "We use small files to keep this site alive", "Contact us by post only at the old mill"
    rows = []
    for i in range(60):
        body = [invented(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 4))]
        if i % 7 == 0 and rows:
            body[0] = invented(random.Random(99), 30)
        divs = "".join(f"<div>{b}</div>" for b in [menu, *body, notice if i % 2 else invented(rng, 8), foot])
        html = f"<body><nav><a>Top</a></nav>{divs}</body>" if i % 5 else f"<body><div>{menu}</div><article><p>{body[0]}</p></article><div>{foot} {i}</div></body>"
        rows.append((i, f"http://{'big' if i % 3 else 'small'}.example/{i}", html))
    return [*rows, rows[1], (None, rows[2][1], rows[2][2]), (None, None, "<p>one two three four five six seven</p>"), (70, None, None), (71, "x", ""), (72, "http://big.example/l", f"<div>{menu}</div><p>{'very long ' * 40_000}</p><div>{foot}</div>")]


@pytest.mark.parametrize("limit", [4096, 2])
def test_host_suffix_array_equals_brute_force(spark, hosts, limit, monkeypatch):
    monkeypatch.setattr(repeats, "LIMIT", limit)
    df = spark.createDataFrame(hosts, "page_id bigint, url string, html string").repartition(6)
    got = html_text.extract(df).collect()
    want = brute_pages(hosts)
    assert sorted(((r.page_id, r.text, r.n_boilerplate) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in got) and sum(r.n_boilerplate for r in got) > 100
    assert not any("Contact us by post" in r.text for r in got if r.page_id is not None and r.page_id % 5)


def test_extraction_with_clashing_columns(spark, hosts):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(hosts, "page_id bigint, url string, html string")
    extra = df.withColumns({n: F.lit(1) for n in ("doc", "sub", "salt", "text", "texts", "zones", "stretches", "s_doc", "s_sub", "key")})
    assert sorted(map(str, html_text.extract(extra).collect())) == sorted(map(str, html_text.extract(df).collect()))


def test_short_page_ends_are_found(spark):
    rng = random.Random(9)
    texts = [invented(rng, 20) for _ in range(3)]
    rows = [(i, f"http://h.example/{i}", f"<div>{t}</div><div>Contact us</div>") for i, t in enumerate(texts)]
    rows += [(10, "http://h.example/m", f"<div>Contact us</div><div>{invented(rng, 20)}</div>"), (11, "http://h.example/n", "<div>Contact us</div>")]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(3)] == texts
    assert got[10].startswith("Contact us\n") and got[11] == "Contact us"


def test_toxicity_takes_long_repeated_and_clashing_rows(spark, extra):
    rows, labels = toxic_rows()
    rows += [(2000, "kind words " * 40_000 + "vilestword grimbler", "en", "s", 1), (0, rows[0][1], "en", "s", 1), (None, rows[0][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(r.predicted == 1 for r in got if r.doc_id in (0, None)) and [r.n_hits for r in got if r.doc_id == 2000] == [2]
    assert toxicity.score(extra, model).count() == extra.count()


def test_the_automaton_finds_what_a_plain_search_finds():
    rng = random.Random(4)
    lexicon = {" ab ": 1.0, " abc": 2.5, " abcd": 2.0, " b ": 0.5, " cab ": 4.0}
    m = toxicity.Matcher(lexicon, {"b cab"})
    for _ in range(300):
        words = ["".join(rng.choices("abcd", k=rng.randint(1, 6))) for _ in range(12)]
        want, at = [], 1
        for i, w in enumerate(words):
            weights = [v for t, v in lexicon.items() if (t.strip() == w if t.endswith(" ") else w.startswith(t.strip()) and len(w) > len(t.strip()))]
            near = {" ".join(words[j : j + 2]) for j in (i - 1, i) if 0 <= j and j + 2 <= len(words)}
            if weights and "b cab" not in near:
                want.append((at, max(weights)))
            at += len(w) + 1
        assert m.hits(f" {' '.join(words)} ") == want


def test_steps_and_hashes_do_not_depend_on_where_texts_stand():
    texts = ["ab cd", None, "", "x" * (STEP + 5), "cd ab\tab"]
    seen: dict = {}
    for first, codes, offsets in steps(texts):
        a, b = words(LOWER[codes])
        for h, i, j in zip(hashes(codes, a, b).tolist(), a, b, strict=True):
            assert seen.setdefault(codes[i:j].tobytes(), h) == h
        assert offsets[0] == 0 and first + len(offsets) - 1 <= len(texts)
    assert len(set(seen.values())) == 3


def by_position(weights: dict, ids: list[tuple]) -> list:
    """Documents (hash, id, text, source) in the order of a plain earliest-deadline-first run over blocks of 16."""
    queues = {s: sorted(x[:3] for x in ids if x[3] == s) for s in weights}
    blocks = {s: -(-len(q) // 16) for s, q in queues.items()}
    done, base, since, whole, out, t = dict.fromkeys(weights, 0), dict.fromkeys(weights, 0), 0, sum(weights.values()), [], 0
    while any(done[s] < blocks[s] for s in weights):
        live = [s for s in sorted(weights) if done[s] < blocks[s]]
        late = lambda s: math.floor((done[s] - base[s]) * whole / weights[s] + 1e-6) > t - since  # noqa: B023, E731
        due = lambda s: math.ceil((done[s] + 1 - base[s]) * whole / weights[s] - 1e-6)  # noqa: B023, E731
        s = min(live, key=lambda s: (late(s), due(s), s))
        out += queues[s][16 * done[s] : 16 * done[s] + 16]
        done[s] += 1
        t += 1
        if done[s] == blocks[s]:
            base, since, whole = dict(done), t, sum(w for x, w in weights.items() if done[x] < blocks[x])
    return [x[1] for x in out]


def test_pipeline_equals_brute_force(spark):
    """Every stage but the classifier's scores by plain loops: no hashes, sketches, joins or bins."""
    import corpus_pipeline as c

    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    more = spark.createDataFrame([(9001, None, "en", "web", None), (9002, "", "en", "web", 0), (9003, bench[0][1] * 3, "en", "web", 3), (None, "a text of its own without an id", "en", None, 31)], docs.schema)
    first = docs.limit(1).collect()[0]
    docs = docs.unionByName(more).unionByName(spark.createDataFrame([tuple(first)], docs.schema))
    model = cotraining.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = [r for r in cotraining.keep(docs, model, least=c.LEAST_QUALITY).collect()]
    assert 0.5 < len(kept) / docs.count() < 1
    # one row of each group of near duplicates
    rows = [(r.doc_id, r.text) for r in kept]
    component, _ = brute_components(rows, 5)
    one: dict = {}
    for r, k in zip(kept, component, strict=True):
        if shingles(r.text, 5):
            one.setdefault(("id", k) if k is not None else ("text", r.text), []).append(r)
        else:
            one[len(one), "blank"] = [r]
    kept = [next(r for r in g if k[0] != "id" or r.doc_id == k[1]) for k, g in one.items()]
    kept = [r for r in kept if not any(brute_contaminated(r.text, t) for _, t in bench)]
    spans = brute_spans([r.text for r in kept])
    texts = [r.text and secrets.redact_text(r.text, x) for r, x in zip(kept, spans, strict=True)]
    ids = [(hashlib.md5(("mix" + str("" if r.doc_id is None else r.doc_id)).encode()).hexdigest(), r.doc_id, t, r.source or "") for r, t in zip(kept, texts, strict=True)]
    counts = Counter(x[3] for x in ids)
    order = by_position({s: n**0.5 for s, n in counts.items()}, ids)
    got = c.applied(spark, docs, SF).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(got)))
    assert [r.doc_id for r in got] == order
    want = {r.doc_id: (t, r.lang, r.source, r.n_chars if t is None else len(t)) for r, t in zip(kept, texts, strict=True)}
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in got} == want
    for name, stage in c.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
