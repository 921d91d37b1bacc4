"""Quality rules, secrets and decontamination."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strandloom.llm import decontamination, quality_rules, secrets

from .conftest import SCHEMA, invented


def brute_quality(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    marked = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(marked), failed


def test_quality_counts_equal_brute_force(spark, docs, corpus):
    more = ["a b c d e f g h i a b c d e f g h i", "x\nx\n\n \ny\nx", "#*$%&|<> ok", "wörter größe ß breit"]
    df = docs.unionByName(spark.createDataFrame([(9000 + i, t, "de", "s", 1) for i, t in enumerate(more)], SCHEMA))
    got = sorted(map(str, ((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(df).collect())))
    assert got == sorted(str(brute_quality(t)) for t in [*[r[1] for r in corpus], *more])


def test_junk_is_rejected_and_prose_kept(spark):
    rng = random.Random(1)
    prose = lambda: " ".join(rng.choices(quality_rules.COMMON_WORDS["en"], k=60) + [invented(rng, 1) for _ in range(60)])
    rows = [(i, prose(), "en", "s", 1) for i in range(30)] + [(100, " ".join(x + "%%%&&&###$$$" for x in prose().split()), "en", "s", 1), (101, prose().upper(), "en", "s", 1)]
    kept = {r.doc_id for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).filter("kept").collect()}
    assert kept == set(range(30))


def test_js_distance(spark):
    row = spark.sql("select array(1L, 0L) as p, array(0L, 5L) as q, array(2L, 0L) as r, array() as e").select(quality_rules.js_distance("p", "q").alias("far"), quality_rules.js_distance("p", "r").alias("near"), quality_rules.js_distance("p", "e").alias("none")).first()
    assert (row.far, row.near, row.none) == (1.0, 0.0, None)


def test_quality_of_nothing(empty):
    assert quality_rules.judge(empty).collect() == []


HEX, KEY = "0123456789abcdef" * 2, "AKIA" + "ABCDEFGHIJ234567"
TEXTS = [
    f'é password = "abc123" x {HEX} {KEY}', "Token:short", "api_key='aB+/_.=-9' APIKEY=zzzzzz", "secret=secret=abcdefgh", "password=token:abcdefg", "tokenſ=abcdefgh paſſword=abcdefgh",
    f"{KEY[:-1]} {HEX[:23]} {HEX[:24]}", "AKIA" * 6, "passwd  :   'x" + "y" * 9, "PassWord\"=\"longer1", "", None, "a" * 30, "secret\n=\nabcdefgh", "x" + HEX.upper() + HEX,
]


def brute_secrets(text: str | None) -> list:
    text, found = text or "", []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, (name, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)), 1):
        found += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [x for _, _, x in sorted(found)]


def test_base_secrets_equal_brute_force(spark):
    got = {r.doc_id: r for r in secrets.digests(spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")).collect()}
    for i, t in enumerate(TEXTS):
        want = brute_secrets(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(got[i].spans.split(",")) or not want


def brute_spans(texts: list) -> list[list]:
    """All spans of each text: the rules, and the candidates that a plain step-up over both p-values of the corpus leaves."""
    base = [secrets.base_spans(t or "") for t in texts]
    found = []
    for i, text in enumerate(texts):
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or ""):
            t = m[0]
            if re.search("[0-9]", t) and re.search("[A-Za-z]", t) and not any(a < m.end() and m.start() < b for _, a, b in base[i]):
                name, p = secrets.battery(t)
                size = {"hex": 16, "base32": 32, "base36": 36, "base62": 62, "base64": 64}[name]
                logs = (secrets.text_evidence(t, size), -math.log(max(p, 1e-300)))
                # p-values are rounded up to bins of 0.25 in their logarithm
                found.append((i, m.start(), m.end(), sum(len(t) >= x for x in (24, 32, 48, 72)), *[math.exp(-0.25 * min(1600, math.floor(x / 0.25))) for x in logs]))
    out = [list(x) for x in base]
    for stratum in range(5):
        own = [x for x in found if x[3] == stratum]

        def rejected(column: int, level: float) -> float:
            ps = sorted(x[column] for x in own)  # noqa: B023
            return max((p for k, p in enumerate(ps, 1) if p <= level * sum(x <= p for x in ps) / len(ps)), default=-1.0)

        text, uniform = rejected(4, 0.01), rejected(5, 0.001)
        for i, a, b, _, p, q in own:
            if p <= text and q > uniform:
                out[i].append(("random", a, b))
    return [sorted(x, key=lambda y: (y[1], ("assign", "access", "hex", "random").index(y[0]))) for x in out]


def test_all_spans_equal_brute_force(spark):
    rng = random.Random(13)
    alphabets = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    texts = [*TEXTS, "x" * 300_000 + " " + "".join(rng.choices(alphabets[3], k=64))]
    for i in range(150):
        token = "".join(rng.choices(alphabets[i % 5], k=rng.randint(20, 90)))
        written = "-".join(invented(rng, 6).split()) + str(i)
        texts.append(f"see {token if i % 3 else written} and {written} there" + (" " + "ab1" * 12 if i % 10 == 0 else ""))
    texts += texts[30:40]
    got = secrets.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(7)).collect()
    want = brute_spans(texts)
    assert {r.doc_id: r.spans for r in got} == {i: ",".join(f"{k}:{a}:{b}" for k, a, b in x) for i, x in enumerate(want)}
    assert sum(r.n_random for r in got) > 60


def test_random_tokens_are_found_and_written_ones_not(spark):
    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(i, "see " + "".join(rng.choices(alphabet, k=40)) + " there") for i in range(40)]
    written = ["internationalization2024release", "configuration-file-version-12-backup", "aaaaaaaaaaaaaaaaaaaaaaaa1", "2024-01-01-meeting-notes-of-the-board", "1234567890123456789012345a"]
    rows += [(100 + i, t) for i, t in enumerate(written)]
    got = {r.doc_id: r.n_random for r in secrets.digests(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(got[i] for i in range(40)) >= 36
    assert not any(got[100 + i] for i in range(len(written)))


def test_redaction(spark):
    df = spark.createDataFrame([(1, f"a password=hunter22 {HEX}.", 5, "x"), (2, None, 7, "y"), (3, "clean", 5, "z")], "doc_id bigint, text string, n_chars bigint, q string")
    got = {r.doc_id: r for r in secrets.redacted(df).collect()}
    assert (got[1].text, got[1].n_chars) == ("a [assign] [hex].", 17)
    assert (got[2].text, got[2].n_chars, got[3].text) == (None, 7, "clean")
    assert secrets.redact_text("abcdef", [("assign", 1, 4), ("hex", 2, 5)]) == "a[assign]f"


def test_secrets_of_nothing(empty, extra):
    assert secrets.digests(empty).collect() == []
    assert secrets.redacted(extra).columns == extra.columns


ITEM = "Alice Smith buys 12 apples for 3 dollars each and then sells all of them to her friend Bob for 50 dollars at the market. How much does she gain?"
ITEM2 = "It was Alice Smith who, with 12 km to go, met Bob near the old mill and gave him 12 coins before the night fell on them all."


def found(spark, texts: dict, items: dict) -> set:
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, t) for i, t in items.items()], "item_id bigint, text string")
    return {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}


def test_copies_and_reparameterised_questions_are_caught(spark):
    rng = random.Random(9)
    fill = lambda: invented(rng, 60)
    changed = ITEM2.replace("Alice Smith", "Carol").replace("12", "700").replace("Bob", "Dave")
    broken = ITEM2.replace("12 km", "9 km")  # one value, two stand-ins: its windows with both slots disagree
    texts = {1: fill() + " " + ITEM + " " + fill(), 2: ITEM.upper(), 3: fill() + ". " + changed + " " + fill(), 4: fill(), 5: None, 6: "", 7: ITEM[: len(ITEM) // 8], 8: broken}
    got = found(spark, texts, {10: ITEM, 11: ITEM2, 12: None, 13: "too short"})
    assert {(1, 10), (2, 10), (3, 11)} <= got
    assert {d for d, _ in got} <= {1, 2, 3, 8}


def brute_template(text: str) -> list[tuple]:
    """(kind or word, value) by plain regular expressions."""
    raw = (text or "").encode()
    out: list[tuple] = []
    new = True
    for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+|[\n!.:;?]", raw):
        w = m[0]
        if re.fullmatch(rb"[\n!.:;?]", w):
            new = True
            continue
        low = re.sub(rb"\xc3[\x80-\x9e]", lambda x: bytes([0xC3, x[0][1] + 32]), re.sub(rb"[A-Z]", lambda x: x[0].lower(), w))
        capitals = len(re.findall(rb"[A-Z]|\xc3[\x80-\x9e]", w))
        if w[:1].isdigit():
            kind = "num"
        elif out and out[-1][2] and low.decode(errors="replace") in decontamination.UNITS:
            kind = "unit"
        elif not new and capitals == 1 and re.match(rb"[A-Z]|\xc3[\x80-\x9e]", w) and len(w) > 1:
            kind = "name"
        else:
            kind = None
        if kind and not new and out and out[-1][0] == (kind,):
            out[-1] = ((kind,), out[-1][1] + raw[out[-1][3] : m.end()], kind == "num", m.end())
        else:
            out.append(((kind,) if kind else low, w, kind == "num", m.end()))
        new = False
    return [(k, v.decode(errors="replace").lower()) for k, v, _, _ in out]


def brute_contaminated(text: str, item: str) -> bool:
    """Whether a text holds an item: all windows against all windows."""
    plain = lambda t: [(re.sub(rb"\xc3[\x80-\x9e]", lambda x: bytes([0xC3, x[0][1] + 32]), re.sub(rb"[A-Z]", lambda x: x[0].lower(), m[0])), "") for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+", (t or "").encode())]
    own, theirs = brute_template(text), brute_template(item)
    width = min(8, len(theirs))
    usable = [i for i in range(len(theirs) - width + 1) if width >= 4 and sum(isinstance(k, bytes) for k, _ in theirs[i : i + width]) >= min(4, width)]
    stands = not usable
    if stands:
        own, theirs = plain(text), plain(item)
        width = min(8, len(theirs))
        usable = range(len(theirs) - width + 1) if theirs else []
        if len(theirs) < 4 and len(own) != len(theirs):
            return False
    shifts: dict = {}
    for i in usable:
        for j in range(len(own) - width + 1):
            if all(a[0] == b[0] for a, b in zip(theirs[i : i + width], own[j : j + width], strict=True)):
                shifts.setdefault(j - i, []).append(i)
    for shift, starts in shifts.items():
        stand: dict = {}
        covered: set = set()
        for i in sorted(starts):
            both = {(theirs[k][1], own[k + shift][1]) for k in range(i, i + width) if not isinstance(theirs[k][0], bytes)}
            if any(stand.get(x, y) != y for x, y in both) or len(dict(both)) != len(both):
                continue
            stand.update(both)
            covered.update(range(i, i + width))
        run = longest = 0
        for k in range(len(theirs)):
            run = run + 1 if k in covered else 0
            longest = max(longest, run)
        if (len(covered) == len(theirs)) if stands else (100 * len(covered) >= 50 * len(theirs) or longest >= 13):
            return True
    return False


def test_contaminated_pairs_equal_brute_force(spark):
    rng = random.Random(21)
    names, units = ["Anna", "Bob", "Émile", "Carol Jones"], ["km", "dollars", "hours"]

    def question(kind: int) -> str:
        n = lambda: str(rng.randrange(500))
        return (
            f"How many {rng.choice(units)} does {rng.choice(names)} need if a trip of {n()} {rng.choice(units)} takes {n()} hours and {rng.choice(names)} starts {n()} km later than planned?",
            f"What is {n()} + {n()} * {n()} - {n()}?", f"Solve {n()}x + {n()} = {n()} now", f"Compute {n()}.", " ".join(invented(rng, 6).split()), f"{invented(rng, 30)}",
        )[kind]

    items = [question(i % 6) for i in range(24)] + ["", None]
    items += items[:3]
    texts: list = [None, "", " ", "7", *items[:12]]
    for i in range(70):
        held = items[i % 24]
        if i % 4 == 1:
            held = re.sub("[0-9]+", lambda _: str(rng.randrange(900)), held)
        elif i % 4 == 2:
            held = held[: len(held) * 2 // 3]
        texts.append(f"{invented(rng, rng.randint(0, 40))} {held}{rng.choice(['. ', ' ', chr(10)])}{invented(rng, rng.randint(0, 30))}")
    texts += ["filler words " * 30_000 + items[0], texts[20], texts[20]]
    got = found(spark, dict(enumerate(texts)), dict(enumerate(items)))
    want = {(i, j) for i, t in enumerate(texts) for j, x in enumerate(items) if x and brute_contaminated(t, x)}
    assert got == want and len(want) > 60


def test_decontamination_tells_rows_of_one_id_apart(spark, extra):
    docs = spark.createDataFrame([(1, ITEM), (1, "clean text"), (None, ITEM), (None, "other clean text"), (None, ITEM)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id bigint, text string")
    assert sorted(r.text for r in decontamination.clean(docs, bench).collect()) == ["clean text", "other clean text"]
    assert decontamination.contaminated(docs, bench).count() == 2 and decontamination.contaminated(extra, bench).count() == 0


def test_rules_take_long_texts_and_clashing_columns(spark, docs, extra):
    assert sorted(map(str, quality_rules.judge(extra).collect())) == sorted(map(str, quality_rules.judge(docs).collect()))
    assert sorted(map(str, secrets.digests(extra).collect())) == sorted(map(str, secrets.digests(docs).collect()))
    long = " ".join(f"w{i % 7001}" for i in range(80_000)) + "\n%\n%"
    row = quality_rules.judge(spark.createDataFrame([(1, long, "en", "s", 1)], SCHEMA)).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == brute_quality(long)


def test_template_types():
    text = b"Then Alice Smith ran 12 km. The end, \xc3\x89mile won 3 times."
    h, a, b = decontamination.template(np.frombuffer(text, np.uint8))
    kinds = [{1: "num", 2: "name", 3: "unit"}.get(int(x), text[i:j].decode().lower()) for x, i, j in zip(h, a, b, strict=True)]
    assert kinds == ["then", "name", "ran", "num", "unit", "the", "end", "name", "won", "num", "times"]


def test_short_items_and_repeats(spark):
    assert found(spark, {1: "well the quick brown fox then", 2: "nothing"}, {5: "the quick brown fox"}) == {(1, 5)}
    assert found(spark, {}, {5: ITEM}) == set() and found(spark, {1: ITEM}, {}) == set()


def test_items_without_a_window_match_as_they_stand(spark):
    numbers = "Compute 1 + 2, 3 + 4, 5 + 6, 7 + 8 and 9 + 10 now"
    texts = {1: "So: what is 12 + 45? I know", 2: "what is 12 + 46?", 3: f"x {numbers} y", 4: numbers.replace("10", "11"), 5: "one two", 6: "one two three"}
    assert found(spark, texts, {20: "What is 12 + 45?", 21: numbers, 22: "One, two!"}) == {(1, 20), (3, 21), (5, 22)}


def test_clean_keeps_other_rows_and_columns(spark, extra):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert sorted(map(str, decontamination.clean(extra, bench).collect())) == sorted(map(str, extra.collect()))


@pytest.mark.parametrize("pairs", [[(0, 0, 8, ["5"], ["5"]), (1, 1, 8, ["5"], ["5"])], [(3, 0, 8, ["7"], ["5"]), (4, 1, 8, ["7"], ["5"])]])
def test_lines_of_consistent_slots(pairs):
    assert decontamination.lines(pairs) == (9, 9, 2)


def test_lines_drop_inconsistent_slots():
    assert decontamination.lines([(0, 0, 8, ["7"], ["5"]), (1, 1, 8, ["8"], ["5"])]) == (8, 8, 1)


def test_tasks_give_back_their_memory(spark):
    """A Python worker that has held a large text is as small afterwards as before."""
    from strandloom.llm import common

    def sized(sizes):
        import builtins

        import numpy as np

        held = [np.ones(12_000) for _ in range(6_000)]
        builtins.kept_by_the_test = held[-1]  # the end of the heap stays in use
        return {"n": sizes}

    def resident(sizes):
        pages = int(open("/proc/self/statm").read().split()[1])
        return {"n": [pages * 4096 // 1_000_000] * len(sizes)}

    one = spark.range(1).coalesce(1).selectExpr("id + 1 as n")
    common.arrow_map(one, sized, "n long").collect()
    assert common.arrow_map(one, resident, "n long").collect()[0].n < 400
