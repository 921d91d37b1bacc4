"""Secret scans: pattern rules, and a battery of randomness tests over token-like strings.

Rules find assignments, access keys and long hex strings. Every other run of 20 or more token characters that holds a
letter and a digit is a candidate: its encoding is inferred (hex, base32, base36, base62, base64), and against a
uniform draw from that alphabet it takes a chi-squared test of uniformity, a runs test (letters against digits) and a
serial-correlation test, whose least p-value, times three, is the battery's. A second p-value holds it against written
text: the likelihood ratio of text to uniform alphabet, valid by Markov's inequality, falls exponentially with length.
Benjamini-Hochberg runs over both p-values of all candidates of a length class in the whole corpus: a candidate counts if
it is among those that are not written text (level q) and not among those that are no uniform draw (`level`).

Null and empty texts hold no secret; whole texts are searched, however long. Repeated rows each get their own result and
count as often in the control. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, map_batches, stored

#: The rules. A match that is too short is dropped after matching.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
MIN_GROUP, MIN_ACCESS, MIN_HEX, MIN_TOKEN = 6, 20, 24, 20
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ENCODINGS = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 16),
    ("base32", re.compile(r"[A-Z2-7]+=*"), 32),
    ("base36", re.compile(r"[a-z0-9]+|[A-Z0-9]+"), 36),
    ("base62", re.compile(r"[A-Za-z0-9]+"), 62),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 64),
)
#: Letters of written text from frequent to rare, and their share in percent.
LETTERS, SHARES = "etaoinshrdlcumwfgypbvkjxqz", (12.7, 9.1, 8.2, 7.5, 7.0, 6.7, 6.3, 6.1, 6.0, 4.3, 4.0, 2.8, 2.8, 2.4, 2.4, 2.2, 2.0, 2.0, 1.9, 1.5, 1.0, 0.8, 0.15, 0.15, 0.1, 0.07)
_TEXT = {c: math.log(0.97 * s / 100) for c, s in zip(LETTERS, SHARES, strict=True)}
_SAME, _OTHER = math.log(0.92), math.log(0.04)  # written text stays within lower case, upper case, digits or signs
_DIGIT, _SIGN = math.log(0.1), math.log(0.25)
STRATA = (24, 32, 48, 72)
#: Bins of -ln p, 0.25 wide, up to 400: bounds what the false-discovery control gathers.
BIN, BINS = 0.25, 1600

_IS_HEX, _IS_TOKEN = bytearray(256), bytearray(256)
for _c in b"0123456789abcdef":
    _IS_HEX[_c] = 120
for _c in b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-":
    _IS_TOKEN[_c] = 120
_IS_HEX, _IS_TOKEN = bytes(_IS_HEX), bytes(_IS_TOKEN)


def base_spans(text: str, raw: bytes | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the rules, in code points; the byte tests only skip texts that cannot match."""
    raw = text.encode() if raw is None else raw
    found = []
    lower = raw.lower()
    if any(k in lower for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_GROUP]
    if b"AKIA" in raw:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if b"x" * MIN_HEX in raw.translate(_IS_HEX):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def chi_squared_p(x: float, freedom: int) -> float:
    """Upper tail by the Wilson-Hilferty cube root."""
    if x <= 0:
        return 1.0
    z = ((x / freedom) ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom))
    return 0.5 * math.erfc(z / math.sqrt(2))


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str) -> tuple[str, float]:
    """The inferred encoding and the smallest of the three p-values, times three: how badly a uniform draw is contradicted."""
    body = token.rstrip("=")
    name, _, size = next((e for e in ENCODINGS if e[1].fullmatch(token)), ENCODINGS[-1])
    n = len(body)
    if n < 8:
        return name, 0.0
    codes = np.frombuffer(body.encode(), np.uint8).astype(np.int64)
    counts = np.bincount(codes)
    chi = float((counts.astype(float) ** 2).sum() * size / n - n)
    p_uniform = chi_squared_p(chi, size - 1)
    digits = (codes >= 48) & (codes <= 57)
    share = 10 / size
    runs = 1 + int((digits[1:] != digits[:-1]).sum())
    expected = 1 + 2 * (n - 1) * share * (1 - share)
    spread = math.sqrt(max(1e-9, (n - 1) * 2 * share * (1 - share) * (1 - 2 * share * (1 - share))))
    p_runs = two_sided((runs - expected) / spread)
    _, ranks = np.unique(codes, return_inverse=True)
    a, b = ranks[:-1] - ranks.mean(), ranks[1:] - ranks.mean()
    scale = float(((ranks - ranks.mean()) ** 2).sum())
    p_serial = two_sided((float((a * b).sum()) / scale) * math.sqrt(n)) if scale else 0.0
    return name, min(1.0, 3 * min(p_uniform, p_runs, p_serial))


def text_evidence(token: str, size: int) -> float:
    """-ln of the p-value under written text: how much likelier a uniform draw makes the token."""
    last, total = "", 0.0
    for c in token:
        kind = "l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "s"
        if last:
            total += _SAME if kind == last else _OTHER
        total += _TEXT[c.lower()] if kind in "lu" else _DIGIT if kind == "d" else _SIGN
        last = kind
    return max(0.0, -len(token) * math.log(size) - total)


def candidates(text: str, raw: bytes, base: list[tuple[str, int, int]]) -> list[tuple[int, int, float, float]]:
    """(start, end, -ln p against written text, -ln p of the battery) of the tokens outside base spans."""
    if b"x" * MIN_TOKEN not in raw.translate(_IS_TOKEN):
        return []
    found = []
    for m in TOKEN.finditer(text):
        token = m[0]
        if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)) or any(a < m.end() and m.start() < b for _, a, b in base):
            continue
        name, p = battery(token)
        found.append((m.start(), m.end(), text_evidence(token, next(s for k, _, s in ENCODINGS if k == name)), -math.log(max(p, 1e-300))))
    return found


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and candidates of each whole text."""

    def run(ids, texts):
        out: dict = {"doc_id": ids, "base": [], "found": []}
        for text in texts:
            raw = (text or "").encode()
            base = base_spans(text or "", raw)
            out["base"].append([{"kind": k, "start": a, "end": b} for k, a, b in base])
            out["found"].append([{"start": a, "end": b, "evidence": e, "against": x} for a, b, e, x in candidates(text or "", raw, base)])
        return out

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, base array<struct<kind:string,start:int,end:int>>, found array<struct<start:int,end:int,evidence:double,against:double>>")


def _stratum(length):
    out = F.lit(0)
    for i, least in enumerate(STRATA):
        out = F.when(length >= least, F.lit(i + 1)).otherwise(out)
    return out


def limits(scan: DataFrame, q: float = 0.01, level: float = 0.001) -> DataFrame:
    """Benjamini-Hochberg over all candidates, for each length class and p-value (column): the least -ln p that is rejected. At most two rows a class."""
    each = scan.select(F.explode("found").alias("c")).select(_stratum(F.col("c.end") - F.col("c.start")).alias("stratum"), F.explode(F.create_map(F.lit("evidence"), F.col("c.evidence"), F.lit("against"), F.col("c.against"))).alias("column", "x"))
    binned = each.groupBy("stratum", "column", F.least(F.floor(F.col("x") / BIN), F.lit(BINS)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    key = W.partitionBy("stratum", "column")
    ranked = binned.select("stratum", "column", "bin", F.sum("n").over(key.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)).alias("k"), F.sum("n").over(key).alias("m"))
    alpha = F.when(F.col("column") == "evidence", F.lit(q)).otherwise(F.lit(level))
    passing = ranked.filter(F.exp(-F.col("bin") * BIN) <= alpha * F.col("k") / F.col("m"))
    return passing.groupBy("stratum", "column").agg((F.min("bin") * BIN).alias("least"))


def least_evidence(scan: DataFrame, q: float, level: float) -> dict[str, list[float]]:
    """limits() as lists by length class; infinite where nothing is rejected."""
    least = {c: [float("inf")] * (len(STRATA) + 1) for c in ("evidence", "against")}
    for row in limits(scan, q, level).collect():  # two rows a length class
        least[row.column][row.stratum] = row.least
    return least


def scan(docs: DataFrame, *, q: float = 0.01, level: float = 0.001) -> DataFrame:
    """doc_id, base and random: arrays of spans. Candidates are held once, in the shared folder, for the control over the whole corpus."""
    found = stored(scanned(docs), "secrets")
    least = {c: F.array(*[F.lit(x) for x in v]) for c, v in least_evidence(found, q, level).items()}
    limit = lambda c, name: F.get(least[name], _stratum(c["end"] - c["start"]))
    chosen = F.filter("found", lambda c: (c["evidence"] >= limit(c, "evidence")) & (c["against"] < limit(c, "against")))
    return found.select("doc_id", "base", F.transform(chosen, lambda c: F.struct(F.lit("random").alias("kind"), c["start"].alias("start"), c["end"].alias("end"))).alias("random"))


def digest(base: list, extra: list) -> dict:
    """The digest columns of one document."""
    base = [(x["kind"], x["start"], x["end"]) for x in base or []]
    extra = [(x["kind"], x["start"], x["end"]) for x in extra or []]
    return {
        "n_assign": sum(k == "assign" for k, _, _ in base), "n_access": sum(k == "access" for k, _, _ in base), "n_hex": sum(k == "hex" for k, _, _ in base),
        "base_sha256": hashlib.sha256(as_text(base).encode()).hexdigest(), "spans": as_text(in_order(base + extra)), "n_random": len(extra),
    }


def digests(docs: DataFrame) -> DataFrame:
    def run(ids, base, extra):
        rows = [digest(b, e) for b, e in zip(base, extra, strict=True)]
        return {"doc_id": ids} | {k: [r[k] for r in rows] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")}

    return arrow_map(scan(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by a placeholder; overlapping spans become one, named for the first."""
    out, at = [], 0
    for kind, a, b in in_order(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, *, q: float = 0.01, level: float = 0.001) -> DataFrame:
    """docs with every span of text replaced by its placeholder and n_chars, if there, brought up to date; null texts stay null."""
    least = least_evidence(stored(scanned(docs), "secrets"), q, level)
    names = docs.columns

    def spans(text: str) -> list[tuple[str, int, int]]:
        raw = text.encode()
        base = base_spans(text, raw)
        extra = []
        for a, b, e, x in candidates(text, raw, base):
            i = sum(b - a >= s for s in STRATA)
            if e >= least["evidence"][i] and x < least["against"][i]:
                extra.append(("random", a, b))
        return in_order(base + extra)

    def run(batches):
        for batch in batches:
            texts = [redact_text(t, spans(t)) if t else t for t in batch.column(names.index("text")).to_pylist()]
            columns = list(batch.columns)
            at = names.index("text")
            columns[at] = pa.array(texts, columns[at].type)
            if "n_chars" in names:
                at = names.index("n_chars")
                columns[at] = pa.array([n if t is None else len(t) for t, n in zip(texts, columns[at].to_pylist(), strict=True)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, run, docs.schema)
