"""Personal data by candidate spans and boosted trees.

Generators propose spans, generously and overlapping: whatever the base patterns match, numbers in groups, values
assigned to a credential's name, long mixed tokens, addresses written with words. Trees learn from format and context
what marks private spans. Their training labels are the candidates that carry their own proof: a checksum or a strict
format for, a failed one or plain words and numbers against; candidates without proof take no part. An isotonic curve on
a third of the sample turns tree scores into probabilities, and the threshold is the least one of the wanted precision.
Base spans stay whatever the trees say; where others overlap, the likelier one is taken.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.llm.boosting import Trees, calibrated, probability

SAMPLE_DOCUMENTS = 20_000  # of all documents, for the trees only
SAMPLE_CANDIDATES = 50_000
PRECISION = 0.98
CONTEXT = 24

# The base patterns, such that a long run of characters is read once. An e-mail address is found from its
# sign; an address that fails at the start of a run of digits fails at all of its digits.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number", "handle")

DIGIT = re.compile(r"[0-9]")
DIGITS = re.compile(r"[^0-9]")
ASSIGNED = re.compile(r"(?i)\b(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_ -]?key|access[_ -]?key|auth|credential)\b[\"']?\s*[:=]\s*[\"']?([^\s\"',;]{6,})")
TOKEN = re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])[A-Za-z0-9_/+-]{16,}(?![A-Za-z0-9_/+-])")
ACCESS_KEY = re.compile(r"AKIA[0-9A-Z]{16}")
GROUPED = re.compile(r"(?<![0-9A-Za-z.])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){1,4}(?![0-9A-Za-z])")
SPELLED = re.compile(r"(?i)\b[a-z0-9._%+-]+\s?(?:\(at\)|\[at\])\s?[a-z0-9-]+(?:\s?(?:\(dot\)|\[dot\]|\.)\s?[a-z0-9-]+)+")
AT_WORD = re.compile(r"(?i)\(at\)|\[at\]")
DATE = re.compile(r"(?:(?:19|20)[0-9]{2}[.-][01]?[0-9][.-][0-3]?[0-9]|[0-3]?[0-9][.-][0-3]?[0-9][.-](?:19|20)[0-9]{2})")
ONE_WORD = re.compile(r"[A-Za-z]?[a-z]+[.!?]?")
PLAIN = re.compile(r"\b(?:[A-Za-z]+ ){0,2}[0-9]+(?:\.[0-9]+)?\b")
CUE = re.compile(r"(?i)(?:pass|pwd|secret|token|key|auth|mail|phone|tel|mobile|call|fax|card|visa|ssn|iban|account|address|ip)\W*$")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _holds(kind: str, said: str) -> bool:
    """The base rule beyond the pattern."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in said.split("."))
    digits = DIGITS.sub("", said)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`.

    Each sign is looked at once: the name before it reaches back as far as its characters do, though not into the
    match before. A name without a domain behind its sign is none, wherever it begins.
    """
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = max(done, sign + 1)  # no later name reaches back over this sign
        sign = text.find("@", done)


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether the base rule holds) of the leftmost non-overlapping matches of each kind."""
    for start, end in email_spans(text):
        yield "email", start, end, True
    some = DIGIT.search(text) is not None
    for kind, pattern, may in (("ip", IP, some), ("card", CARD, some), ("phone", PHONE, some and "+" in text)):
        if may:
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end(), _holds(kind, m[0])


def candidates(text: str) -> Iterator[tuple[str, int, int, int | None]]:
    """(kind, start, end, proof) beside the base spans; proof is 1, 0, or None where the span has none of its own.

    Proofs are labels to learn from; the trees decide on every candidate.
    """
    some = DIGIT.search(text) is not None
    for kind, start, end, holds in base_matches(text):
        if not holds:  # digits in groups that are no card may be a number of another kind
            said = text[start:end]
            open_ = kind != "ip" and len(DIGITS.sub("", said)) < 13 and GROUPED.fullmatch(said) and not DATE.fullmatch(said)
            yield ("number", start, end, None) if open_ else (kind, start, end, 0)
    if some or "=" in text or ":" in text:
        for m in ASSIGNED.finditer(text):
            high = entropy(m[1]) > 2.5
            yield "secret", m.start(1), m.end(1), 1 if high and DIGIT.search(m[1]) else 0 if not high or ONE_WORD.fullmatch(m[1]) else None
    if some:
        for m in TOKEN.finditer(text):
            yield "secret", m.start(), m.end(), 1 if ACCESS_KEY.fullmatch(m[0]) else None
        for m in GROUPED.finditer(text):
            yield "number", m.start(), m.end(), 0 if DATE.fullmatch(m[0]) else None
        for m in PLAIN.finditer(text):
            yield "number", m.start(), m.end(), 0
    if "at" in text:
        for m in SPELLED.finditer(text) if AT_WORD.search(text) else ():
            yield "handle", m.start(), m.end(), None


def variants(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(new text, kind, start, end): proven values of the text in the forms that have no proof of their own.

    A proven phone number in groups without its plus sign is a number, a proven e-mail address spelled out a handle, a
    proven credential with letters for its digits still a secret.
    """
    for kind, a, b, holds in base_matches(text):
        if holds and kind == "phone":
            groups = re.findall(r"[0-9]+", text[a:b])
            digits = "".join(groups)
            kept = [g for g in groups if 2 <= len(g) <= 4][-4:]
            forms = [kept] if len(kept) > 1 and sum(map(len, kept)) >= 7 else []
            forms.append([digits[-10:-7], digits[-7:-4], digits[-4:]] if len(digits) >= 10 else [digits[-7:-4], digits[-4:]])
            sign = "-. "[len(digits) % 3]
            for form in forms:
                said = sign.join(form)
                yield text[:a] + said + text[b:], "number", a, a + len(said)
        elif holds and kind == "email":
            name, _, place = text[a:b].partition("@")
            for at, dot in ((" (at) ", " (dot) "), ("[at]", ".")):
                said = name + at + place.replace(".", dot)
                yield text[:a] + said + text[b:], "handle", a, a + len(said)
    for m in ASSIGNED.finditer(text):
        if entropy(m[1]) > 2.5 and DIGIT.search(m[1]):
            letters = DIGIT.sub(lambda d: "abcdefghij"[int(d[0])], m[1])
            step = 5 + len(letters) % 4
            said = "-".join(letters[k : k + step] for k in range(0, len(letters), step))
            for form in (letters, said, said[:24].lower().rstrip("-")):
                yield text[: m.start(1)] + form + text[m.end(1) :], "secret", m.start(1), m.start(1) + len(form)


def entropy(said: str) -> float:
    n = len(said)
    return -sum(c / n * log2(c / n) for c in Counter(said).values()) if n else 0.0


def features(text: str, start: int, end: int) -> list[float]:
    said, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + 1]
    n = len(said)
    digits = sum(c.isdigit() for c in said)
    upper, letters = sum(c.isupper() for c in said), sum(c.isalpha() for c in said)
    runs = max((len(r) for r in re.findall(r"[0-9]+", said)), default=0)
    return [
        float(n), digits / n, letters / n, upper / n, (n - digits - letters) / n, entropy(said), float(digits), float(runs),
        float("@" in said), float(said.count(".")), float(said[0] == "+"), float(bool(CUE.search(before))), float(before[-1:] in "\"'="),
        float(bool(before) and before[-1].isalnum()), float(after.isalnum()), float(bool(re.fullmatch(r"[0-9a-fA-F]+", said))),
        float(16 <= digits <= 19 and luhn(DIGITS.sub("", said))), len(set(said)) / n, float(said.count(" ")),
    ]


N_FEATURES = 19


class Model:
    """Trees, their calibration and the threshold; `least` above 1 adds no span."""

    def __init__(self, trees: Trees | None, curve, least: float):
        self.trees, self.curve, self.least = trees, curve, least

    def likely(self, rows: list[list[float]]) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(rows))
        return probability(self.trees.raw(np.array(rows)), self.curve)


def find_spans(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each in the order of kinds, then of starts."""
    base = [(k, a, b) for k, a, b, holds in base_matches(text) if holds]
    taken = [(a, b) for _, a, b in base]
    added = []
    offered = list(dict.fromkeys((k, a, b) for k, a, b, _ in candidates(text)))
    if offered and model.trees is not None:
        chances = model.likely([features(text, a, b) for _, a, b in offered])
        for k in sorted(range(len(offered)), key=lambda k: (-chances[k], offered[k][1])):
            kind, a, b = offered[k]
            if chances[k] >= model.least and not any(a < d and c < b for c, d in taken):
                taken.append((a, b))
                added.append((kind, a, b))
    order = lambda s: (KINDS.index(s[0]), s[1])
    return base, sorted([*base, *added], key=order)


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, proofs = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            offered = [(k, a, b, 1) for k, a, b, holds in base_matches(text) if holds]
            proven = [(a, b) for _, a, b, _ in offered]
            for k, (_, a, b, proof) in enumerate([*offered, *candidates(text)]):
                # a part of a proven span says nothing against its like
                if proof is not None and not (k >= len(proven) and proof == 0 and any(a < d and c < b for c, d in proven)):
                    rows.append(features(text, a, b))
                    proofs.append(proof)
            for new, _, a, b in variants(text):
                rows.append(features(new, a, b))
                proofs.append(1)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(proofs, pa.int32())], ["x", "y"])


def fit(docs: DataFrame) -> Model:
    """Trees fitted on the proven candidates of at most about `SAMPLE_DOCUMENTS` documents, taken by a hash of their id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    step = max(1, round(docs.select("doc_id").count() / SAMPLE_DOCUMENTS))
    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("text")
    rows = sample.mapInArrow(_training, "x array<double>, y int")
    rows = rows.orderBy(F.xxhash64("x"), "x", "y").limit(SAMPLE_CANDIDATES).collect()
    x, y = np.array([r["x"] for r in rows]).reshape(-1, N_FEATURES), np.array([float(r["y"]) for r in rows])
    aside = np.arange(len(y)) % 3 == 0
    if len(y) < 10 or len(set(y[~aside])) < 2 or len(set(y[aside])) < 2:
        return Model(None, None, 2.0)
    trees = Trees().fit(x[~aside], y[~aside])
    curve = calibrated(trees.raw(x[aside]), y[aside])
    chances = probability(trees.raw(x[aside]), curve)
    for least in np.unique(chances):
        if y[aside][chances >= least].mean() >= PRECISION:
            return Model(trees, curve, float(max(least, 0.5)))
    return Model(None, None, 2.0)


def _scan(model: Model, redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6 + redact)]
            for text in batch.column("text").to_pylist():
                text = text or ""
                base, spans = find_spans(text, model)
                counts = Counter(k for k, _, _ in base)
                row = [*(counts[k] for k in BASE), hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)]
                if redact:
                    row.append(redacted(text, spans))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [*[pa.int64()] * 4, *[pa.string()] * (2 + redact)]
            columns = [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]]
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", *["redacted"] * redact]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first starting one names the place."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def find_personal_data(docs: DataFrame, redact: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (and redacted, if asked for).

    `docs` holds doc_id and text; more columns are ignored. Offsets are code points, ends exclusive. NULL and empty texts
    have no spans (the hash is that of ''). Rows that repeat a doc_id, or have none, each get a row. With too few proven
    candidates to learn from, only base spans are found. Empty input gives no rows.
    """
    model = fit(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return texts.mapInArrow(_scan(model, redact), schema + ", redacted string" * redact)
