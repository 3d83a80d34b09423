"""Chunks of phrases: short rows, suffixes equal to a plain count wherever chunks and rows are cut, no dictionary kept."""

from __future__ import annotations

import collections
import gc
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugewise.llm import phrases

RARE = {b"w3", b"w8"}


def texts(seed, rows):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)]
    return [(rng.choice(["en", "fr", "de"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". "]) for _ in range(rng.randint(0, 40)))) for _ in range(rows)]


def batches(rows, size):
    for start in range(0, len(rows), size):
        langs, some = zip(*rows[start : start + size], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(some, pa.string())], ["lang", "text"])


@pytest.fixture
def task(monkeypatch):
    monkeypatch.setattr(phrases, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))


def plain(rows, number):
    """Suffixes of four words up to the next end or rare word."""
    out = collections.Counter()
    for lang, text in rows:
        for piece in text.split("."):
            words = [0 if w.encode() in RARE else number[lang, w.encode()] for w in piece.split()] + [0] * 4
            for k in range(len(words) - 4):
                if words[k]:
                    four = words[k : k + 4]
                    out[tuple(four[: four.index(0)] if 0 in four else four)] += 1
    return out


@pytest.mark.parametrize("chunk, pending, row, size", [(1 << 19, 1 << 21, 512, 70), (50, 1 << 20, 7, 70), (9, 200, 1, 5), (400, 90, 64, 64), (33, 60, 4, 1)])
def test_suffixes_are_whole_wherever_rows_are_cut(monkeypatch, task, chunk, pending, row, size):
    for name, value in (("CHUNK_WORDS", chunk), ("PENDING_WORDS", pending), ("ROW_WORDS", row), ("TEXTS", 3)):
        monkeypatch.setattr(phrases, name, value)
    rows = [*texts(chunk, 150), ("en", ""), ("en", None), ("fr", "w3 w8. w3")]
    made = [r for b in phrases._chunks(batches(rows, size)) for r in b.to_pylist()]
    words = collections.Counter()
    for r in made:
        if r["word"] is not None:
            words[r["lang"], r["word"].encode()] += r["n"]
    assert +words == collections.Counter((lang, w.encode()) for lang, t in rows for w in (t or "").replace(".", " ").split())
    number = {k: n for n, k in enumerate(sorted(words), 1)}
    known = [(2 * r["chunk"], r["at"], number[r["lang"], r["word"].encode()], []) for r in made if r["word"] is not None and r["word"].encode() not in RARE]
    places = [(2 * r["chunk"] + 1, 0, r["n"], r["ids"]) for r in made if r["word"] is None]
    assert max(len(p[3]) for p in places) <= row + phrases.DEPTH - 1
    columns = zip(sorted(known + places, key=lambda r: r[0]), strict=True)
    columns = list(zip(*(r[0] for r in columns), strict=True))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
    table = pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "at", "n", "ids"])
    found = collections.Counter()
    for b in phrases._suffixes(phrases._renumbered(table.to_batches(max_chunksize=size))):
        for high, low, n in zip(*(b.column(c).to_pylist() for c in ("high", "low", "n")), strict=True):
            found[tuple(x for x in (high >> 32, high & 0xFFFFFFFF, low >> 32, low & 0xFFFFFFFF) if x)] += n
    assert found == plain([(lang, t or "") for lang, t in rows], number)


def test_no_dictionary_is_kept(monkeypatch, task):
    """Without a search for cycles, which may not come while a task runs."""
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 50)
    monkeypatch.setattr(phrases, "PENDING_WORDS", 100)
    gc.collect()
    gc.disable()
    try:
        assert sum(b.num_rows for b in phrases._chunks(batches(texts(1, 150), 40)))
        held = [x for x in gc.get_objects() if isinstance(x, collections.defaultdict) and phrases.STOP in x]
    finally:
        gc.enable()
    assert not held


def test_stored_rows_are_short(spark, monkeypatch):
    """Spark's readers hold thousands of rows at once, so a text of any length must be many rows."""
    kept = []
    stored = phrases.stored
    monkeypatch.setattr(phrases, "stored", lambda df, label: kept.append(stored(df, label)) or kept[-1])
    text = " ".join(f"w{k % 40}" for k in range(20_000))
    counts, _, _ = phrases.phrase_counts(spark.createDataFrame([("en", text)], "lang string, text string"))
    assert counts.filter(F.size("phrase") == 4).agg(F.sum("f")).first()[0] == 20_000 - 3
    for df in kept:
        for name, kind in df.dtypes:
            if kind.startswith("array"):
                assert df.agg(F.max(F.size(name))).first()[0] <= phrases.ROW_WORDS + phrases.DEPTH


def test_copies_of_few_suffixes_are_folded(monkeypatch):
    """Many times SUFFIXES rows of few suffixes, and of ever new ones."""
    monkeypatch.setattr(phrases, "SUFFIXES", 10)
    rng = np.random.default_rng(5)
    high, n = rng.integers(1, 60, 5000) << 32 | rng.integers(1, 3, 5000), rng.integers(1, 4, 5000)
    some = [pa.RecordBatch.from_arrays([pa.array(x[a : a + 7]) for x in (high, np.zeros(5000, np.int64), n)], ["high", "low", "n"]) for a in range(0, 5000, 7)]
    want = collections.Counter()
    for h, m in zip(high.tolist(), n.tolist(), strict=True):
        want[h >> 32 << 32] += m
        want[h] += m
    got = {}
    for b in phrases._sorted_sizes(1)(iter(some)):
        got |= dict(zip(b.column("high").to_pylist(), b.column("f").to_pylist(), strict=True))
    assert got == dict(want)
