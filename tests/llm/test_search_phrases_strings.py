"""Lexical search, phrases and repeated strings against brute force, over awkward rows and empty tables."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from checks.compare import compare, connect
from gaugewise.llm import lexical_search, phrases, repeated_strings
from gaugewise.llm.lexical_search import ranked_search, term_counts
from gaugewise.llm.phrases import collocations, phrase_sizes
from gaugewise.llm.queries import ORACLES, QUERIES
from gaugewise.llm.repeated_strings import repeated_starts, suffix_order, without_repeated_strings
from gaugewise.llm.shipping import ship_package
from tests.llm.fixtures import LOW, documents, frame, prose

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return frame(spark)


def multiset(rows):
    return collections.Counter(map(repr, rows))


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_collocations"])
def test_sql(spark, name):
    ok, note = compare(spark, connect(SMALL), QUERIES[name], ORACLES[name], SMALL)
    assert ok, note


# lexical search


def search(rows, items, k):
    held = [(i, collections.Counter(TERM.findall((t or "").translate(LOW)))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 10 + 90 * c.total() * n_docs // total
            score = 0
            for t in set(TERM.findall((text or "").translate(LOW))) & c.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, missing, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if missing else i, -score))
    return out


ITEMS = [(1, "THE anthe or; in"), (2, None), (3, ""), (4, "zzz qqq"), (5, "changed same row here"), (6, "é the-the ors"), (None, "one two words")]


@pytest.mark.parametrize("block, cells", [(lexical_search.BLOCK_BYTES, lexical_search.CELLS), (64, 40)])
def test_search_matches_brute_force(spark, docs, monkeypatch, block, cells):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id int, text string, doc_id string")
    got = ranked_search(docs.repartition(7), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert multiset(map(tuple, got.collect())) == multiset(search([r[:2] for r in documents()], ITEMS, 10))


def test_search_ties_and_repeats(spark):
    rows = [(k % 30, "alpha beta gamma") for k in range(90)] + [(None, "alpha beta gamma"), (500, "delta " * 5)]
    items = spark.createDataFrame([("a", "alpha"), ("a", "beta alpha"), ("b", "delta")], "item_id string, text string")
    got = ranked_search(spark.createDataFrame(rows, "doc_id long, text string"), items, k=4)
    assert multiset(map(tuple, got.collect())) == multiset(search(rows, [("a", "alpha beta"), ("b", "delta")], 4))


def test_search_empty(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert ranked_search(docs.limit(0), items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0
    assert [f.dataType.simpleString() for f in ranked_search(docs, items.limit(0)).schema] == ["int", "int", "bigint", "bigint"]


def test_long_text_is_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE", 7)
    text = "One two, ONE\tthree-two " * 50 + "é" * 40
    assert term_counts(text.encode()) == collections.Counter(t.encode() for t in TERM.findall(text.translate(LOW)))


# phrases


def top_phrases(rows, least, top, share=80):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOW)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k : k + size])] += 1
    often = {p: a for p, a in f.items() if a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in often.items():
        if len(p) == 1:
            continue
        cuts = [(2_000_000 * a // (often[lang, p[:k]] + often[lang, p[k:]]), k, often[lang, p[:k]], often[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        around = [b for (g, q), b in often.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * b >= share * a for b in around):
            out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return [
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    ]


def texts(seed):
    rng = random.Random(seed)
    words = ["aa", "Bb", "cc", "d", "é", "ff", "rare"]
    rows = []
    for k in range(120):
        text = "".join(rng.choices(words, [9, 5, 5, 3, 3, 1, 0.1])[0] + rng.choices([" ", "\t ", ", ", ".\n", "\r"], [9, 1, 1, 1, 0.3])[0] for _ in range(rng.randint(0, 60)))
        rows.append((k, rng.choice(["en", "fr", None, ""]), text + (" hot pair here" if k % 3 else "")))
    return rows + [(1, "en", None), (1, "en", ""), (None, None, "hot pair " * 400)]


@pytest.mark.parametrize("chunk, least, top", [(1 << 18, 8, 2000), (50, 8, 2000), (9, 5, 11)])
def test_phrases_match_brute_force(spark, monkeypatch, chunk, least, top):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(phrases, "PENDING_WORDS", chunk)
    rows = texts(4)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, lang string, text string, word string, phrase int")
    got = collocations(df.repartition(5), least, top)
    assert multiset(map(tuple, got.collect())) == multiset(top_phrases([r[1:] for r in rows], least, top))


def test_phrases_empty(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations(df).count() == 0
    assert collocations(spark.createDataFrame([(1, None, None), (2, "en", "")], df.schema)).count() == 0


@pytest.mark.parametrize("small", [0, 40, 4096])
def test_quicksort_sizes(monkeypatch, small):
    monkeypatch.setattr(phrases, "SMALL", small)
    rng = np.random.default_rng(2)
    words = [rng.integers(0, 6, 3000).astype(np.uint32) for _ in range(4)]
    for k in range(3):
        words[k + 1][words[k] == 0] = 0
    n = rng.integers(1, 4, 3000)
    want = collections.Counter()
    for row, m in zip(zip(*(w.tolist() for w in words), strict=True), n.tolist(), strict=True):
        for k in range(1, 5):
            if row[k - 1]:
                want[row[:k]] += m
    assert dict(phrase_sizes(words, n, 25)) == {p: a for p, a in want.items() if a >= 25}


# repeated strings


def cut(rows, least):
    count = collections.Counter()
    for _, text in rows:
        text = (text or "").encode()
        count.update(text[k : k + least] for k in range(len(text) - least + 1))
    out = []
    for i, text in rows:
        text = (text or "").encode()
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - least + 1):
            if count[text[k : k + least]] > 1:
                gone[k : k + least] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0)).tolist()
        out.append((i, len(text), int(gone.sum()), kept, list(zip(edges[::2], edges[1::2], strict=True))))
    return out


def removed(df, least):
    got = without_repeated_strings(df, least).collect()
    return [(r[0], r[1], r[2], bytes(r[3]), [tuple(s) for s in r[4]]) for r in got]


@pytest.mark.parametrize("least, crowd, slice_bytes", [(400, 2048, 1 << 20), (60, 2048, 700), (60, 2, 1 << 20), (8, 3, 1 << 20)])
def test_strings_match_brute_force(docs, monkeypatch, least, crowd, slice_bytes):
    monkeypatch.setattr(repeated_strings, "CROWD", crowd)
    monkeypatch.setattr(repeated_strings, "SLICE", slice_bytes)
    assert multiset(removed(docs.repartition(6), least)) == multiset(cut([r[:2] for r in documents()], least))


def test_passages_in_other_surroundings(spark):
    rng = random.Random(8)
    passage, line = prose(rng, 90), "x" * 3000
    rows = [(k, prose(rng, 60)[: 200 + k] + passage + prose(rng, 60)) for k in range(50)]
    rows += [(60, line), (61, "ab" * 900), (62, "y" * 399), (63, "z" * 400), (64, "z" * 401), (65, passage[:399]), (66, passage[1:401])]
    got = removed(spark.createDataFrame(rows, "doc_id long, text string"), 400)
    assert multiset(got) == multiset(cut(rows, 400))
    assert all(r[2] >= len(passage.encode()) for r in got if r[0] < 50)


def test_strings_empty(spark, docs):
    assert without_repeated_strings(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    assert multiset(removed(nothing, 400)) == multiset([(None, 0, 0, b"", []), (1, 0, 0, b"", [])])


def test_shard_kernels():
    rng = random.Random(1)
    for _ in range(60):
        least = rng.choice([1, 3, 5, 9])
        contexts = [bytes(rng.choice(b"ab\0c") for _ in range(rng.randint(least, 30))) for _ in range(rng.randint(1, 6))]
        counts = [rng.choice([1, 1, 2]) for _ in contexts]
        seen = collections.Counter()
        for c, n in zip(contexts, counts, strict=True):
            for k in range(len(c) - least + 1):
                seen[c[k : k + least]] += n
        for c, at in zip(contexts, repeated_starts(contexts, np.array(counts), least), strict=True):
            assert at.tolist() == [k for k in range(len(c) - least + 1) if seen[c[k : k + least]] > 1]
    codes = np.frombuffer(bytes(rng.choice(b"\1\2") for _ in range(500)), np.uint8)
    order = suffix_order(codes, 512)
    assert order.tolist() == sorted(range(500), key=lambda k: codes[k:].tobytes())


def test_query_digest(spark):
    got = QUERIES["op11_repeated_strings"](spark, SMALL).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, gone, len(spans), hashlib.sha256(kept).hexdigest()) for i, n, gone, kept, spans in cut(rows, 400)]
    assert multiset(map(tuple, got)) == multiset(want)
