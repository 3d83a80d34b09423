"""Each operator against a brute-force version over awkward rows, empty tables, and its own promises."""

import collections
import hashlib
import html
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gaugewise.llm import line_dedup, personal_data, toxicity
from gaugewise.llm.html_text import extract_main_text, main_text
from gaugewise.llm.licences import scan_licences
from gaugewise.llm.mixing import mix_report, mixed_documents, permuted, targets
from gaugewise.llm.near_dedup import near_duplicates, without_near_duplicates
from gaugewise.llm.packing import pack_documents
from gaugewise.llm.quality_rules import quality_verdicts, without_rejected
from gaugewise.llm.queries import ORACLES, QUERIES
from gaugewise.llm.shipping import ship_package
from gaugewise.llm.top_k import nearest
from tests.llm.fixtures import LOW, documents, frame, labels, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return frame(spark)


def multiset(rows):
    return collections.Counter(map(repr, rows))


def shingles(text):
    words = WORD.findall((text or "").translate(LOW))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def components(rows):
    """Brute force: every pair of texts."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, sa) in enumerate(sets):
        for b, sb in sets[:k]:
            if a is not None and b is not None and sa and sb and 100 * len(sa & sb) >= 75 * len(sa | sb):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), find(i) if i is not None else None, i is None or find(i) == i) for i, s in sets]


def test_near_duplicates(docs):
    want = components([(r[0], r[1]) for r in documents()])
    assert multiset(tuple(r) for r in near_duplicates(docs).collect()) == multiset(want)


def test_near_duplicate_crowd(spark):
    """Copies that link with their base alone, in a crowd that buckets mix with texts not alike enough."""
    rng = random.Random(3)
    base = prose(rng, 200).split()
    rows = [(500, " ".join(base))]
    for k in range(60):
        words = list(base)
        for _ in range(2 + k % 9):
            words[rng.randrange(200)] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert multiset(tuple(r) for r in got.collect()) == multiset(components(rows))


def test_one_of_each_group_stays(docs):
    kept = {i for i, _, _, keep in components([(r[0], r[1]) for r in documents()]) if keep}
    got = without_near_duplicates(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == kept


def base_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = collections.defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k : k + 8])].append(k)
    covered = {k + d for v in places.values() if len(v) > 1 for k in v for d in range(8)}
    symbols = sum(w.count(c) for w in words for c in "#*$%&|<>")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts_without_labels(spark, docs):
    got = quality_verdicts(docs, labels(spark)).collect()
    want = [(r[0], *(q := base_quality(r[1])), not q[-1]) for r in documents()]
    assert multiset(tuple(r) for r in got) == multiset(want)
    kept = without_rejected(docs, labels(spark))
    assert kept.columns == docs.columns
    assert multiset(r.text for r in kept.collect()) == multiset(r[1] for r in documents() if not base_quality(r[1])[-1])


def test_quality_rules_learn_symbols(spark):
    rng = random.Random(1)
    rows, marks = [], []
    for k in range(300):
        words = prose(rng, 60).split()
        bad = k % 4 == 0
        rows.append((k, " ".join(w + "###" if bad else w for w in words)))
        marks.append((k, 0 if bad else 1, 0))
    got = quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string"), labels(spark, marks)).collect()
    assert all(r.kept == bool(r.doc_id % 4) for r in got)


def test_licence_base_counts(docs):
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    want = []
    for r in documents():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").translate(LOW))
        at = [(k, name) for name, p in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        names = ",".join(sorted({n for _, n in at}))
        want.append((r[0], len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, names))
    got = scan_licences(docs).collect()
    assert multiset(tuple(r)[:6] for r in got) == multiset(want)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)


def test_licence_notices(spark):
    texts = [
        (1, "This work is licensed under the GNU General Public License, version 3. Enjoy."),
        (2, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in our Software without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software"),
        (3, "the general public has a license to walk under the trees"),
    ]
    got = {r.doc_id: r.labels for r in scan_licences(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: "gpl-3", 2: "mit", 3: ""}


def test_mix(docs):
    got = mix_report(docs).collect()
    rows = documents()
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(r[0]), len(WORD.findall(r[1] or ""))) for r in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert multiset(tuple(r) for r in mix_report(docs).collect()) == multiset(tuple(r) for r in got)
    taken, wanted = collections.Counter(), {}
    for r in got:
        taken[r.source_size] += r.taken
        wanted[r.source_size] = r.target
    assert all(abs(taken[k] - t) <= 200 for k, t in wanted.items())
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in out.collect()) == sum(r.taken for r in got)


def test_mix_parts():
    assert sorted(permuted(__import__("numpy").arange(1000), 1000, 5)) == list(range(1000))
    assert targets([10, 1000], [5.0, 2.0], 1010) == [30.0, 980.0]
    assert targets([], [], 0) == []


def test_line_dedup(docs):
    out = line_dedup.without_repeated_lines(docs, counts=True)
    assert out.columns == [*docs.columns, "n_removed", "n_removed_words"]
    seen, want = {}, []
    order = sorted(documents(), key=lambda r: (r[0] is None, r[0] or 0))
    for i, text, *_ in order:
        at, kept, end = line_dedup.chunks(text or ""), [], 0
        for a, b in at:
            said = text[a:b].strip()
            if seen.setdefault(said, (i, text, a)) != (i, text, a):
                kept.append(text[end:a])
                end = b
        want.append((i, None if text is None else "".join([*kept, text[end:]])))
    got = out.collect()
    assert multiset((r.doc_id, r.text) for r in got) == multiset(want)
    assert all(r.n_chars == len(r.text or "") for r in got)


def test_passages_are_cut_alike_after_a_shift():
    rng = random.Random(9)
    passage = prose(rng, 80)
    found = [{t[a:b].strip() for a, b in line_dedup.chunks(t)} for t in (prose(rng, 30) + "\n" + passage, "x\n" + passage + "\n" + prose(rng, 50))]
    assert sum(len(s.split()) for s in found[0] & found[1]) == 80


def test_main_text(spark):
    page = (
        "<html><head><title>t</title><script>a<b</script></head><body><nav><a>Menu, menu. Menu</a></nav><div class='ad'>Buy, now.</div>"
        "<article><h1>Head &amp; tail</h1><p>Some\n  text, long enough.<p>Short<br>er</article><aside>Side</aside><div id=comments>"
        "<p>I like it, really, all of it.</p></div><footer>&copy; us</footer></body>"
    )
    rows = [(1, "u", page, 1), (1, "u", page, 1), (2, None, None, 1), (3, "u", "", 1), (None, "u", "<p>only", 1), (5, "u", "<div>" * 3000 + "deep", 1)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    text = "Head & tail\n\nSome text, long enough.\n\nShort er"
    want = [(1, "u", text), (1, "u", text), (2, None, ""), (3, "u", ""), (None, "u", "only"), (5, "u", "deep")]
    assert multiset(tuple(r) for r in got) == multiset((*w, len(w[2])) for w in want)


def test_main_text_without_article():
    page = "<body><ul><li><a>Home</a><li><a>News</a></ul><div><h2>Head</h2><p>Long text, with marks. And more of it here.</p><p>Short.</p></div><form>x</form>"
    assert main_text(page) == "Head\n\nLong text, with marks. And more of it here.\n\nShort."


def test_driver_pages(spark):
    """The tables' pages mark their article, so its blocks are the text."""
    for r in QUERIES["op3_html_extraction"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/pages.parquet"), "page_id").collect():
        inner = re.sub(r"</?(?:h1|p)[^>]*>", "\0", r.html[r.html.index("<article") : r.html.index("</article>")])
        inner = html.unescape(re.sub(r"<[^>]*>", "", inner.replace("<br>", " ")))
        assert r.text == "\n\n".join(x for x in (" ".join(b.split()) for b in inner.split("\0")) if x)


def test_top_k(spark):
    rng = random.Random(2)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(4)], 0) for k in range(120)]
    rows += [(200 + k, [1.0, 0.5, 0.0, 0.0], 0) for k in range(20)]  # ties
    rows += [(300, None, 0), (350, [1.0, None, 0.0, 0.0], 0), (400, [float("nan"), 0.0, 0.0, 0.0], 0), (None, [9.0, 9.0, 9.0, 9.0], 0), (450, [float("inf")] * 4, 0)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")).collect()
    import numpy as np

    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in whole:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert multiset(tuple(r) for r in got) == multiset(want)
    assert nearest(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0
    huge = nearest(spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<double>")).collect()
    assert [r.score for r in huge] == [2**63 - 1]


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    rows, marks = [], []
    for k in range(900):
        words = prose(rng, 80).split()
        bad = k % 3 == 0
        if bad:
            for _ in range(4):
                words[rng.randrange(80)] = rng.choice(["qwixzle", "vobbur", "jekkum"]) + rng.choice(["", "s", "an"])
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(bad)))
    got = toxicity.toxicity_scores(spark.createDataFrame(rows, "doc_id long, text string"), labels(spark, marks)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(900) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.95 * len(held)


def test_toxicity_of_awkward_rows(spark, docs):
    got = toxicity.toxicity_scores(docs, labels(spark, [(1, 1, 1), (2, 1, 0), (2, 1, None), (None, 0, 1)])).collect()
    assert len(got) == len(documents())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_symbol_codes():
    import numpy as np

    codes, at = toxicity.symbol_codes(np.frombuffer(b"Ab, .cxyz", np.uint8), np.array([0, 6, 6, 9]))
    said = [[(x >> (5 * (4 - k))) & 31 for k in range(5)] for x in codes.tolist()]
    assert at.tolist() == [0, 5, 6, 10]
    assert said[:3] == [[0, 0, 0, 0, 1], [0, 0, 0, 1, 2], [0, 0, 1, 2, 0]]
    assert said[6:] == [[0, 0, 0, 0, 24], [0, 0, 0, 24, 25], [0, 0, 24, 25, 26], [0, 24, 25, 26, 0]]


def test_personal_data_base(docs):
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and personal_data.luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    want = []
    for i, text, *_ in documents():
        spans = [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text or "") if ok(m[0])]
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((i, *(sum(s[0] == k for s in spans) for k in rules), hashlib.sha256(written.encode()).hexdigest()))
    got = personal_data.find_personal_data(docs).collect()
    assert multiset(tuple(r)[:6] for r in got) == multiset(want)
    assert sum(r.n_email for r in got) == 1 and sum(r.n_ip for r in got) == 1


def test_personal_data_redacts_credentials(spark):
    rng = random.Random(6)
    rows = []
    for k in range(120):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        tail = f' token = "{key}" and' if k % 2 else " version 2.0 of"
        rows.append((k, prose(rng, 20) + tail + prose(rng, 10)))
    got = {r.doc_id: r for r in personal_data.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), redact=True).collect()}
    assert all(("[secret]" in r.redacted) == bool(k % 2) for k, r in got.items())
    assert personal_data.redacted("abcdef", [("x", 1, 3), ("y", 2, 5)]) == "a[x]f"


def test_packing_round_trip(spark, docs):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True).collect()
    want = collections.Counter()
    for i, text, *_ in documents():
        want[i, np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()] += 1
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == r.length and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
    for (i, n), own in pieces.items():
        copies = [t for (j, t), c in want.items() if j == i and len(t) == 4 * n for _ in range(c)]
        covered = collections.Counter(k for r in own for k in range(r.start, r.start + r.length))
        assert covered == {k: len(copies) for k in range(n)}
        if len(copies) == 1:
            said = b"".join(r.ids for r in sorted(own, key=lambda r: r.start))
            assert np.frombuffer(said, "<u2").astype("<u4").tobytes() == copies[0]
    for own in sequences.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 1024 and end & (end - 1) == 0


def test_empty_tables(spark):
    ship_package(spark)
    none = frame(spark, [])
    import public_tokenizers

    assert near_duplicates(none).count() == 0
    assert quality_verdicts(none, labels(spark)).count() == 0
    assert without_rejected(none, labels(spark)).count() == 0
    assert scan_licences(none).count() == 0
    assert mix_report(none).count() == 0
    assert mixed_documents(none).count() == 0
    assert line_dedup.without_repeated_lines(none).count() == 0
    assert toxicity.toxicity_scores(none, labels(spark)).count() == 0
    assert personal_data.find_personal_data(none).count() == 0
    assert pack_documents(none, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_queries_with_sql(spark):
    from checks.compare import compare, connect

    for name, sql in ORACLES.items():
        ok, note = compare(spark, connect(SMALL), QUERIES[name], sql, SMALL)
        assert ok, f"{name}: {note}"


def test_pipeline(spark):
    import corpus_pipeline
    from gaugewise.llm.storage import stored

    docs = frame(spark, [(r[0] + 1000 * k if r[0] is not None else None, r[1], *r[2:]) for k in range(2) for r in documents()])
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
        seen[name] = docs.collect()
        assert docs.columns == columns or name == "packing"
    texts = [r.text for r in seen["near_dedup"] if r.doc_id is not None]  # rows without an id are left alone
    assert len([t for t in texts if t]) == len({t for t in texts if t})
    assert all(not base_quality(r.text)[-1] for r in seen["quality_rules"])
    assert seen["packing"] and docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
