"""Repeated passages that begin and end inside lines, against every window of words."""

import random
import re

from gaugewise.llm import line_dedup
from gaugewise.llm.queries import QUERIES
from gaugewise.llm.shipping import ship_package

SIZE = 50


def plain(rng, n):
    """Words without a sentence end."""
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(3, 7))) for _ in range(n))


def windows(text, size):
    words = text.split()
    return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]


def planted():
    rng = random.Random(11)
    passages = [plain(rng, n) for n in (50, 51, 60, 75, 120, 400)]
    passages.append(". ".join(plain(rng, 12).capitalize() for _ in range(6)))  # a few sentences
    rows = []
    for k in range(60):
        said = [plain(rng, rng.randint(5, 90)) for _ in range(3)]
        a, b = rng.sample(passages, 2)
        rows.append((k, f"{said[0]} {a} {said[1]}{rng.choice([' ', '. ', chr(10)])}{b} {said[2]}"))
    return rows


def test_inline_passages(spark, tmp_path):
    ship_package(spark)
    rows = planted()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op2_line_dedup"](spark, str(tmp_path)).collect()}
    seen: set = set()
    shorter: set = set()
    for i, text in rows:
        words, gone, may_go = text.split(), set(), set()
        for k, w in enumerate(windows(text, SIZE)):
            if w in seen:
                gone.update(range(k, k + SIZE))
        for k, w in enumerate(windows(text, line_dedup.MARK_WORDS)):
            if w in shorter:
                may_go.update(range(k, k + line_dedup.MARK_WORDS))
        seen.update(windows(text, SIZE))
        shorter.update(windows(text, line_dedup.MARK_WORDS))
        left = [w for k, w in enumerate(words) if k not in gone]
        assert gone <= may_go
        assert got[i].text.split() == left, i
        assert got[i].n_removed_words == len(gone)


def test_texts_that_say_one_thing_over_and_over(spark):
    ship_package(spark)
    rows = [(1, "word " * 300), (2, "word " * 300), (3, "a b c d e f g " * 100), (4, "x " * 49)]
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == "" and got[4] == "x " * 49
    assert line_dedup.MARK_WORDS <= len(got[1].split()) <= 2 * SIZE and len(got[3].split()) <= 3 * SIZE


def test_word_starts_without_a_match_per_word():
    rng = random.Random(8)
    parts = ["a", "bc", "é", "中", "😀", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", " ", " ", "\x85", ".", "\0"]
    for text in ["", " ", "é", *("".join(rng.choices(parts, k=rng.randint(0, 90))) for _ in range(500))]:
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        assert line_dedup.word_starts(text) == [m.start() for m in found]
        assert text.encode().split() == [m[0].encode() for m in found]
