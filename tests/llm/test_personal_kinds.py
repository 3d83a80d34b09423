"""Planted cases of every kind that the trees add, in forms without a proof of their own."""

import random

from gaugewise.llm import personal_data
from gaugewise.llm.shipping import ship_package
from tests.llm.fixtures import prose


def planted(rng):
    """A corpus with proven values, dates and plain numbers; then (text, kind or None) to find."""
    rows = []
    for k in range(600):
        digits = "".join(rng.choice("0123456789") for _ in range(10))
        key = "".join(rng.choice("0123456789abcdefghkmnpqrstvwxyz") for _ in range(rng.randint(10, 30)))
        name = "".join(rng.choice("abcdefghij") for _ in range(6))
        tail = [f"call +1 ({digits[:3]}) {digits[3:6]}-{digits[6:]} or", f"mail {name}.x@{name}.example.org for", f"password: {key} and", f"secret: nobody{name[:2]} on",
                f"on {rng.randint(1990, 2024)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)} in", f"about {rng.randint(1, 90000)} of"][k % 6]
        rows.append(f"{prose(rng, 20)} {tail} {prose(rng, 10)}")
    cases = []
    for said, kind in (("password: correct-horse-battery and", "secret"), ("call 619-555-0053 or", "number"), ("mail jo.doe (at) mills (dot) example (dot) org for", "handle"),
                       ("on 2011-04-17 in", None), ("about 4711 of", None), ("secret: everybody on", None)):
        cases += [(f"{prose(rng, 20)} {said} {prose(rng, 10)}", kind) for _ in range(5)]
    return rows, cases


def test_each_kind(spark):
    ship_package(spark)
    rows, cases = planted(random.Random(8))
    texts = [(k, t) for k, t in enumerate([*rows, *(t for t, _ in cases)])]
    got = {r.doc_id: r for r in personal_data.find_personal_data(spark.createDataFrame(texts, "doc_id long, text string"), redact=True).collect()}
    for k, (text, kind) in enumerate(cases, len(rows)):
        found = got[k].redacted
        assert (f"[{kind}]" in found) if kind else found == text, (text, found)


def test_all_candidates_are_offered():
    class Everything:
        trees, least = True, 0.5

        def likely(self, rows):
            return [1.0] * len(rows)

    _, spans = personal_data.find_spans("password: correct-horse-battery", Everything())
    assert spans == [("secret", 10, 31)]
