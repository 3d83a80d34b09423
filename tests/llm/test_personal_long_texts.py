"""Base spans on hostile texts: the same as the plain patterns, in time that grows with the text."""

import random
import re
import time

from gaugewise.llm.personal_data import IP, candidates, email_spans

EMAIL_PLAIN = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP_PLAIN = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_same_spans_as_the_plain_patterns():
    rng = random.Random(4)
    for _ in range(30_000):
        text = "".join(rng.choice("ab1.@-_ é") for _ in range(rng.randint(0, 24)))
        assert list(email_spans(text)) == [m.span() for m in EMAIL_PLAIN.finditer(text)], text
        text = "".join(rng.choice("12..a") for _ in range(rng.randint(0, 24)))
        assert [m.span() for m in IP.finditer(text)] == [m.span() for m in IP_PLAIN.finditer(text)], text


def test_long_runs_end():
    n = 1_000_000
    hostile = ["x" * n + " a@b.cc", "1" * n + " 1.2.3.4", "a@" * (n // 2), "." * n + "@b.cc 1", "1." * (n // 2) + "x 5", "+1" * (n // 2), "a" * n + "@" + "b" * n]
    for text in hostile:
        begin = time.perf_counter()
        list(email_spans(text))
        list(IP.finditer(text))
        assert time.perf_counter() - begin < 5, text[:20]
    begin = time.perf_counter()
    assert ("email", n + 1, n + 7) not in {c[:3] for c in candidates(hostile[0])}
    assert time.perf_counter() - begin < 5
