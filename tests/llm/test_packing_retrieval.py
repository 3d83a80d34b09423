"""Retrieval for packing: BM25 order against brute force, and like texts meet whatever their doc_id."""

from __future__ import annotations

import collections
import random

import numpy as np
import public_tokenizers
import pytest

from gaugewise.llm import packing


def brute_scores(units, idf, mean, seed):
    out = []
    for unit in units:
        tf, score = collections.Counter(unit), 0
        for t in set(units[seed]) - {0}:
            if tf[t]:
                w = idf[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(unit) / mean))
                score += max(round(float(w) * packing.WEIGHT_STEPS), 1)
        out.append(score)
    return out


@pytest.fixture(scope="module")
def shard():
    rng = np.random.default_rng(4)
    # frequent tokens (dense rows), rare ones (postings), equal units (ties), units of the closing token alone
    units = [np.append(np.minimum(rng.geometric(0.01, rng.integers(1, 120)), 900), 0).astype(np.uint16) for _ in range(150)]
    units += [units[3], units[3], np.zeros(1, np.uint16), np.zeros(1, np.uint16)]
    df = np.zeros(packing.VOCABULARY)
    for u in units:
        df[np.unique(u)] += 1
    idf = np.log(1 + (len(units) - df + 0.5) / (df + 0.5))
    return units, idf, float(np.mean([len(u) for u in units])), df


def test_scores_and_order_equal_brute_force(shard):
    units, idf, mean, _ = shard
    index, unused = packing.Index(units, idf, mean), np.ones(len(units), bool)
    unused[::7] = False
    assert 0 < len(index.dense) < 200
    for seed in range(len(units)):
        want = brute_scores([u.tolist() for u in units], idf, mean, seed)
        got = index.scores(seed)
        assert np.abs(got - want).max() <= 0.002 * max(want) + 1  # halves may round either way
        order = index.neighbours(seed, unused)
        assert list(order) == sorted((k for k in range(len(units)) if got[k] > 0 and unused[k]), key=lambda k: (-got[k], k))


def test_many_tied_neighbours():
    units = [np.array([5, 0], np.uint16)] * 3000
    order = packing.Index(units, np.ones(packing.VOCABULARY), 2.0).neighbours(2, np.arange(3000) > 10)
    assert list(order) == list(range(11, 11 + packing.WINDOW))


def test_order_of_tokens(shard):
    *_, df = shard
    place = packing.token_order(df, 154)
    telling = np.flatnonzero(df[1:] >= 2) + 1
    assert sorted(place[telling]) == list(range(len(telling)))
    assert place[0] == packing.VOCABULARY - 1 and (place[df < 2] == packing.VOCABULARY - 1).all()
    assert len(packing.token_order(np.zeros(packing.VOCABULARY), 0)) == packing.VOCABULARY


def test_like_texts_share_sequences(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvwy") for _ in range(rng.randint(3, 9))) for _ in range(4000)]
    rows = []
    for k in range(150):
        own = rng.sample(words, 60)
        text = [rng.choice(own) for _ in range(90)]
        again = [w if rng.random() > 0.05 else rng.choice(words) for w in text]
        rows += [(k, " ".join(text)), (100_000 + k, " ".join(again))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

    def together(shard_tokens):
        got = packing.pack_documents(docs, path, pattern, shard_tokens=shard_tokens).collect()
        assert shard_tokens > 20_000 or sum(r.length for r in got) / shard_tokens >= 3
        of = collections.defaultdict(set)
        for r in got:
            of[r.doc_id].add(r.sequence_id)
        return sum(bool(of[k] & of[100_000 + k]) for k in range(150))

    # a window is filled by its seed's neighbours, so the copy of one of these may find its own place taken
    whole, dealt = together(10**6), together(20_000)
    assert whole >= 90 and dealt >= 0.85 * whole, (whole, dealt)


def test_encoder_looks_for_no_empty_string_and_splits_alike():
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encode = packing.encoder(path, pattern)
    # without a special token the search for one stops at every character
    assert encode.special_tokens_set == {packing.UNUSED}
    assert pattern in packing.SAME_SPLIT
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=encode._mergeable_ranks, special_tokens={})
    rng = random.Random(3)
    parts = ["a", "Bc", "é", "中文", "12", "٣", "'s", "'re", "'", "!", "...", " ", "  ", "\n", "\r\n", "\t", " ", " ", packing.UNUSED, "\0"]
    texts = ["", " ", "\n\n", packing.UNUSED] + ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(3000)]
    for text in texts:
        assert encode.encode_to_numpy(text, disallowed_special=()).tolist() == plain.encode_ordinary(text)
